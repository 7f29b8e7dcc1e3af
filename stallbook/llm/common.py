"""Shared by the operators: words, row-wise Arrow functions, links to groups."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.operators.shared import share

#: ASCII letters in lower case, digits and every byte beyond ASCII belong to words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts are long rows: with Spark's usual 10,000 of them in a batch,
    a task would hold several copies of some tens of MB, or much more where texts
    are longer. Called by the registered queries and pipeline stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def word_list(raw: bytes | None, word_bytes: bytes = WORD_BYTES) -> list[bytes]:
    """Lower-case words of a text in UTF-8; null has none."""
    return raw.translate(word_bytes).split() if raw else []


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def text_slices(texts: list, most_bytes: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive slices of about ``most_bytes``; a longer text is one slice."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > most_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def annotate(df: DataFrame, inputs: list[str], fn: Callable, schema: pa.Schema) -> DataFrame:
    """All rows of ``df`` with the columns of ``schema`` that ``fn`` makes from
    ``inputs`` (Arrow arrays in, a list of arrays or lists out). Columns of
    ``df`` with those names are replaced."""
    names, kinds = schema.names, schema.types

    def run(*columns: pa.Array) -> pa.Array:
        made = fn(*columns)
        arrays = [
            x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(made, kinds)
        ]
        return pa.StructArray.from_arrays(arrays, names=names)

    run.__annotations__ = {"columns": pa.Array, "return": pa.Array}
    from pyspark.sql.pandas.types import from_arrow_schema

    made = F.arrow_udf(run, returnType=from_arrow_schema(schema))
    replaced = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in replaced]
    out = df.select(*[F.col(f"`{c}`") for c in kept], made(*inputs).alias("__made"))
    return out.select(*[F.col(f"`{c}`") for c in kept], *[f"__made.{n}" for n in names])


def crc_part(column: str, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def crc_of(value: int, parts: int) -> int:
    return zlib.crc32(str(value).encode()) % parts


def held_out(column: str, parts: int) -> Column:
    """The remainder is 2. A row without an id is never learned from, so it
    counts as held out."""
    return F.coalesce(crc_part(column, parts) == 2, F.lit(True))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): component is the
    smallest id that can be reached. Alternates the large-star and small-star
    steps: each round replaces links by links to smaller ids, so a group turns
    into a star in a number of rounds that grows with the logarithm of its
    size. Minima are taken before the shuffle; nothing is gathered per group."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = share(
        links.where("a != b").select(high.alias("u"), low.alias("v")).distinct()
    )

    def stars(both: DataFrame, grown: bool) -> DataFrame:
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.join(least, "u")
        if grown:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        return moved.union(own)

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both, True).where("u != v").distinct()
        edges = share(stars(large, False).where("u != v").distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
