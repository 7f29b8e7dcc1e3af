"""Best-fit packing into sequences of several permitted lengths: a text goes to
the open sequence that it fills best, a new sequence is opened in the length that
costs least, and in the end each takes the shortest length that holds it."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import annotate, raw_texts
from stallbook.operators.shared import share

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence: a fixed part, its positions, and attention over them.
OVERHEAD, ATTENTION = 32, 65_536
#: Tokens that one task packs; texts are dealt out evenly to so many tasks.
SHARD_TOKENS = 2_000_000


def cost(capacity: int) -> float:
    return OVERHEAD + capacity + capacity**2 / ATTENTION


def pack_lengths(lengths: list[int], capacities: tuple[int, ...]) -> list[tuple[int, int, int]]:
    """(sequence, its capacity, offset) of each length; none is longer than the
    largest capacity. Longest first; equal lengths in the given order."""
    permitted = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    left = sum(lengths)
    filled: list[int] = []
    spaces: list[int] = []  # distinct free spaces of open sequences, sorted
    open_by: dict[int, list[int]] = {}
    size_of: list[int] = []
    place = [(0, 0)] * len(lengths)
    for i in order:
        n = lengths[i]
        left -= n
        k = bisect_left(spaces, n)
        if k < len(spaces):
            space = spaces[k]
            number = open_by[space].pop()
            if not open_by[space]:
                del open_by[space], spaces[k]
        else:
            # The least cost for a token, when what is left fills the rest.
            space = min(
                (c for c in permitted if c >= n),
                key=lambda c: (cost(c) / (n + min(c - n, left) if n + left else 1), c),
            )
            number = len(filled)
            filled.append(0)
            size_of.append(space)
        place[i] = (number, filled[number])
        filled[number] += n
        space -= n
        if space:
            if space not in open_by:
                open_by[space] = []
                insort(spaces, space)
            open_by[space].append(number)
    final = [permitted[bisect_left(permitted, f)] for f in filled]
    return [(number, final[number], offset) for number, offset in place]


def count_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``n_tokens``: words between ASCII white space and one end
    mark. Null and empty texts have only the end mark."""

    def run(column: pa.Array) -> list:
        return [[len(t.split()) + 1 if t else 1 for t in raw_texts(column)]]

    return annotate(docs, [text], run, pa.schema([("n_tokens", pa.int64())]))


def pack(
    lengths: DataFrame,
    length: str = "n_tokens",
    capacities: tuple[int, ...] = CAPACITIES,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece: the columns of ``lengths`` and ``piece``, ``start``,
    ``piece_tokens``, ``sequence``, ``capacity``, ``offset``.

    A text longer than the largest capacity is cut into full sequences and a
    rest. The input is stored first and its rows numbered, then pieces are dealt
    to tasks by a hash of the number, about ``shard_tokens`` to each: a hot key
    does not matter, and every shard leaves at most its last sequences of each
    capacity unfilled. Null or negative lengths count as 0; pieces of 0 tokens take up no room but
    are placed. Equal rows are placed one by one. An empty table stays empty;
    input columns with the names of the result are replaced.
    """
    made = ["piece", "start", "piece_tokens", "sequence", "capacity", "offset"]
    kept = [c for c in lengths.columns if c not in made]
    largest = max(capacities)
    rows = share(
        lengths.select(
            *[F.col(f"`{c}`") for c in kept],
            F.greatest(F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)), F.lit(0)).alias("__n"),
            F.monotonically_increasing_id().alias("__row"),
        )
    )
    full = F.floor(F.col("__n") / largest)
    last = F.when((F.col("__n") % largest == 0) & (F.col("__n") > 0), full - 1).otherwise(full)
    pieces = rows.select("__row", "__n", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "__row",
        F.col("piece").cast("long").alias("piece"),
        (F.col("piece") * largest).cast("long").alias("start"),
        F.least(F.lit(largest), F.col("__n") - F.col("piece") * largest).alias("piece_tokens"),
    )
    total = pieces.agg(F.sum("piece_tokens"), F.count("*")).first()
    # A piece without tokens still has to be handled by a task.
    shards = max(1, -(-((total[0] or 0) + total[1]) // shard_tokens))

    def place(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["__row", "piece"], ignore_index=True)
        placed = pack_lengths(shard["piece_tokens"].tolist(), capacities)
        out = pd.DataFrame(placed, columns=["sequence", "capacity", "offset"], dtype="int64")
        out["sequence"] += int(shard["__shard"].iloc[0]) << 32
        return pd.concat([shard.drop(columns="__shard"), out], axis=1)

    dealt = pieces.withColumn("__shard", F.pmod(F.xxhash64("__row", "piece"), F.lit(shards)))
    placed = dealt.groupBy("__shard").applyInPandas(
        place,
        "__row long, piece long, start long, piece_tokens long, "
        "sequence long, capacity long, offset long",
    )
    return rows.drop("__n").join(placed, "__row").select(*[F.col(f"`{c}`") for c in kept], *made)


def sequences(packed: DataFrame, text: str = "text", end: str = "<end>") -> DataFrame:
    """One row per sequence with its words: ``sequence``, ``capacity``,
    ``n_tokens``, ``words``. ``packed`` still has the text. What is gathered for
    a row is at most its capacity."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    tokens = F.concat(words, F.array(F.lit(end)))
    part = F.slice(tokens, (F.col("start") + 1).cast("int"), F.col("piece_tokens").cast("int"))
    gathered = packed.select("sequence", "capacity", F.struct("offset", part.alias("w")).alias("p"))
    by_offset = F.array_sort(F.collect_list("p"))
    out = gathered.groupBy("sequence", "capacity").agg(
        F.flatten(F.transform(by_offset, lambda p: p["w"])).alias("words")
    )
    return out.withColumn("n_tokens", F.size("words").cast("long"))
