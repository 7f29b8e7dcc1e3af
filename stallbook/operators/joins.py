"""Equi-joins with the null rules of the models.

No broadcast hints: Spark broadcasts a side only while its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` (statically from file sizes, or
at run time from shuffle sizes) and otherwise shuffles both sides, where AQE
splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.operators.rows import distinct_count
from stallbook.operators.shared import share


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left outer equi-join; a null key matches nothing."""
    return left.join(right, on=list(keys), how="left")


def anti_join(df: DataFrame, exclude: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``exclude``. Needs no ``distinct`` on
    the excluded side, and a null key is kept."""
    return df.join(exclude.select(*keys), on=list(keys), how="left_anti")


def pair_join(left: DataFrame, right: DataFrame, equal: Column, residual: Column) -> DataFrame:
    """Inner join on an equality with a further condition on the matched pairs.
    Both stand in one condition, so Spark hashes on the equality and checks the
    rest while matching; it is never a cross join."""
    return left.join(right, on=equal & residual, how="inner")


#: Which keys of a group are null, a bit for each.
NULLS = "_nulls"


def groups_with_counts(
    df: DataFrame, keys: Sequence[str], sums: Sequence[Column], counts: Mapping[str, str]
) -> DataFrame:
    """Aggregates by ``keys`` and ``name: count(distinct column)`` beside them; null
    keys are groups too.

    Null keys are marked and replaced before grouping, so that the summaries meet
    on plain equality where their aggregates have already brought them: a null-safe
    join would shuffle each of them once more."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def filler(k: str) -> Column:
        kind = kinds[k].simpleString()
        return F.lit("1970-01-01" if kind in ("date", "timestamp") else "0").cast(kind)

    mark = sum((F.when(F.col(k).isNull(), 2**i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    marked = df.withColumns({k: F.coalesce(F.col(k), filler(k)) for k in keys} | {NULLS: mark})
    marked_keys = [*keys, NULLS]
    out = marked.groupBy(*marked_keys).agg(*sums)
    for name, column in counts.items():
        out = out.join(distinct_count(marked, marked_keys, column, name), marked_keys)
    own = {
        k: F.when(F.col(NULLS).bitwiseAND(F.lit(2**i)) == 0, F.col(k)) for i, k in enumerate(keys)
    }
    return out.withColumns(own).drop(NULLS)


#: Groups are counted in so many buckets to find large ones, of more rows than this.
BUCKETS = 2**16
LARGE = 100_000


def _code(keys: Sequence[str]) -> Column:
    """A hash of the keys; hashing skips nulls, so their places go into it as well."""
    return F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])


def large_buckets(df: DataFrame, keys: Sequence[str], large: int = LARGE) -> list[int]:
    """Buckets of groups with more than half the rows of an equal part for a task, and
    more than ``large``: less than twice as many as there are parts."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(_code(keys), F.lit(BUCKETS)).alias("bucket")
    counts = share(df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    return [r.bucket for r in counts.where(F.col("n") > max(large, rows / parts / 2)).collect()]


def stored_groups_with_counts(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[Column],
    counts: Mapping[str, str],
    large: int = LARGE,
) -> DataFrame:
    """:func:`groups_with_counts` for stored rows of many small groups, which partial
    aggregates do not make fewer: each row is moved once, by a hash of its keys, and
    the sums and all counts are taken where it arrives, without pairs or joins.

    Groups that are large for a task are looked for at once. Their buckets take the
    other way, where rows are reduced before they move."""
    buckets = large_buckets(df, keys, large)
    if not buckets:
        return _moved_groups(df, keys, sums, counts)
    in_large = F.pmod(_code(keys), F.lit(BUCKETS)).isin(buckets)
    small = _moved_groups(df.where(~in_large), keys, sums, counts)
    return small.unionByName(groups_with_counts(df.where(in_large), keys, sums, counts))


def _moved_groups(
    df: DataFrame, keys: Sequence[str], sums: Sequence[Column], counts: Mapping[str, str]
) -> DataFrame:
    """The first row of each value of a group is marked, and marks are added up. The
    hash is made again after the move, as it would be the least compressible column."""
    moved = df.repartition(_code(keys)).withColumn("_code", _code(keys))
    marks = {name: f"_first_{name}" for name in counts}
    for name, column in counts.items():
        value = Window.partitionBy("_code", *keys, column).orderBy(F.lit(1))
        first = (F.row_number().over(value) == 1) & F.col(column).isNotNull()
        moved = moved.withColumn(marks[name], first.cast("bigint"))
    found = [F.sum(mark).alias(name) for name, mark in marks.items()]
    return moved.groupBy("_code", *keys).agg(*sums, *found).drop("_code")
