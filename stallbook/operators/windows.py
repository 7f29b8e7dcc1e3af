"""Deduplication, ranks, running totals and row offsets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.operators.shared import share


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row per key in the given order; ties fall to a hash of the
    ``tiebreak`` columns, so that the choice does not depend on partitioning.

    The hash is one long: text columns that only break ties stay out of the
    shuffle. ``row_number() = 1`` lets Spark keep one row per key on the map
    side, so a key with very many copies is cut down before it is shuffled.
    """
    order = list(order)
    if tiebreak:
        # hashing skips nulls, so their places go into the hash as well
        nulls = [F.col(c).isNull() for c in tiebreak]
        df = df.withColumn("_tie", F.xxhash64(*tiebreak, *nulls))
        order.append(F.col("_tie").asc())
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", first).filter(F.col("_rn") == 1).drop("_rn", "_tie")


#: Keys that occur more than once which are looked up (4 MB, so that they are broadcast).
MOST_REPEATED = 500_000


def dedup_stored(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tiebreak: Sequence[str] = (),
    most: int = MOST_REPEATED,
    settled: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """:func:`dedup_latest` for stored rows whose keys seldom come twice. Hashes of
    the keys are counted first; rows whose hash occurs once stay where they are, and
    only the others are shuffled and compared, by their keys. With more than
    ``most`` repeated hashes all rows are. ``df`` is read twice. Where the result is
    read again, ``settled=share`` keeps what was shuffled.
    """
    hashed = df.withColumn("_code", F.xxhash64(*keys))
    repeated = share(
        hashed.groupBy("_code").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_code")
    )
    n = repeated.count()
    if n == 0:
        return df
    if n > most:
        return settled(dedup_latest(df, keys, order, tiebreak))
    once = hashed.join(repeated, "_code", "left_anti").drop("_code")
    again = hashed.join(repeated, "_code", "left_semi").drop("_code")
    return once.unionByName(settled(dedup_latest(again, keys, order, tiebreak)))


def add_ranks(df: DataFrame, ranks: Mapping[str, tuple[Sequence[str], str]]) -> DataFrame:
    """Add ``rank() over (partition by part order by col desc nulls last)`` for
    each ``name: (part, col)``; an empty ``part`` ranks the whole result.

    The input is stored once, since each rank reads it, and the ranks of its
    distinct values are joined back; equal values share a rank, nulls are last.
    """
    base = share(df)
    out = base
    for name, (part, col) in ranks.items():
        keys = [f"_k{i}" for i in range(len(part))]
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(part)]
        same.append(F.col(col).eqNullSafe(F.col("_value")))
        ranked = value_ranks(base, name, part, col)
        out = out.join(ranked, same, "left").drop(*keys, "_value")
    return out


def global_rank(df: DataFrame, name: str, col: str) -> DataFrame:
    """Overall rank of one column, see :func:`add_ranks`."""
    return add_ranks(df, {name: ((), col)})


def value_ranks(df: DataFrame, name: str, part: Sequence[str], col: str) -> DataFrame:
    """Rank of every distinct value per partition: 1 + rows in higher ranges of
    values + rows with a higher value in the own range.

    No task sorts a whole partition. Rows are first counted by value, so ties
    cost nothing; then the values are range-partitioned by partition and value,
    which cuts a large partition into several ranges. The ranges are stored,
    because their limits are sampled and must not be drawn again.
    """
    keys = {f"_k{i}": F.col(k) for i, k in enumerate(part)}
    counts = df.groupBy(
        *[c.alias(k) for k, c in keys.items()], F.col(col).alias("_value")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    highest_first = F.col("_value").desc_nulls_last()
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = share(
        counts.repartitionByRange(ranges, *[F.col(k).asc() for k in keys], highest_first)
        .withColumn("_range", F.spark_partition_id())
    )

    # one row per range, so this window stays small
    above = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy(*keys, "_range").agg(F.sum("_rows").alias("_total"))
    totals = totals.withColumn("_above", F.coalesce(F.sum("_total").over(above), F.lit(0)))
    higher = (
        Window.partitionBy(*keys, "_range")
        .orderBy(highest_first)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = counts.withColumn("_higher", F.coalesce(F.sum("_rows").over(higher), F.lit(0)))

    i, t = inside.alias("i"), totals.alias("t")
    same = [F.col(f"i.{k}").eqNullSafe(F.col(f"t.{k}")) for k in [*keys, "_range"]]
    return i.join(t, same).select(
        *[F.col(f"i.{k}") for k in [*keys, "_value"]],
        (F.lit(1) + F.col("_above") + F.col("_higher")).alias(name),
    )


def running_sum(col: str, part: Sequence[str], order: Sequence[str]) -> Column:
    """Running total from the start of the partition to the current row."""
    w = Window.partitionBy(*part).orderBy(*order)
    return F.sum(col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def lag_rows(col: str, n: int, part: Sequence[str], order: Sequence[str]) -> Column:
    """Value ``n`` rows back (rows, not calendar days)."""
    return F.lag(col, n).over(Window.partitionBy(*part).orderBy(*order))


def rolling_avg(col: str, rows: int, part: Sequence[str], order: Sequence[str]) -> Column:
    """Average over the current row and the ``rows - 1`` before it."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(1 - rows, Window.currentRow)
    return F.try_divide(F.sum(col).over(w).cast("double"), F.count(col).over(w))


def lag_days(col: str, days: int, part: Sequence[str], date_col: str) -> Column:
    """Value exactly ``days`` calendar days back, null when that day has no row."""
    day = F.unix_date(F.col(date_col))
    w = Window.partitionBy(*part).orderBy(day).rangeBetween(-days, -days)
    return F.max(col).over(w)


def rolling_avg_days(col: str, days: int, part: Sequence[str], date_col: str) -> Column:
    """Average over the rows of the last ``days`` calendar days."""
    day = F.unix_date(F.col(date_col))
    w = Window.partitionBy(*part).orderBy(day).rangeBetween(1 - days, Window.currentRow)
    return F.try_divide(F.sum(col).over(w).cast("double"), F.count(col).over(w))
