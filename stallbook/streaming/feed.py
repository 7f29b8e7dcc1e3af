"""Daily feed of branch totals, and bill-line deduplication, on file streams.

Both keep a table of current rows by month (``sources.snapshots``). A batch is
merged with the stored rows of the months that it touches, and only these months
are written anew, so late files count like others and reading needs no shuffle. Each
batch is one commit: readers see all of it or nothing, and a driver or executor
may die at any point.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.operators.shared import shared_results
from stallbook.operators.windows import dedup_latest
from stallbook.plans.staging import latest_stored_sale
from stallbook.sources import snapshots

#: Files of one batch: a long backlog is worked off in several.
FILES_PER_BATCH = 64


def _merge(
    batch: DataFrame, target: str, day: str, settle: Callable[[DataFrame], DataFrame],
    in_place: bool = False,
) -> None:
    """Settle the batch together with the stored rows of its months, and commit
    these months. ``in_place``: only rows of the batch are brought together by month,
    stored ones are, and go from their files to new ones without a shuffle.

    Until the commit the table is what it was, and what it was is not touched: a
    batch that died anywhere, also after its commit, is simply run again, since
    settling rows twice changes nothing.
    """
    spark = batch.sparkSession
    months = [r[0] for r in batch.select(snapshots.month_of(day)).distinct().collect()]
    if not months:
        return
    base = snapshots.current(spark, target)
    if base is not None:
        stored = snapshots.read(spark, target, base, months)
        if in_place:
            stored = stored.withColumn(snapshots.FRESH, F.lit(False))
            batch = batch.withColumn(snapshots.FRESH, F.lit(True))
        batch = stored.unionByName(batch)
    with shared_results(spark):
        snapshots.write(settle(batch), target, day, base)
    snapshots.clean(spark, target)


def _run(
    arrived: DataFrame, target: str, checkpoint: str, day: str,
    settle: Callable[[DataFrame], DataFrame], in_place: bool = False,
) -> None:
    """Work off every file that has arrived since the last run, then stop."""

    def merge(batch: DataFrame, number: int) -> None:
        _merge(batch, target, day, settle, in_place)

    query = (
        arrived.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _files(
    spark: SparkSession, source: str, schema: T.StructType, fmt: str, per_batch: int
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_batch)
    return reader.load(source)


def run_daily_feed(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Merge every delivery that has arrived since the last run into the feed.

    Rows keep the time and name of the file that delivered them, so a day that is
    delivered again replaces the earlier version whichever comes first.
    """
    arrived = _files(spark, source, schema, fmt, max_files_per_batch).withColumns(
        {
            "delivered_at": F.col("_metadata.file_modification_time"),
            "delivered_file": F.col("_metadata.file_path"),
        }
    )
    _run(arrived, target, checkpoint, "voucher_date", _latest)


def _latest(
    feed: DataFrame, keys: Sequence[str] = ("company_name", "voucher_date")
) -> DataFrame:
    order: list[Column] = [F.col("delivered_at").desc(), F.col("delivered_file").desc()]
    return dedup_latest(feed, keys, order)


def latest_delivery(
    feed: DataFrame, keys: Sequence[str] = ("company_name", "voucher_date")
) -> DataFrame:
    """The row delivered last for each branch and day: a day that is delivered
    again replaces the earlier version, it does not add to it. This holds
    whether both arrive in one run or in two, and however many files a delivery
    is split into."""
    return _latest(feed, keys).drop("delivered_at", "delivered_file")


def read_daily_feed(spark: SparkSession, target: str) -> DataFrame:
    """The live table: the current version of every delivered day."""
    return snapshots.read(spark, target).drop("delivered_at", "delivered_file")


def run_stream_dedup(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    time_col: str = "sale_date",
    settle: Callable[[DataFrame], DataFrame] = latest_stored_sale,
    fmt: str = "parquet",
    max_files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Keep one line per bill, item and day of all bill-line files that arrive,
    in any order: the one that the staging model keeps. ``settle`` may be any
    choice of rows by keys that determine the month of ``time_col``, which keeps a
    column of another name; it is planned twice, for stored and for new rows."""
    arrived = _files(spark, source, schema, fmt, max_files_per_batch)
    _run(arrived, target, checkpoint, time_col, settle, in_place=True)


def read_stream_dedup(spark: SparkSession, target: str) -> DataFrame:
    """The deduplicated lines."""
    return snapshots.read(spark, target)
