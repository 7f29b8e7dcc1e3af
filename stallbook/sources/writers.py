"""Clean-file and table sinks, full refresh, with a row count that is checked."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stallbook.operators import rows
from stallbook.schemas import schema_for
from stallbook.sources import files


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the namespace unless it is there; without a location its tables lie
    in the warehouse folder."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def write_clean(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the clean copy of a file. Parquet keeps types and can be pruned;
    ``fmt="csv"`` writes a header and no index."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one partition folder together before writing. Rebalancing
    lets AQE split a folder that is much larger than the others over several
    tasks, and merge small ones, so neither a hot month nor thousands of tiny
    files result."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def load_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Full refresh of a catalog table. Each load writes a table of its own,
    ``name__0000001_ab12cd``, and then points the view ``name`` to it: one change in
    the catalog, so readers see the old rows until all new ones are there, and
    keep them if the load fails. The load before stays for queries that began on
    it, earlier ones go. ``bucket_by`` stores rows pre-shuffled for joins and
    aggregates on those columns."""
    spark = df.sparkSession
    space, _, short = name.rpartition(".")
    prefix = f"{space}." if space else ""
    earlier = _loads(spark, space, short)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        # a plain table, loaded in another way: it becomes the first load
        spark.sql(f"ALTER TABLE {name} RENAME TO {prefix}{short}__0000000_plain")
        earlier = [f"{short}__0000000_plain"]
    number = int(earlier[-1].split("__")[-1][:7]) + 1 if earlier else 1
    made = f"{prefix}{short}__{number:07d}_{uuid.uuid4().hex[:6]}"
    writer = _laid_out(df, partition_by).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, cols = bucket_by
        writer = writer.bucketBy(count, *cols).sortBy(*cols)
    writer.saveAsTable(made)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {made}")
    for old in earlier[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{old}")


def _loads(spark: SparkSession, space: str, short: str) -> list[str]:
    """Tables of earlier loads, oldest first."""
    found = [t.name for t in spark.catalog.listTables(space or None)]
    form = re.compile(re.escape(short.lower()) + r"__\d{7}_\w+$")
    return sorted(t for t in found if form.match(t.lower()))


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a table kept as a Parquet folder. The rows are written to
    a folder beside it, which then takes its place by renaming: until then the old
    rows are there, and stay there if the write fails. A load that died between
    the two renames is made good by the next one. For readers that never look at
    a missing folder, and for stores without a rename, see ``snapshots``."""
    spark = df.sparkSession
    path = path.rstrip("/")
    folder, _, short = path.rpartition("/")
    new, old = f"{folder}/_new-{short}-{uuid.uuid4().hex[:12]}", f"{folder}/_old-{short}"
    if files.exists(spark, old):
        if files.exists(spark, path):
            files.delete(spark, old)
        else:
            files.rename(spark, old, path)
    writer = _laid_out(df, partition_by).write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(new)
    except Exception:
        files.delete(spark, new)
        raise
    if files.exists(spark, path):
        files.rename(spark, path, old)
    files.rename(spark, new, path)
    files.delete(spark, old)


def load_report(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> dict[str, int]:
    """Write a table folder and compare the rows written (counted while writing)
    with the rows read back."""
    seen = Observation()
    save_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by)
    written = seen.get["rows"]
    loaded = df.sparkSession.read.parquet(path).count()
    if written != loaded:
        raise RuntimeError(f"{path}: wrote {written} rows, read back {loaded}")
    return {"rows_written": written, "rows_loaded": loaded}


# Raw tables that are large and read by date.
PARTITIONS = {
    "sales": ("sale_year", "sale_month"),
    "sales_returns": ("return_year", "return_month"),
    "ledger": ("year", "month"),
}


def load_all(frames: Mapping[str, DataFrame], root: str) -> dict[str, dict[str, int]]:
    """Load several raw tables with their declared types."""
    return {
        name: load_report(
            rows.typed(df, schema_for(name)), f"{root}/{name}", PARTITIONS.get(name, ())
        )
        for name, df in frames.items()
    }
