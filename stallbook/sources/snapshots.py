"""Tables of month folders, changed by commits.

Every commit writes the months that it changes into a new folder and then one
small file that names, for all months, the folder that holds their current rows.
The file appears as a whole: before it, readers see the table as it was, after it
as it is now, and a job that dies in between has changed nothing. What the last
two commits do not name is deleted after a commit, so a reader that began on the
one before can finish.

    root/commits/0000000007      {"version": 7, "months": {"2026-01": "0000000007-ab12"}, ...}
    root/data/0000000007-ab12/_month=2026-01/part-....parquet

One writer at a time; any number of readers.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.sources import files

MONTH = "_month"
#: Key and folder of rows without a date.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
#: False for rows that lie together by month already, if a frame to write has it.
FRESH = "_fresh"


@dataclasses.dataclass(frozen=True)
class Snapshot:
    """A state of the table: the folder of each month's rows, and their schema; for
    a table made from another one, the folders of that table which it covers."""

    version: int
    months: Mapping[str, str]
    schema: T.StructType
    source: Mapping[str, str] = dataclasses.field(default_factory=dict)

    def text(self) -> bytes:
        state = {
            "version": self.version,
            "months": dict(self.months),
            "schema": self.schema.jsonValue(),
            "source": dict(self.source),
        }
        return json.dumps(state).encode()

    @staticmethod
    def parse(raw: bytes) -> Snapshot:
        state = json.loads(raw)
        schema = T.StructType.fromJson(state["schema"])
        return Snapshot(state["version"], state["months"], schema, state["source"])


def _name(version: int) -> str:
    return f"{version:010d}"


def _committed(spark: SparkSession, root: str) -> list[str]:
    """Names of the commits, oldest first; half-written files have another form."""
    return [n for n in files.names(spark, f"{root}/commits") if n.isdigit()]


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The last committed state; none for a table that nothing was written to."""
    found = _committed(spark, root)
    return Snapshot.parse(files.head(spark, f"{root}/commits/{found[-1]}")) if found else None


def month_of(day: str):
    return F.date_format(day, "yyyy-MM")


def read(
    spark: SparkSession, root: str, state: Snapshot | None = None, months: Iterable[str | None] | None = None
) -> DataFrame:
    """The rows of a state (the last one), of all months or of those named (None:
    rows without a date). Only the folders of these months are opened."""
    state = state or current(spark, root)
    if state is None:
        raise ValueError(f"{root}: nothing was committed here")
    keys = state.months if months is None else {m or NO_MONTH for m in months} & set(state.months)
    paths = [f"{root}/data/{state.months[m]}/{MONTH}={m}" for m in sorted(keys)]
    if not paths:
        return spark.createDataFrame([], state.schema)
    return spark.read.schema(state.schema).parquet(*paths)


def write(
    df: DataFrame,
    root: str,
    day: str,
    base: Snapshot | None,
    replaced: Iterable[str] = (),
    source: Mapping[str, str] | None = None,
) -> Snapshot:
    """Replace the months that ``df`` has rows of, and those named in ``replaced``
    (which may have none any more), and keep all others of ``base``. A month much
    larger than others is split over tasks, small ones share one. Rows that are not
    ``FRESH`` are written by the tasks that read them."""
    spark = df.sparkSession
    version = base.version + 1 if base else 0
    folder = f"{_name(version)}-{uuid.uuid4().hex[:12]}"
    rows = df.withColumn(MONTH, month_of(day))
    if FRESH in df.columns:
        there, fresh = rows.where(~F.col(FRESH)), rows.where(FRESH).hint("rebalance", MONTH)
        rows = there.unionByName(fresh).drop(FRESH)
    else:
        rows = rows.hint("rebalance", MONTH)
    rows.write.option("compression", "zstd").partitionBy(MONTH).parquet(f"{root}/data/{folder}")
    written = [n.split("=", 1)[1] for n in files.names(spark, f"{root}/data/{folder}") if "=" in n]
    gone = set(replaced)
    months = {m: f for m, f in (base.months if base else {}).items() if m not in gone}
    months |= dict.fromkeys(written, folder)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name != FRESH])
    state = Snapshot(version, months, schema, source or {})
    files.write_small(spark, f"{root}/commits/{_name(version)}", state.text())
    return state


def refresh(
    spark: SparkSession, source: str, root: str, make: Callable[[DataFrame], DataFrame], day: str
) -> list[str]:
    """Bring a table up to date that is made month by month from another one:
    ``make`` gets the source's rows of those months only that were committed since
    the last refresh, and its result replaces them. Returns these months.

    The commit names the source's folders that it covers, so a refresh that died
    is simply run again, and months that vanished from the source go."""
    state, base = current(spark, source), current(spark, root)
    if state is None:
        raise ValueError(f"{source}: nothing was committed here")
    covered = base.source if base else {}
    changed = sorted(m for m, f in state.months.items() if covered.get(m) != f)
    gone = sorted(covered.keys() - state.months.keys())
    if changed or gone or base is None:
        rows = read(spark, source, state, changed)
        write(make(rows), root, day, base, replaced=[*changed, *gone], source=state.months)
        clean(spark, root)
    return changed


def clean(spark: SparkSession, root: str) -> None:
    """Delete what neither the last commit nor the one before names: replaced
    months, and folders that a job left which died before its commit."""
    commits = _committed(spark, root)
    kept = [Snapshot.parse(files.head(spark, f"{root}/commits/{n}")) for n in commits[-2:]]
    used = {(folder, month) for s in kept for month, folder in s.months.items()}
    for name in commits[:-2]:
        files.delete(spark, f"{root}/commits/{name}")
    folders = {folder for folder, _ in used}
    for folder in files.names(spark, f"{root}/data"):
        if folder not in folders:
            files.delete(spark, f"{root}/data/{folder}")
            continue
        for part in files.names(spark, f"{root}/data/{folder}"):
            if "=" in part and (folder, part.split("=", 1)[1]) not in used:
                files.delete(spark, f"{root}/data/{folder}/{part}")
