"""Results that several plans read: computed once, kept on reliable storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate results that all executors share: the one that
    ``spark.checkpoint.dir`` names, or that the caller set on the context."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(current)
    return current


def shared_root(spark: SparkSession) -> str:
    """Where this application keeps its shared results."""
    return f"{checkpoint_dir(spark)}/shared-{spark.sparkContext.applicationId}"


#: Paths made inside the open ``shared_results`` blocks, innermost last.
_open: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared results, cleared together with them."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _open:
        made.append(path)
    return path


def share(df: DataFrame) -> DataFrame:
    """Compute once, keep as a Parquet table in the checkpoint folder, and read
    it back. Plans that use the result twice do not run its inputs twice, a lost
    executor costs a re-read and not a re-run, and each reader loads only its
    columns (a row checkpoint would be read in full). The size of the files is
    known to the planner, so small results are broadcast in joins."""
    spark = df.sparkSession
    path = scratch(spark, "result")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *steps: Callable[[], Result]) -> list[Result]:
    """The results of steps that do not need each other. Their jobs run beside each
    other: cores that one has no more tasks for take those of the next. If a step
    fails, its error is raised after the others have ended."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shared_results(spark: SparkSession) -> Iterator[None]:
    """What is shared inside the block is deleted at its end, also if it fails:
    frames that read it cannot be used afterwards."""
    made: list[str] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for path in made:
            _delete(spark, path)


def clear_shared(spark: SparkSession) -> None:
    """Delete all shared results of this application, at the end of a job."""
    _delete(spark, shared_root(spark))
