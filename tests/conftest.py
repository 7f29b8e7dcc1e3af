from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Frames:
    """Small frames from dicts; columns that a row leaves out are null."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __call__(self, schema: str, *rows: dict, **defaults):
        kinds = dict(c.split() for c in schema.split(","))

        def value(row: dict, name: str):
            v = (defaults | row).get(name)
            return float(v) if kinds[name] == "double" and v is not None else v

        data = [tuple(value(r, n) for n in kinds) for r in rows]
        return self.spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def frame(spark):
    return Frames(spark)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
