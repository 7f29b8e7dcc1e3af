"""The raw tables by name."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = (
    "purchase",
    "dead_stock",
    "stockout",
    "ledger",
    "stock_balance",
    "stock_movement",
    "sales",
    "sales_returns",
)


class Tables(Mapping[str, DataFrame]):
    """Raw tables as lazy DataFrames: ``tables["sales"]``."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    @classmethod
    def load(cls, spark: SparkSession, root: str, names: tuple[str, ...] = RAW_TABLES) -> Tables:
        """Open the Parquet folders below ``root``; nothing is read yet."""
        return cls({n: spark.read.parquet(f"{root}/{n}") for n in names})

    def register(self, prefix: str = "raw_") -> None:
        """Make the tables visible to SQL as temporary views."""
        for name, df in self._frames.items():
            df.createOrReplaceTempView(prefix + name)

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)
