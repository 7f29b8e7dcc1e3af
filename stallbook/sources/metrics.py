"""Row counts per cleaning rule, taken in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _count_exprs(dropped_by: Mapping[str, Column]) -> list[Column]:
    """``raw``, then per rule the rows that remain after it and all before it."""
    out = [F.count(F.lit(1)).alias("raw")]
    kept = F.lit(True)
    for step, drops in dropped_by.items():
        kept = kept & ~F.coalesce(drops, F.lit(False))
        out.append(F.count_if(kept).alias(step))
    return out


def with_counts(df: DataFrame, dropped_by: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Observe how many rows survive each rule while the frame is used for
    something else; read ``observation.get`` after the action."""
    seen = Observation()
    return df.observe(seen, *_count_exprs(dropped_by)), seen


def step_counts(df: DataFrame, dropped_by: Mapping[str, Column]) -> DataFrame:
    """The same counts as a table (step, rows), from a single aggregate."""
    wide = df.agg(*_count_exprs(dropped_by))
    return wide.unpivot([], wide.columns, "step", "rows")
