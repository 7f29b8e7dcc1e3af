"""Date layouts found from the cells.

A file is written in one layout, but its cells do not say which: 03-04-2026 is a
day in April or in March. One aggregate counts, for each file and column, how many
cells each layout reads and how many cells two layouts read as different days; the
layout that reads most cells of a file is taken for all of them. So a cell is never
read in two ways within a file, and what is dropped is counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import text
from stallbook.functions.dates import DAY_FIRST, MONTH_FIRST

#: Day before month where cells leave it open: first in a tie.
LAYOUTS = tuple(dict.fromkeys([*DAY_FIRST, *MONTH_FIRST]))


def _read(cell: Column, layout: str) -> Column:
    return F.to_date(F.try_to_timestamp(cell, F.lit(layout)))


def find_layouts(
    df: DataFrame, file: str, column: str, layouts: Sequence[str] = LAYOUTS
) -> DataFrame:
    """One row for each value of ``file``: the ``layout`` that reads most of its
    filled cells (the earlier one of ``layouts`` in a tie, null if none reads any),
    the number of ``cells``, how many are ``read`` and ``dropped`` with it, and how
    many are ``ambiguous``: two layouts read them as different days."""
    cell = text.strip(F.col(column))
    days = {f"_{i}": _read(cell, layout) for i, layout in enumerate(layouts)}
    filled = df.select(F.col(file), cell.alias("_cell"), *[c.alias(n) for n, c in days.items()])
    filled = filled.where(F.col("_cell") != "")
    earliest, latest = F.least(*days), F.greatest(*days)  # both skip nulls
    counted = filled.groupBy(file).agg(
        F.count(F.lit(1)).alias("cells"),
        *[F.count(n).alias(n) for n in days],
        F.count(F.when(earliest != latest, 1)).alias("ambiguous"),
    )
    most = F.greatest(*days)
    choice = F.coalesce(*[F.when(F.col(n) == most, F.lit(f)) for n, f in zip(days, layouts)])
    return counted.select(
        file,
        F.when(most > 0, choice).alias("layout"),
        "cells",
        most.alias("read"),
        (F.col("cells") - most).alias("dropped"),
        "ambiguous",
    )


def parse_found(
    df: DataFrame,
    file: str,
    column: str,
    found: DataFrame | None = None,
    layouts: Sequence[str] = LAYOUTS,
) -> DataFrame:
    """``df`` with ``column`` as date, read in each file's own layout; cells that
    it does not read are null. ``found`` is the result of :func:`find_layouts`, a
    row for each file, so the join moves no rows unless there are very many files."""
    found = find_layouts(df, file, column, layouts) if found is None else found
    choice = found.select(F.col(file).alias("_file"), F.col("layout").alias("_layout"))
    joined = df.join(choice, F.col(file).eqNullSafe(F.col("_file")), "left")
    cell = text.strip(F.col(column))
    day = F.coalesce(*[F.when(F.col("_layout") == f, _read(cell, f)) for f in layouts])
    return joined.withColumn(column, day).drop("_file", "_layout")
