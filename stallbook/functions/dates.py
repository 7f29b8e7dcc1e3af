"""Date parsing, calendar parts and date arithmetic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted layouts, tried in this order.
DAY_FIRST = ("d-M-yyyy[ H:mm[:ss]]", "d/M/yyyy[ H:mm[:ss]]", "yyyy-M-d[ H:mm[:ss]]")
MONTH_FIRST = ("yyyy-M-d[ H:mm[:ss]]", "M/d/yyyy[ H:mm[:ss]]", "M-d-yyyy[ H:mm[:ss]]")


def parse_date(c: Column, formats: Sequence[str] = DAY_FIRST, strict: bool = False) -> Column:
    """Text -> date. A text in none of the formats gives null, or fails the job
    when ``strict``; null stays null either way."""
    parsed = F.to_date(F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]))
    if not strict:
        return parsed
    return F.when(
        parsed.isNull() & c.isNotNull(),
        F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date"),
    ).otherwise(parsed)


def as_of_date(as_of: dt.date | str | None) -> Column:
    """Report date: the given day, or today."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def calendar_parts(c: Column, label_format: str = "MMM") -> dict[str, Column]:
    return {
        "year": F.year(c).cast("bigint"),
        "month": F.month(c).cast("bigint"),
        "month_name": F.date_format(c, label_format),
        "quarter": F.quarter(c).cast("bigint"),
        "week": F.weekofyear(c).cast("bigint"),
        "dow": F.date_format(c, "EEEE"),
    }


def calendar(
    df: DataFrame,
    date_col: str,
    prefix: str = "",
    parts: Iterable[str] = ("year", "month", "month_name", "quarter", "week", "dow"),
    label_format: str = "MMM",
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Add calendar columns ``<prefix><part>`` of ``date_col``."""
    made = calendar_parts(F.col(date_col), label_format)
    names = names or {}
    return df.withColumns({names.get(p, prefix + p): made[p] for p in parts})


def iso_year(c: Column) -> Column:
    """Year that the ISO week of the date belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), c).cast("bigint")


def day_diff(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def month_diff(later: Column, earlier: Column) -> Column:
    """Number of month boundaries crossed (31 Jan -> 1 Feb is 1)."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    ).cast("bigint")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")
