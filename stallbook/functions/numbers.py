"""Numeric helpers whose null, zero and rounding rules are spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = "decimal(28,2)"
# Money is added up in units of 1/100000; a sum of units is kept as a high and a
# low part of 20 bits, so that neither overflows. What lies above 2^40 and below a
# unit has sums of its own.
PLACES = 5
LOW_BITS = 20
TOP = 2**40
REST_PLACES = 13


def parse_number(c: Column) -> Column:
    """Text -> double; unreadable text and "nan" give null."""
    parsed = c.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def num_or_zero(c: Column) -> Column:
    """Parse a number leniently: unreadable text and null give 0."""
    return F.coalesce(parse_number(c), F.lit(0.0))


def safe_ratio(num: Column, den: Column, scale: float = 1, digits: int | None = None) -> Column:
    """``num / den * scale`` in double; null when the denominator is 0 or null."""
    out = F.try_divide(num.cast("double"), den.cast("double"))
    if scale != 1:
        out = out * F.lit(float(scale))
    return out if digits is None else F.round(out, digits)


def greatest0(c: Column) -> Column:
    """``greatest(0, c)`` that keeps null (Spark's ``greatest`` skips nulls)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0), c))


def round_half_even(c: Column, digits: int) -> Column:
    """Half-to-even rounding in double arithmetic, as data-frame libraries round."""
    factor = float(10**digits)
    return F.rint(c.cast("double") * factor) / F.lit(factor)


def exact_sum(c: Column) -> Column:
    """Sum of doubles as decimal, to 13 places, whatever the order of rows.

    A sum of doubles depends on the order in which partitions are merged, so a
    repeated run could rank or join differently. A decimal sum does not, but
    beyond 18 digits it handles an object per row. Here every value is cut into
    whole numbers: its part above 2^40, units of 1/100000 in two halves, and the
    rest below a unit. Totals up to 1e22 fit. For
    sums of sums use ``F.sum`` on the decimals.
    """
    value = c.cast("double")
    top = (value / F.lit(float(TOP))).cast("bigint")  # towards zero
    inner = value - top * F.lit(float(TOP))
    units = F.rint(inner * F.lit(float(10**PLACES))).cast("bigint")
    rest = inner - units / F.lit(float(10**PLACES))
    # Decimals are objects: few steps, each wide enough for the sums of longs.
    whole = "decimal(19,0)"
    tops = F.sum(top).cast(whole) * F.lit(TOP * 10**PLACES).cast("decimal(18,0)")
    highs = F.sum(F.shiftright(units, LOW_BITS)).cast(whole) * F.lit(2**LOW_BITS).cast("decimal(7,0)")
    lows = F.sum(units.bitwiseAND(F.lit(2**LOW_BITS - 1))).cast(whole)
    rests = F.sum(F.rint(rest * F.lit(float(10**REST_PLACES))).cast("bigint")).cast(whole)

    def unit(places: int) -> Column:
        return F.lit(f"1e-{places}").cast(f"decimal({places + 1},{places})")

    main = ((tops + highs + lows) * unit(PLACES)).cast("decimal(36,13)")
    total = (main + rests * unit(REST_PLACES)).cast("decimal(36,13)")
    return total


def mean(c: Column, digits: int | None = None) -> Column:
    """Average of line values: exact sum over the count of non-null values."""
    return safe_ratio(exact_sum(c), F.count(c), digits=digits)


def where(predicate: Column, c: Column) -> Column:
    """The value where the predicate holds, 0 elsewhere: a conditional sum is
    ``exact_sum(where(p, c))``."""
    return F.when(predicate, c).otherwise(F.lit(0))


def sum_if(predicate: Column, c: Column) -> Column:
    """Sum of a count or quantity where the predicate holds, 0 elsewhere."""
    return F.sum(where(predicate, c))


def max_if(predicate: Column, c: Column) -> Column:
    """Maximum where the predicate holds; null when it never does."""
    return F.max(F.when(predicate, c))
