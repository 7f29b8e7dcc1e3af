"""Text clean-up on string columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed at both ends of a text: ASCII and Unicode white space.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (``F.trim`` takes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def upper_trim(c: Column) -> Column:
    return F.upper(strip(c))


def fill_text(c: Column) -> Column:
    """Null becomes the empty string, then strip."""
    return strip(F.coalesce(c, F.lit("")))


def strip_dot_zero(c: Column) -> Column:
    """``"6109.0"`` -> ``"6109"``; codes without that suffix are unchanged."""
    return F.regexp_replace(c, r"\.0$", "")


def contains_ci(c: Column, text: str) -> Column:
    """Case-insensitive contains; null counts as not containing."""
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(text.lower()))


def normalise_name(name: str) -> str:
    """Header text -> column name: ``" Net Amount (Rs.) "`` -> ``net_amount_rs``."""
    return re.sub(r"[^a-z0-9_]", "", name.strip().lower().replace(" ", "_"))
