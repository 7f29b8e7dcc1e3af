"""Column types found from text, in one pass over all cells.

Types form an order: whole numbers are numbers, dates are timestamps, and all are
text. A column gets the narrowest type that every cell fits. Each cell says which
types it fits; "all fit" of a column is the minimum over its cells, so tasks and
partitions merge without order, and the driver gets one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import text

#: Narrowest first. A column of one kind never fits another one of these and
#: both, but for whole numbers, which are numbers, and dates, which are timestamps.
KINDS = ("boolean", "bigint", "double", "date", "timestamp")

_WHOLE = r"^[+-]?(0|[1-9][0-9]{0,17})$"
_NUMBER = r"^[+-]?(0|[1-9][0-9]*)?([.][0-9]*)?([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_ZONE = "(Z|[+-][0-9]{2}:?[0-9]{2})"
_TIME = _DATE[:-1] + rf"([ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]{{1,6}})?)?{_ZONE}?)?$"


def cell_fits(c: Column) -> dict[str, Column]:
    """Whether a trimmed cell can be read as each kind without losing anything:
    codes with leading zeros and numbers beyond 18 digits are no whole numbers.
    One character tells most cells that are no number, or no date, before any
    pattern is tried."""
    numeral = F.substring(c, 1, 1).isin(*"+-.0123456789")
    dashed = F.substring(c, 5, 1) == "-"
    number = c.rlike(_NUMBER) & c.rlike("[0-9]") & c.try_cast("double").isNotNull()
    return {
        "boolean": (F.length(c) <= 5) & F.lower(c).isin("true", "false"),
        "bigint": numeral & c.rlike(_WHOLE),
        "double": numeral & number,
        "date": dashed & c.rlike(_DATE) & F.try_to_date(c, "yyyy-MM-dd").isNotNull(),
        "timestamp": dashed & c.rlike(_TIME) & c.try_cast("timestamp").isNotNull(),
    }


def infer_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type of each text column, in the order of the columns. Null
    and blank cells fit every type; a column without other cells stays text."""
    found = _profile(df)
    return {name: kind for name, (kind, _) in found.items()}


def _fits(df: DataFrame) -> DataFrame:
    """One row: how many cells of each column are filled, and whether all of
    them fit each kind."""
    # Each cell is stripped once; blank ones are null, which fits nothing and counts nothing.
    stripped = [text.strip(F.col("`" + c.replace("`", "``") + "`")) for c in df.columns]
    cells = df.select(*[F.nullif(c, F.lit("")).alias(f"{i}") for i, c in enumerate(stripped)])
    wanted = []
    for i in range(len(df.columns)):
        c = F.col(f"{i}")
        wanted.append(F.count(c).alias(f"{i} n"))
        for kind, fits in cell_fits(c).items():
            wanted.append(F.min(F.when(c.isNotNull(), fits)).alias(f"{i} {kind}"))
    return cells.agg(*wanted)


def _profile(df: DataFrame) -> dict[str, tuple[str, int]]:
    row = _fits(df).first() if df.columns else {}
    out = {}
    for i, name in enumerate(df.columns):
        kinds = [k for k in KINDS if row[f"{i} {k}"]]
        out[name] = (kinds[0] if kinds else "string", row[f"{i} n"])
    return out


def profile(df: DataFrame) -> DataFrame:
    """(column, type, filled): the type of each column and how many cells are
    filled; one row for each column."""
    rows = [(name, kind, n) for name, (kind, n) in _profile(df).items()]
    return df.sparkSession.createDataFrame(rows, "column string, type string, filled long")


def typed(df: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """The columns cast to their types, found ones unless given; blank cells of a
    column that is no text are null."""
    kinds = infer_types(df) if kinds is None else kinds

    def cast(name: str) -> Column:
        c = F.col("`" + name.replace("`", "``") + "`")
        kind = kinds.get(name, "string")
        if kind == "string":
            return c.alias(name)
        cell = text.strip(c)
        return F.when(cell != "", cell).cast(kind).alias(name)

    return df.select(*[cast(n) for n in df.columns])
