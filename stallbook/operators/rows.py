"""Row filters and projections used by the cleaning and staging plans."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions import text


def normalise_columns(df: DataFrame) -> DataFrame:
    """Header texts -> snake-case names. Changes the schema only, runs no job."""
    names = [text.normalise_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalising: {sorted(names)}")
    return df.toDF(*names)


def apply_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the header by ``names``, by position."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, file has {len(df.columns)}")
    return df.toDF(*names)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every string column, in one projection."""
    return df.select(
        *[
            text.strip(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def with_existing(df: DataFrame, cols: Collection[str], fn) -> DataFrame:
    """Apply a column function to those of ``cols`` that the frame has."""
    return df.withColumns({c: fn(F.col(c)) for c in cols if c in df.columns})


def fill_text(df: DataFrame, cols: Collection[str]) -> DataFrame:
    return with_existing(df, cols, text.fill_text)


def upper_trim(df: DataFrame, cols: Collection[str]) -> DataFrame:
    return with_existing(df, cols, text.upper_trim)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose text is neither null nor white space."""
    return df.filter(text.strip(F.col(col)) != "")


def drop_matching(df: DataFrame, col: str, needle: str) -> DataFrame:
    """Drop rows whose text contains ``needle`` in any letter case; null stays."""
    return df.filter(~text.contains_ci(F.col(col), needle))


def excluded(c: Column, values: Collection[str]) -> Column:
    """True where the value is one of ``values``; false (not null) for null."""
    return F.coalesce(c.isin(*values), F.lit(False))


def exclude_values(df: DataFrame, col: str, values: Collection[str]) -> DataFrame:
    """``NOT IN`` that keeps null."""
    return df.filter(~excluded(F.col(col), values))


def keep_values(df: DataFrame, col: str, values: Collection[str]) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to a declared schema. Fractions going to an integer type
    are rounded half away from zero, not truncated."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def convert(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegralType):
            if isinstance(kinds[f.name], T.StringType):
                c = c.try_cast("decimal(38,6)")
            if not isinstance(kinds[f.name], T.IntegralType):
                c = F.round(c)
        return c.cast(f.dataType).alias(f.name)

    return df.select(*[convert(f) for f in schema.fields])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def sorted_by(df: DataFrame, *keys: str) -> DataFrame:
    """Report order, e.g. ``sorted_by(df, "txn_year", "-net_revenue")``. Nulls are
    first ascending and last descending. For display only: sorting before a
    table write costs a range shuffle and is lost on the next read."""
    return df.orderBy(
        *[
            F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_first()
            for k in keys
        ]
    )


def as_double(df: DataFrame) -> DataFrame:
    """Decimal columns as double: the column types a report reader expects."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def combine_history(history: DataFrame, live: DataFrame) -> DataFrame:
    """Stack closed history and the live feed; columns missing on one side are null."""
    return history.unionByName(live, allowMissingColumns=True)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Distribution of a categorical column, most frequent first."""
    return (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.col(col).asc_nulls_first())
    )


def distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """``count(distinct column)`` by ``keys``, from (keys, column) pairs. Two such
    counts in one aggregate would copy every row for each of them, with all sums
    that stand beside; pairs are narrow, and copies go before the shuffle."""
    pairs = df.select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.count(column).alias(name))
