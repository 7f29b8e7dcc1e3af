"""Approximate distinct counts that merge (HyperLogLog sketches).

Exact counts are the default everywhere. A sketch is for counts over periods and
groups that are not known in advance: sketches of months and items are stored
once, and any union of them gives a count without reading a line again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's registers, a byte each once it is full: 16 KB; a sketch of
#: few values holds just these.
LG_K = 14
ITEM = ("company_name", "stock_no", "item_description", "product", "brand")


def relative_error(lg_k: int = LG_K, sigmas: float = 4) -> float:
    """Bound of the error of an estimate, as a share of the exact count: a union's
    standard deviation is 1.04 / sqrt(registers)."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def sketched(df: DataFrame, keys: Sequence[str], column: str, name: str, lg_k: int = LG_K) -> DataFrame:
    """One sketch of the distinct values of ``column`` for each group. Nulls do not
    count; tasks sketch before the shuffle, so a hot group is one row of each."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_k).alias(name))


def merged_count(df: DataFrame, keys: Sequence[str], sketch: str, name: str) -> DataFrame:
    """The distinct count of the union of sketches, by ``keys``."""
    union = F.hll_union_agg(sketch)
    return df.groupBy(*keys).agg(F.hll_sketch_estimate(union).alias(name))


def bills_by_month(sales: DataFrame) -> DataFrame:
    """Sketches of the bills of each item, branch and month."""
    dated = sales.withColumn("month", F.trunc("sale_date", "month"))
    return sketched(dated, [*ITEM, "month"], "voucher_no", "bills")
