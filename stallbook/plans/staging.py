"""Staging models: branch aliases, types, deduplication, healthy items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.config import RetailConfig
from stallbook.functions import rules
from stallbook.functions.numbers import exact_sum, mean
from stallbook.operators.joins import anti_join
from stallbook.operators.shared import share
from stallbook.operators.windows import dedup_latest, dedup_stored

SALES_COLUMNS = (
    "company_name voucher_type sale_date voucher_no customer_ref stock_no "
    "item_description product brand style shade size base_uom retail_price sales_qty "
    "line_revenue full_mrp_value discount_given discount_pct is_b2b sale_year sale_month "
    "sale_month_name sale_quarter sale_week sale_dow"
).split()
SALES_KEYS = ("company_name", "voucher_no", "stock_no", "sale_date")
# Breaks ties between lines of equal revenue; calendar columns follow the key.
SALES_TIEBREAK = tuple(
    c
    for c in SALES_COLUMNS
    if c not in SALES_KEYS
    and c not in ("line_revenue", "sales_qty", "full_mrp_value")
    and not c.startswith("sale_")
)

RETURNS_COLUMNS = (
    "company_name voucher_type return_date voucher_no customer_ref stock_no "
    "item_description product brand style shade size base_uom retail_price return_qty "
    "return_value return_value_per_unit has_customer_name return_year return_month "
    "return_month_name return_quarter"
).split()

LEDGER_COLUMNS = (
    "company_name city voucher_date voucher_no voucher_type particulars narration "
    "user_name inwards_qty outwards_qty debit_amount credit_amount amount "
    "expense_category branch_type is_active year month month_name week quarter day_of_week"
).split()

PURCHASE_COLUMNS = (
    "company_name stock_no item_description product brand style shade size voucher_no "
    "voucher_type voucher_date supplier_name purchase_qty retail_price item_rate "
    "item_net_amount tax_amount net_amount"
).split()

MOVEMENT_COLUMNS = (
    "company_name stock_no item_description product brand style shade size hsn_code "
    "supplier_name cost_price retail_price margin_pct base_uom opening_qty opening_val "
    "inwards_qty outwards_qty closing_qty closing_val sell_through_pct capital_locked "
    "retail_value_closing movement_status"
).split()

STOCK_REPORT_COLUMNS = (
    "company_name stock_no item_description product brand style shade size "
    "last_purchase_date last_sold_date retail_price closing_bal_qty"
).split()

DATE_COLUMNS = frozenset(
    "sale_date return_date voucher_date last_purchase_date last_sold_date".split()
)


def _money(*names: str) -> dict[str, Column]:
    """Amounts per line are double; sums over lines are exact decimals."""
    return {n: F.col(n).cast("double") for n in names}


def _whole(*names: str) -> dict[str, Column]:
    """Whole numbers: rounded half away from zero, where Spark would truncate."""
    return {n: F.round(F.col(n)).cast("bigint") for n in names}


def _project(
    df: DataFrame, columns: list[str], cfg: RetailConfig, **casts: Column
) -> DataFrame:
    """Select the model's columns with the branch alias and the casts applied."""
    made = {"company_name": rules.canonical_branch(F.col("company_name"), cfg)}
    made |= {c: F.col(c).cast("date") for c in columns if c in DATE_COLUMNS}
    made |= casts
    return df.select(*[made.get(c, F.col(c)).alias(c) for c in columns])


def _highest_revenue() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ("line_revenue", "sales_qty", "full_mrp_value")]


def latest_sale(lines: DataFrame) -> DataFrame:
    """One bill line per (branch, bill, SKU, date): the one with the highest
    revenue."""
    return dedup_latest(lines, SALES_KEYS, _highest_revenue(), SALES_TIEBREAK)


def latest_stored_sale(lines: DataFrame) -> DataFrame:
    """:func:`latest_sale` for stored lines, which are read twice: looks for repeated
    keys at once and moves only their lines."""
    return dedup_stored(lines, SALES_KEYS, _highest_revenue(), SALES_TIEBREAK)


def settled_stored_sale(lines: DataFrame) -> DataFrame:
    """:func:`latest_stored_sale` for a result that several models read: lines that had
    to be moved are stored, all others are read where they are."""
    return dedup_stored(lines, SALES_KEYS, _highest_revenue(), SALES_TIEBREAK, settled=share)


def stg_sales(
    raw: DataFrame,
    cfg: RetailConfig,
    settle: Callable[[DataFrame], DataFrame] = latest_sale,
) -> DataFrame:
    """Bill lines without repetition. Aliases are applied before, so an old and
    a new branch name meet. For a stored table, ``settle`` may be
    :func:`latest_stored_sale`."""
    money = _money("line_revenue", "full_mrp_value", "discount_given")
    return settle(_project(raw, SALES_COLUMNS, cfg, **money))


def stg_stored_sales(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return stg_sales(raw, cfg, latest_stored_sale)


def stg_sales_returns(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _project(raw, RETURNS_COLUMNS, cfg, **_money("return_value"))


def stg_ledger(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Dated vouchers that are not sub-total lines; null particulars are dropped
    by the negated ``like``."""
    kept = raw.filter(
        F.col("voucher_date").isNotNull() & ~F.col("particulars").like("%Sub Total%")
    )
    return _project(
        kept,
        LEDGER_COLUMNS,
        cfg,
        voucher_no=F.col("voucher_no").cast("string"),
        is_active=F.col("is_active").cast("boolean"),
        **_money("debit_amount", "credit_amount", "amount"),
        **_whole("inwards_qty", "outwards_qty", "year", "month", "week", "quarter"),
    )


def stg_purchases(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _project(
        raw.filter(F.col("stock_no").isNotNull()),
        PURCHASE_COLUMNS,
        cfg,
        **_whole("purchase_qty"),
        **_money(
            "retail_price", "item_rate", "item_net_amount", "tax_amount", "net_amount"
        ),
    )


def stg_dead_stock(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _project(
        raw.filter(F.col("stock_no").isNotNull()),
        STOCK_REPORT_COLUMNS + ["closing_bal_value", "sales_qty"],
        cfg,
        **_whole("closing_bal_qty", "sales_qty"),
        **_money("retail_price", "closing_bal_value"),
    )


def stg_stockouts(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    return _project(
        raw.filter(F.col("stock_no").isNotNull()),
        STOCK_REPORT_COLUMNS + ["sales_qty", "sales_value"],
        cfg,
        **_whole("closing_bal_qty", "sales_qty"),
        **_money("retail_price", "sales_value"),
    )


def stg_stock_balance(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Stock on hand with its value bucket. ``capital_locked`` is the closing
    value as delivered, not the rounded column of the clean table."""
    return raw.select(
        rules.canonical_branch(F.col("company_name"), cfg).alias("company_name"),
        "stock_no",
        "item_description",
        "product",
        "brand",
        "style",
        F.col("shade").cast("string").alias("shade"),
        F.col("size").cast("string").alias("size"),
        "hsn_code",
        "item_type",
        "supplier_name",
        "cost_price",
        "retail_price",
        "base_uom",
        "closing_qty",
        "closing_rate",
        F.col("closing_value").alias("capital_locked"),
        "margin_pct",
        "retail_value",
        rules.stock_value_bucket(cfg, F.col("closing_value")).alias("stock_value_bucket"),
        F.coalesce(F.col("cost_price") > F.col("retail_price"), F.lit(False)).alias(
            "is_negative_margin"
        ),
    )


def stg_stock_movement(raw: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Movement per branch and SKU with sell-through tier and stagnant capital."""
    df = _project(
        raw,
        MOVEMENT_COLUMNS,
        cfg,
        shade=F.col("shade").cast("string"),
        size=F.col("size").cast("string"),
    )
    return df.withColumns(
        {
            "velocity_tier": rules.sell_through_tier(
                cfg,
                F.col("sell_through_pct"),
                F.col("inwards_qty"),
                F.col("outwards_qty"),
                F.col("closing_qty"),
            ),
            "stagnant_capital": F.when(
                F.col("movement_status") == "Stagnant", F.col("capital_locked")
            ).otherwise(F.lit(0)),
        }
    )


ITEM_KEYS = (
    "company_name",
    "stock_no",
    "item_description",
    "product",
    "brand",
    "style",
    "shade",
    "size",
)


def healthy_items(
    purchases: DataFrame, dead_stock: DataFrame, stockouts: DataFrame, cfg: RetailConfig
) -> DataFrame:
    """Purchased items that are neither dead stock nor sold out at the same
    branch. A null branch fails the ``NOT IN`` and is dropped.

    Lines are aggregated first, so the joins see one row per item and a hot SKU
    is reduced on the map side. When the excluded sets are small enough to be
    broadcast, Catalyst moves the anti-joins below the aggregate by itself.
    """
    keys = ["company_name", "stock_no"]
    items = (
        purchases.filter(~F.col("company_name").isin(*cfg.non_selling))
        .groupBy(*ITEM_KEYS)
        .agg(
            F.max("retail_price").alias("retail_price"),
            F.sum("purchase_qty").alias("total_purchase_qty"),
            exact_sum(F.col("item_net_amount")).alias("total_purchase_value"),
            mean(F.col("item_rate")).alias("avg_item_rate"),
            F.min("voucher_date").alias("first_purchase_date"),
            F.max("voucher_date").alias("last_purchase_date"),
        )
    )
    return anti_join(anti_join(items, dead_stock, keys), stockouts, keys)
