"""Intermediate models: velocity, net sales, product performance, daily P&L,
transfer opportunities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.config import EXPENSE_COLUMNS, RetailConfig
from stallbook.functions import dates, rules
from stallbook.functions.numbers import (
    CENTS,
    exact_sum,
    greatest0,
    mean,
    safe_ratio,
    sum_if,
    where,
)
from stallbook.operators.joins import groups_with_counts, left_join, pair_join
from stallbook.operators.windows import add_ranks

ITEM = ("company_name", "stock_no", "item_description", "product", "brand")
#: Columns of a bill line that the velocity reads.
VELOCITY_LINE = (
    *ITEM, "voucher_no", "sale_date", "is_b2b", "sales_qty", "line_revenue", "full_mrp_value",
    "discount_given",
)


def _item_sums() -> list[Column]:
    b2b = F.col("is_b2b")
    return [
        F.sum("sales_qty").alias("total_units_sold"),
        exact_sum(F.col("line_revenue")).alias("total_revenue"),
        exact_sum(F.col("full_mrp_value")).alias("total_mrp_value"),
        exact_sum(F.col("discount_given")).alias("total_discount"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
        sum_if(b2b, F.col("sales_qty")).alias("b2b_units"),
        exact_sum(where(b2b, F.col("line_revenue"))).alias("b2b_revenue"),
        sum_if(~b2b, F.col("sales_qty")).alias("retail_units"),
        exact_sum(where(~b2b, F.col("line_revenue"))).alias("retail_revenue"),
    ]


Grouping = Callable[[DataFrame, Sequence[str], Sequence[Column], Mapping[str, str]], DataFrame]


def inventory_velocity(
    sales: DataFrame,
    cfg: RetailConfig,
    as_of: dt.date | str | None = None,
    group: Grouping = groups_with_counts,
) -> DataFrame:
    """How fast each item sells at each branch, from deduplicated bill lines.

    The grain includes description, product and brand: an SKU billed under two
    descriptions has two rows. ``sales`` is read three times, for its sums, days
    and bills, and should be a stored result; ``VELOCITY_LINE`` is all it needs. Of
    stored lines, ``group`` may be ``joins.stored_groups_with_counts``.
    """
    counts = {"num_bills": "voucher_no", "days_with_sales": "sale_date"}
    lines = sales.select(*VELOCITY_LINE)
    return velocity_of(group(lines, ITEM, _item_sums(), counts), cfg, as_of)


def velocity_months(sales: DataFrame) -> DataFrame:
    """What :func:`inventory_velocity` needs of a month, per item: sums, first and
    last day, and the number of days, which add up over months. ``month`` is the
    first of the month. Its days are bits of a number, so they need no pairs and no
    join."""
    month = F.trunc("sale_date", "month").alias("month")
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth("sale_date") - 1)
    days = F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).cast("bigint")
    return sales.groupBy(*ITEM, month).agg(*_item_sums(), days.alias("days_with_sales"))


def bill_months(sales: DataFrame) -> DataFrame:
    """The bills of a month, per item: (item, bill) pairs, since a bill number may
    come again in another month."""
    month = F.trunc("sale_date", "month").alias("month")
    return sales.select(*ITEM, month, "voucher_no").distinct()


def velocity_from_months(
    months: DataFrame, bills: DataFrame, cfg: RetailConfig, as_of: dt.date | str | None = None
) -> DataFrame:
    """The same rows as :func:`inventory_velocity`, from the stored months."""
    ends = {"first_sale_date": F.min, "last_sale_date": F.max}
    kinds = {f.name: f.dataType for f in months.schema.fields if f.name != "month"}
    # a row for each bill of an item stands beside its months: one aggregate takes both
    pairs = bills.select(*ITEM, "voucher_no").distinct()
    per_bill = pairs.select(*ITEM, F.when(F.col("voucher_no").isNotNull(), 1).alias("num_bills"))
    per_item = (
        months.drop("month")
        .unionByName(per_bill, allowMissingColumns=True)
        .groupBy(*ITEM)
        .agg(
            *[
                ends.get(c, F.sum)(c).cast(kind).alias(c)
                for c, kind in kinds.items()
                if c not in ITEM
            ],
            F.count("num_bills").alias("num_bills"),
        )
    )
    return velocity_of(per_item, cfg, as_of)


def velocity_of(per_item: DataFrame, cfg: RetailConfig, as_of: dt.date | str | None) -> DataFrame:
    """Prices, paces and tiers of items that are summed up."""
    first, last = F.col("first_sale_date"), F.col("last_sale_date")
    per_item = per_item.withColumns(
        {
            "avg_selling_price": safe_ratio(
                F.col("total_revenue"), F.col("total_units_sold"), digits=2
            ),
            "avg_discount_pct": safe_ratio(
                F.col("total_discount"), F.col("total_mrp_value"), 100, digits=2
            ),
            "days_since_first_sale": dates.day_diff(dates.as_of_date(as_of), first),
            "selling_period_days": dates.day_diff(last, first) + 1,
        }
    )
    period = F.col("selling_period_days")
    return per_item.withColumns(
        {
            "units_per_day": safe_ratio(F.col("total_units_sold"), period, digits=4),
            "revenue_per_day": safe_ratio(F.col("total_revenue"), period, digits=2),
        }
    ).withColumns(
        {
            "velocity_tier": rules.units_per_day_tier(cfg, F.col("units_per_day")),
            # filled where stock is known: in the action board
            "days_of_stock_remaining": F.lit(None).cast("double"),
        }
    )


def net_sales(sales: DataFrame, returns: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Sales less returns per SKU, branch and month; never below zero. Returns
    in a month without a sale of that SKU do not appear."""
    return net_of_months(sold_months(sales), returned_months(returns), cfg)


def sold_months(sales: DataFrame) -> DataFrame:
    """Sales per item and month; no month needs another one's lines."""
    is_b2b = F.col("is_b2b")
    return sales.groupBy(
        *ITEM,
        F.col("sale_year").alias("txn_year"),
        F.col("sale_month").alias("txn_month"),
        F.col("sale_month_name").alias("txn_month_name"),
        F.col("sale_quarter").alias("txn_quarter"),
    ).agg(
        F.sum("sales_qty").alias("gross_units_sold"),
        exact_sum(F.col("line_revenue")).alias("gross_revenue"),
        exact_sum(F.col("discount_given")).alias("total_discount"),
        exact_sum(F.col("full_mrp_value")).alias("total_mrp_value"),
        F.count_distinct("voucher_no").alias("num_bills"),
        sum_if(is_b2b, F.col("sales_qty")).alias("b2b_units"),
        exact_sum(where(is_b2b, F.col("line_revenue"))).alias("b2b_revenue"),
    )


def returned_months(returns: DataFrame) -> DataFrame:
    """Returns per SKU, branch and month."""
    return returns.groupBy(
        "company_name",
        "stock_no",
        F.col("return_year").alias("txn_year"),
        F.col("return_month").alias("txn_month"),
    ).agg(
        F.sum("return_qty").alias("returned_units"),
        exact_sum(F.col("return_value")).alias("returned_value"),
    )


def net_of_months(sold: DataFrame, returned: DataFrame, cfg: RetailConfig) -> DataFrame:
    both = left_join(sold, returned, ["company_name", "stock_no", "txn_year", "txn_month"])
    both = both.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in ("returned_units", "returned_value")}
    )
    units, value = F.col("returned_units"), F.col("returned_value")
    share = safe_ratio(units, F.col("gross_units_sold"))
    return both.withColumns(
        {
            "net_units_sold": greatest0(F.col("gross_units_sold") - units),
            "net_revenue": greatest0(F.col("gross_revenue") - value),
            "return_rate_pct": F.round(share * 100.0, 2),
            "return_value_rate_pct": safe_ratio(value, F.col("gross_revenue"), 100, digits=2),
            "is_high_return_item": F.coalesce(share > cfg.high_return_share, F.lit(False)),
        }
    )


def product_summary(sales: DataFrame, purchases: DataFrame) -> DataFrame:
    """Revenue against purchase cost per product, brand and branch. Prices and
    percentages are plain averages over lines. Where there was no purchase (or
    the brand is null) cost and margin are null.

    Bills and selling days are counted from (group, bill) and (group, day) pairs: a
    distinct count beside the sums would move these for every bill, and a second
    one would copy every bill line."""
    keys = ["product", "brand", "company_name"]
    line_price = safe_ratio(F.col("line_revenue"), F.col("sales_qty"), digits=2)
    sold = groups_with_counts(
        sales.withColumn("line_price", line_price),
        keys,
        [
            F.sum("sales_qty").alias("units_sold"),
            exact_sum(F.col("line_revenue")).alias("total_revenue"),
            exact_sum(F.col("full_mrp_value")).alias("total_mrp_value"),
            exact_sum(F.col("discount_given")).alias("total_discount_given"),
            mean(F.col("retail_price"), 2).alias("avg_retail_price"),
            mean(F.col("line_price"), 2).alias("avg_actual_selling_price"),
            mean(F.col("discount_pct"), 2).alias("avg_discount_pct"),
            F.min("sale_date").alias("first_sale"),
            F.max("sale_date").alias("last_sale"),
        ],
        {"num_transactions": "voucher_no", "active_selling_days": "sale_date"},
    )
    bought = purchases.groupBy(*keys).agg(
        F.sum("purchase_qty").alias("units_purchased"),
        mean(F.col("item_rate"), 2).alias("avg_cost_price"),
        exact_sum(F.col("item_net_amount")).alias("total_purchase_cost"),
    )
    price, cost = F.col("avg_actual_selling_price"), F.col("avg_cost_price")
    units = F.col("units_sold")
    return left_join(sold, bought, keys).withColumns(
        {
            "avg_unit_margin": F.round(price - cost, 2),
            "margin_pct": safe_ratio(price - cost, price, 100, digits=2),
            # rounded to cents and kept as decimal: the scorecard sums and ranks it
            "estimated_profit": F.round(units.cast("double") * (price - cost), 2).cast(CENTS),
            "sell_through_pct": safe_ratio(units, F.col("units_purchased"), 100, digits=2),
        }
    )

def product_performance(
    sales: DataFrame, purchases: DataFrame, summary: DataFrame | None = None
) -> DataFrame:
    """The product summary with revenue ranks; ``summary`` is taken as it is if
    the caller has it already."""
    out = product_summary(sales, purchases) if summary is None else summary
    return add_ranks(
        out,
        {
            "revenue_rank_in_branch": (["company_name"], "total_revenue"),
            "revenue_rank_overall": ((), "total_revenue"),
        },
    )


DAY_KEYS = (
    "company_name",
    "branch_type",
    "is_active",
    "voucher_date",
    "year",
    "month",
    "month_name",
    "week",
    "quarter",
    "day_of_week",
)

# Column of the daily P&L -> voucher type summed in it.
VOUCHER_COLUMNS = {
    "gross_sales": "Sales",
    "sales_returns": "Sales Return",
    "b2b_sales": "B2B Sale",
    "total_expenses": "Payment",
    "purchases": "Purchase",
    "purchase_returns": "Purchase Return",
    "transfer_in": "Transfer In",
    "transfer_out": "Transfer Out",
    "receipts": "Receipt",
}


def daily_pnl(ledger: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Profit and loss per branch and day, in a single aggregate. B2B dispatches
    to branches are shown but are not part of the profit."""
    voucher, category, amount = F.col("voucher_type"), F.col("expense_category"), F.col("amount")
    payment = voucher == "Payment"
    sums = {name: exact_sum(where(voucher == v, amount)) for name, v in VOUCHER_COLUMNS.items()}
    sums |= {
        name: exact_sum(where(payment & (category == label), amount))
        for label, name in EXPENSE_COLUMNS.items()
    }
    sums["other_expense"] = exact_sum(
        where(payment & ~category.isin(*EXPENSE_COLUMNS), amount)
    )

    days = ledger.groupBy(*DAY_KEYS).agg(
        *[c.alias(name) for name, c in sums.items()],
        F.count(F.lit(1)).alias("transaction_count"),
    )
    return (
        days.withColumn("net_sales", F.col("gross_sales") - F.col("sales_returns"))
        .withColumn("net_pnl", F.col("net_sales") - F.col("total_expenses"))
        .withColumns(
            {
                "pnl_margin_pct": safe_ratio(F.col("net_pnl"), F.col("gross_sales"), 100),
                "net_purchases": F.col("purchases") - F.col("purchase_returns"),
            }
        )
    )


def transfer_opportunities(movement: DataFrame, velocity: DataFrame) -> DataFrame:
    """Stock that does not move at one branch, paired with every other branch
    where the SKU sells fast. At most one pair per branch combination of an SKU
    and description: both sides are per-branch summaries, not bill lines."""
    stagnant = movement.filter(
        (F.col("movement_status") == "Stagnant") & (F.col("closing_qty") > 0)
    ).select(
        F.col("company_name").alias("from_branch"),
        "stock_no",
        "item_description",
        "product",
        "brand",
        F.col("closing_qty").alias("qty_available"),
        "capital_locked",
    )
    fast = velocity.filter(F.col("velocity_tier") == "Fast mover").select(
        F.col("stock_no").alias("fast_stock_no"),
        F.col("company_name").alias("to_branch"),
        F.col("units_per_day").alias("velocity_at_destination"),
        F.col("total_units_sold").alias("total_sold_at_destination"),
    )
    pairs = pair_join(
        stagnant,
        fast,
        F.col("stock_no") == F.col("fast_stock_no"),
        F.col("from_branch") != F.col("to_branch"),
    )
    days = safe_ratio(F.col("qty_available"), F.col("velocity_at_destination"), digits=0)
    return pairs.drop("fast_stock_no").withColumn("est_days_to_sell_if_transferred", days)
