"""Mart models read by reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.config import RetailConfig
from stallbook.functions import dates, rules
from stallbook.functions.numbers import exact_sum, max_if, mean, safe_ratio
from stallbook.operators.joins import groups_with_counts, left_join
from stallbook.operators.rows import distinct_count
from stallbook.operators.shared import share
from stallbook.operators.windows import (
    add_ranks,
    lag_days,
    lag_rows,
    rolling_avg,
    rolling_avg_days,
    running_sum,
)
from stallbook.plans.intermediate import DAY_KEYS, Grouping

DAY_MEASURES = (
    "gross_sales sales_returns net_sales b2b_sales total_expenses salary_expense "
    "shop_expense freight_expense general_expense home_expense other_expense net_pnl "
    "pnl_margin_pct purchases purchase_returns net_purchases transfer_in transfer_out "
    "receipts transaction_count"
).split()


def financials(
    daily: DataFrame, cfg: RetailConfig, as_of: dt.date | str | None = None
) -> DataFrame:
    """Daily P&L with month-, week- and year-to-date totals, earlier days and a
    seven-day average.

    The windows run over one row per branch and day: totals to date by their own,
    finer keys, earlier days and the average by branch, bounded by the calendar.
    A branch can have two rows per day (old and current name), so branch type
    and active flag break date ties.
    """
    branch = ["company_name"]
    order = ["voucher_date", "branch_type", "is_active"]
    month = branch + ["year", "month"]
    week_year = "year"
    if cfg.iso_year:
        daily, week_year = (
            daily.withColumn("_iso_year", dates.iso_year(F.col("voucher_date"))),
            "_iso_year",
        )
    if cfg.calendar_true:
        earlier = {
            "net_sales_last_week": lag_days("net_sales", 7, branch, "voucher_date"),
            "net_sales_last_month": lag_days("net_sales", 30, branch, "voucher_date"),
            "net_sales_7day_avg": rolling_avg_days("net_sales", 7, branch, "voucher_date"),
        }
    else:
        earlier = {
            "net_sales_last_week": lag_rows("net_sales", 7, branch, order),
            "net_sales_last_month": lag_rows("net_sales", 30, branch, order),
            "net_sales_7day_avg": rolling_avg("net_sales", 7, branch, order),
        }
    windows = {
        "mtd_net_sales": running_sum("net_sales", month, order),
        "mtd_expenses": running_sum("total_expenses", month, order),
        "mtd_net_pnl": running_sum("net_pnl", month, order),
        "wtd_net_sales": running_sum("net_sales", branch + [week_year, "week"], order),
        "ytd_net_sales": running_sum("net_sales", branch + ["year"], order),
        **earlier,
    }
    return daily.select(
        *DAY_KEYS,
        *[F.round(c, 2).alias(c) if c == "pnl_margin_pct" else c for c in DAY_MEASURES],
        *[c.alias(name) for name, c in windows.items()],
        dates.as_of_date(as_of).alias("report_date"),
    )


def branch_performance(fin: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Branches compared over all days. Head office counts as active here, other
    than in the ledger."""
    per_branch = fin.groupBy("company_name").agg(
        F.sum("gross_sales").alias("total_gross_sales"),
        F.sum("sales_returns").alias("total_sales_returns"),
        F.sum("net_sales").alias("total_net_sales"),
        F.sum("total_expenses").alias("total_expenses"),
        F.sum("salary_expense").alias("total_salary"),
        F.sum("shop_expense").alias("total_shop_expense"),
        F.sum("freight_expense").alias("total_freight"),
        F.sum("net_pnl").alias("total_net_pnl"),
        mean(F.col("pnl_margin_pct"), 2).alias("avg_pnl_margin_pct"),
        F.count_distinct("voucher_date").alias("active_days"),
        F.min("voucher_date").alias("first_sale_date"),
        F.max("voucher_date").alias("last_sale_date"),
        F.sum("transaction_count").alias("total_transactions"),
    )
    branch = F.col("company_name")
    ranked = add_ranks(per_branch, {"revenue_rank": ((), "total_net_sales")})
    return ranked.withColumns(
        {
            "branch_type": rules.tier(
                [(branch.isin(*cfg.head_offices), "Head Office")], "Retail Branch"
            ),
            "is_active": F.coalesce(branch.isin(*cfg.branches), F.lit(False)),
            "expense_ratio_pct": safe_ratio(
                F.col("total_expenses"), F.col("total_net_sales"), 100, digits=2
            ),
            "avg_daily_sales": safe_ratio(
                F.col("total_net_sales"), F.col("active_days"), digits=2
            ),
        }
    )


def cross_branch_velocity(velocity: DataFrame) -> DataFrame:
    """Per SKU: the branch where it sells fast (the last by name if several),
    number of selling branches, and totals."""
    return velocity.groupBy("stock_no").agg(
        max_if(F.col("velocity_tier") == "Fast mover", F.col("company_name")).alias(
            "fast_at_branch"
        ),
        F.count_distinct("company_name").alias("branches_selling"),
        F.sum("total_units_sold").alias("total_units_all_branches"),
        F.sum("total_revenue").alias("total_revenue_all_branches"),
    )


def action_tag(cfg: RetailConfig) -> Column:
    """What to do with an item at a branch; the first rule that holds wins."""
    stock, tier = F.col("stock_on_hand"), F.col("velocity_tier")
    sold, per_day = F.col("total_units_sold"), F.col("units_per_day")
    week_of_stock = per_day * cfg.reorder_days
    slow_here = F.coalesce(tier, F.lit("No sales")).isin("Slow mover", "No sales")
    fast_elsewhere = F.col("fast_at_branch") != F.col("company_name")
    return rules.tier(
        [
            (
                (tier == "Fast mover")
                & (stock <= F.coalesce(week_of_stock, F.lit(cfg.reorder_default_units))),
                "Reorder",
            ),
            (
                (sold > 0)
                & (F.coalesce(F.col("avg_discount_pct"), F.lit(0.0)) > cfg.watch_discount_pct),
                "Watch — high discount",
            ),
            (slow_here & (stock > 0) & fast_elsewhere, "Transfer"),
            (
                (sold.isNull() | (sold == 0))
                & (stock > 0)
                & (F.col("movement_status") == "Stagnant"),
                "Liquidate",
            ),
            (
                tier.isin("Fast mover", "Medium mover")
                & (F.col("margin_pct") >= cfg.healthy_margin_pct)
                & (stock > F.coalesce(week_of_stock, F.lit(0.0))),
                "Healthy",
            ),
            (sold > 0, "Monitor"),
        ],
        "Review",
    )


def action_board(
    balance: DataFrame, velocity: DataFrame, movement: DataFrame, cfg: RetailConfig
) -> DataFrame:
    """Every item in stock at every branch with velocity, movement and a tag.

    Velocity is read twice, per branch and summed over branches: pass a shared
    result (``operators.shared.share``) so that sales are aggregated once. All
    three joined inputs are summaries per item.
    """
    item = ["stock_no", "company_name"]
    stock = balance.select(
        "company_name",
        "stock_no",
        "item_description",
        "product",
        "brand",
        "supplier_name",
        "cost_price",
        "retail_price",
        "margin_pct",
        F.col("closing_qty").alias("stock_on_hand"),
        "capital_locked",
        F.col("retail_value").alias("stock_retail_value"),
        "stock_value_bucket",
    )
    sold = velocity.select(
        *item,
        "total_units_sold",
        "total_revenue",
        "units_per_day",
        "velocity_tier",
        "avg_discount_pct",
        "first_sale_date",
        "last_sale_date",
        "days_with_sales",
        F.col("num_bills").alias("bills_containing_item"),
    )
    moved = movement.select(
        *item, "movement_status", "sell_through_pct", "inwards_qty", "outwards_qty"
    )
    board = left_join(stock, sold, item)
    board = left_join(board, moved, item)
    board = left_join(board, cross_branch_velocity(velocity), ["stock_no"])
    return board.withColumns(
        {
            "days_of_stock_remaining": safe_ratio(
                F.col("stock_on_hand"), F.col("units_per_day"), digits=0
            ),
            "action_tag": action_tag(cfg),
        }
    )


def product_brand_performance(perf: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Scorecard per product and brand over all branches."""
    out = perf.groupBy("product", "brand").agg(
        F.sum("units_sold").alias("total_units_sold"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_discount_given").alias("total_discount_given"),
        F.sum("estimated_profit").alias("total_estimated_profit"),
        F.sum("units_purchased").alias("total_units_purchased"),
        *[
            mean(F.col(c), 2).alias(name)
            for name, c in {
                "avg_margin_pct": "margin_pct",
                "avg_discount_pct": "avg_discount_pct",
                "avg_sell_through_pct": "sell_through_pct",
                "avg_cost_price": "avg_cost_price",
                "avg_retail_price": "avg_retail_price",
            }.items()
        ],
        F.count_distinct("company_name").alias("num_branches_selling"),
        F.min("first_sale").alias("first_sale_date"),
        F.max("last_sale").alias("last_sale_date"),
    )
    out = add_ranks(
        out,
        {
            "revenue_rank": ((), "total_revenue"),
            "profit_rank": ((), "total_estimated_profit"),
            "volume_rank": ((), "total_units_sold"),
        },
    )
    return out.withColumns(
        {
            "strategic_quadrant": rules.strategic_quadrant(
                cfg, F.col("avg_margin_pct"), F.col("avg_sell_through_pct")
            ),
            "discount_risk": rules.discount_risk(cfg, F.col("avg_discount_pct")),
        }
    )


def _line_margin() -> Column:
    """Price less cost of a line, without the noise of subtracting doubles."""
    return F.round(F.col("retail_price") - F.col("item_rate"), 9)


def _gross_margin(margin: Column, retail: Column) -> Column:
    """(retail - cost) / retail in percent; quantities play no part, and a line
    without cost counts in the denominator only."""
    return safe_ratio(margin, retail, 100, digits=2)


#: Columns of a purchase line that the supplier analysis reads.
SUPPLIER_LINE = (
    "supplier_name brand product voucher_no stock_no voucher_date purchase_qty "
    "item_net_amount item_rate retail_price"
).split()


def supplier_analysis(
    purchases: DataFrame,
    cfg: RetailConfig,
    as_of: dt.date | str | None = None,
    group: Grouping = groups_with_counts,
) -> DataFrame:
    """Spend, prices and margin per supplier, brand and product, with ranks.
    ``purchases`` is read three times, twice of them for a few columns, and should
    be a stored result. Of stored lines, ``group`` may be
    ``joins.stored_groups_with_counts``."""
    keys = ["supplier_name", "brand", "product"]
    named = purchases.select(*SUPPLIER_LINE).filter(F.col("supplier_name").isNotNull())
    first, last = F.min("voucher_date"), F.max("voucher_date")
    out = group(
        named.withColumn("_margin", _line_margin()),
        keys,
        [
            F.sum("purchase_qty").alias("total_units_purchased"),
            F.round(exact_sum(F.col("item_net_amount")), 2).alias("total_purchase_value"),
            mean(F.col("item_net_amount"), 2).alias("avg_order_value"),
            mean(F.col("item_rate"), 2).alias("avg_item_cost"),
            mean(F.col("retail_price"), 2).alias("avg_retail_price"),
            _gross_margin(
                exact_sum(F.col("_margin")), exact_sum(F.col("retail_price"))
            ).alias("avg_gross_margin_pct"),
            first.alias("first_purchase_date"),
            last.alias("last_purchase_date"),
            dates.month_diff(last, first).alias("relationship_months"),
        ],
        {"total_purchase_orders": "voucher_no", "unique_items_supplied": "stock_no"},
    )
    out = add_ranks(
        out,
        {
            "supplier_rank": ((), "total_purchase_value"),
            "rank_within_category": (["product"], "total_purchase_value"),
        },
    )
    return out.withColumn("report_date", dates.as_of_date(as_of))


def purchase_months(purchases: DataFrame) -> DataFrame:
    """Purchase lines with their month and the columns that the procurement summaries
    read. They are not summed by item, supplier and style, as few lines share all three."""
    day = F.col("voucher_date")
    return purchases.select(
        F.year(day).cast("bigint").alias("purchase_year"),
        F.month(day).cast("bigint").alias("purchase_month"),
        "product",
        "brand",
        "stock_no",
        "style",
        "supplier_name",
        F.col("purchase_qty").alias("units"),
        F.col("item_net_amount").alias("spend"),
        _line_margin().alias("margin"),
        F.col("retail_price").alias("retail"),
    )


def procurement_analysis(
    months: DataFrame, cfg: RetailConfig, as_of: dt.date | str | None = None
) -> DataFrame:
    """Monthly buying trend per product and brand, with brand and category
    totals and ranks. ``months``, the result of :func:`purchase_months`, should be
    stored or read from stored lines: it is summed once, to the trend, of which the
    totals are made, and read again for each distinct count of its lines."""
    month = ["purchase_year", "purchase_month"]
    sums = share(
        groups_with_counts(
            months,
            [*month, "product", "brand"],
            [
                F.sum("units").alias("total_units"),
                *[exact_sum(F.col(c)).alias(c) for c in ("spend", "margin", "retail")],
            ],
            {"unique_items": "stock_no", "unique_suppliers": "supplier_name"},
        )
    )
    first = F.make_date(*[F.col(c).cast("int") for c in month], F.lit(1))
    trend = sums.select(
        *month,
        dates.year_month(first).alias("year_month"),
        "product",
        "brand",
        "total_units",
        F.round("spend", 2).alias("total_spend"),
        _gross_margin(F.col("margin"), F.col("retail")).alias("gross_margin_pct"),
        "unique_items",
        "unique_suppliers",
    )
    brands = sums.groupBy("brand", "product").agg(
        F.sum("spend").alias("_brand_spend"),
        _gross_margin(F.sum("margin"), F.sum("retail")).alias("brand_gross_margin_pct"),
    )
    brands = add_ranks(brands, {"brand_rank": ((), "_brand_spend")})
    brands = brands.withColumn("total_brand_spend", F.round("_brand_spend", 2))
    # a null brand or product meets no row of the trend, neither here nor below
    styles = share(distinct_count(months, ["brand", "product"], "style", "unique_styles"))
    brands = left_join(brands, styles, ["brand", "product"])

    categories = sums.groupBy("product").agg(
        F.sum("spend").alias("_category_spend"),
        _gross_margin(F.sum("margin"), F.sum("retail")).alias("category_gross_margin_pct"),
        F.count_distinct("brand").alias("unique_brands"),
    )
    categories = add_ranks(categories, {"category_rank": ((), "_category_spend")})
    categories = categories.withColumn("total_category_spend", F.round("_category_spend", 2))

    out = left_join(trend, brands.drop("_brand_spend"), ["brand", "product"])
    out = left_join(out, categories.drop("_category_spend"), ["product"])
    return out.withColumn("report_date", dates.as_of_date(as_of))
