"""Report queries over the marts: KPI cards, trends, breakdowns, findings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.config import EXPENSE_COLUMNS, RetailConfig
from stallbook.functions import dates
from stallbook.functions.numbers import exact_sum, safe_ratio, where
from stallbook.operators.rows import combine_history, sorted_by

# Column of the financials -> label in expense reports.
EXPENSE_LABELS = {name: label for label, name in EXPENSE_COLUMNS.items()} | {
    "other_expense": "Other Expense"
}
PERIODS = (1, 7, 30, 60, 90, 365)

# Model -> order of its rows on a report page ("-" is descending).
REPORT_ORDER = {
    "int_net_sales": ("txn_year", "txn_month", "-net_revenue"),
    "int_product_performance": ("-total_revenue",),
    "int_transfer_opportunities": ("-capital_locked",),
    "mart_action_board": ("-capital_locked",),
    "mart_branch_performance": ("-total_net_sales",),
    "mart_financials": ("company_name", "voucher_date"),
    "mart_procurement_analysis": ("year_month", "-total_spend"),
    "mart_product_brand_performance": ("-total_revenue",),
    "mart_supplier_analysis": ("-total_purchase_value",),
}


def report(name: str, df: DataFrame) -> DataFrame:
    """A model in the order in which it is shown. Models themselves are not
    sorted: their tables are read by queries that sort or aggregate anew."""
    return sorted_by(df, *REPORT_ORDER[name]) if name in REPORT_ORDER else df


def _total(col: str) -> Column:
    return F.coalesce(F.sum(col), F.lit(0))


def kpi_totals(history: DataFrame, live: DataFrame) -> DataFrame:
    """Totals over closed history and the live feed; 0 where there is nothing."""
    both = combine_history(
        history.select("voucher_date", "net_sales", "total_expenses", "net_pnl"),
        live.select("voucher_date", "net_sales", "total_expenses", "net_pnl"),
    )
    return both.agg(
        _total("net_sales").alias("total_net_sales"),
        _total("total_expenses").alias("total_expenses"),
        _total("net_pnl").alias("total_net_pnl"),
        F.max("voucher_date").alias("data_as_of"),
    )


def expense_ratio(totals: DataFrame) -> DataFrame:
    """Expenses in percent of net sales; 0 when there were no sales."""
    ratio = safe_ratio(F.col("total_expenses"), F.col("total_net_sales"))
    return totals.withColumn("expense_ratio_pct", F.coalesce(ratio, F.lit(0.0)) * 100.0)


def dim_date(fin: DataFrame) -> DataFrame:
    """One row per calendar day from the first to the last voucher date."""
    span = fin.agg(F.min("voucher_date").alias("lo"), F.max("voucher_date").alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date")
    )
    return dates.calendar(days, "date", names={"dow": "day_of_week"}, label_format="MMM yyyy")


def dim_branch(fin: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Branches in the financials, without head office."""
    retail = fin.filter(~F.col("company_name").isin(*cfg.head_offices))
    return retail.select("company_name").distinct()


def in_period(df: DataFrame, as_of: dt.date | str | None, days: int) -> DataFrame:
    """Rows of the last ``days`` full days before the report date; 1 is
    yesterday."""
    today = dates.as_of_date(as_of)
    day = F.col("voucher_date")
    return df.filter((day >= F.date_sub(today, days)) & (day < today))


def period_kpis(fin: DataFrame, as_of: dt.date | str | None, periods=PERIODS) -> DataFrame:
    """KPIs of every period button, in one pass over the longest period."""
    today = dates.as_of_date(as_of)
    recent = in_period(fin, as_of, max(periods))
    exploded = recent.withColumn("period_days", F.explode(F.array(*[F.lit(p) for p in periods])))
    inside = exploded.filter(F.col("voucher_date") >= F.date_sub(today, F.col("period_days")))
    return inside.groupBy(F.col("period_days").cast("bigint").alias("period_days")).agg(
        F.sum("net_sales").alias("net_sales"),
        F.sum("total_expenses").alias("total_expenses"),
        F.sum("net_pnl").alias("net_pnl"),
    )


def _sums(*cols: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in cols]


def sales_by_branch(fin: DataFrame) -> DataFrame:
    return sorted_by(fin.groupBy("company_name").agg(*_sums("net_sales")), "-net_sales")


def branch_pnl(fin: DataFrame) -> DataFrame:
    return fin.groupBy("company_name").agg(*_sums("net_sales", "total_expenses", "net_pnl"))


def daily_trend(fin: DataFrame) -> DataFrame:
    """One point per branch and day."""
    return fin.groupBy("company_name", "voucher_date").agg(*_sums("net_sales"))


def monthly_pnl(fin: DataFrame) -> DataFrame:
    out = fin.groupBy("year", "month", "month_name").agg(*_sums("net_pnl"))
    return out.withColumn("is_profit", F.col("net_pnl") >= 0)


def expenses_by_branch(fin: DataFrame) -> DataFrame:
    return fin.groupBy("company_name").agg(*_sums("total_expenses"))


def _expense_rows(summed: DataFrame, ids: list[str]) -> DataFrame:
    names = list(EXPENSE_LABELS)
    labelled = summed.select(*ids, *[F.col(c).alias(EXPENSE_LABELS[c]) for c in names])
    return labelled.unpivot(ids, list(EXPENSE_LABELS.values()), "expense_category", "amount")


def expense_breakdown(fin: DataFrame) -> DataFrame:
    """Expenses per category with their share of the total. Summed first, so the
    unpivot turns six sums, not six columns of every day."""
    summed = fin.agg(*_sums(*EXPENSE_LABELS), F.sum("total_expenses").alias("_all"))
    out = _expense_rows(summed, ["_all"])
    return out.withColumn("share_pct", safe_ratio(F.col("amount"), F.col("_all"), 100, 2)).drop(
        "_all"
    )


def expense_trend(fin: DataFrame) -> DataFrame:
    """Expenses per month and category."""
    ids = ["year", "month", "month_name"]
    return _expense_rows(fin.groupBy(*ids).agg(*_sums(*EXPENSE_LABELS)), ids)


def top_expense(fin: DataFrame) -> DataFrame:
    """The largest expense category."""
    return expense_breakdown(fin).orderBy(
        F.col("amount").desc_nulls_last(), "expense_category"
    ).limit(1)


def top_n(
    df: DataFrame, by: str, measure: Column, n: int = 1, ascending: bool = False
) -> DataFrame:
    """The ``n`` groups with the highest (or lowest) measure; ties go by name."""
    value = F.col("value")
    order = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return (
        df.groupBy(F.col(by).alias("name"))
        .agg(measure.cast("double").alias("value"))
        .orderBy(order, F.col("name").asc_nulls_last())
        .limit(n)
    )


def best_sellers(sales: DataFrame) -> DataFrame:
    """Branch, product and brand with the highest revenue, from one pass over the
    bill lines (grouping sets); ties go by name. The best of each kind is an
    aggregate too, so no kind is sorted as a whole."""
    kinds = {"company_name": "top branch", "product": "top product", "brand": "top brand"}
    names = list(kinds)
    grouped = sales.groupingSets([[F.col(c)] for c in names], *names).agg(
        exact_sum(F.col("line_revenue")).alias("value"), F.grouping_id().alias("_kind")
    )
    # grouping_id has one bit per column, set where the column is not grouped
    finding, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(names):
        only_this = 2 ** len(names) - 1 - 2 ** (len(names) - 1 - i)
        finding = F.when(F.col("_kind") == only_this, kinds[c]).otherwise(finding)
        name = F.when(F.col("_kind") == only_this, F.col(c)).otherwise(name)
    rated = grouped.filter(F.col("value").isNotNull()).select(
        finding.alias("finding"), name.alias("name"), "value"
    )
    best = F.min(F.struct((-F.col("value")).alias("low"), F.col("name").alias("name")))
    return (
        rated.groupBy("finding")
        .agg(best.alias("best"))
        .select("finding", "best.name", (-F.col("best.low")).cast("double").alias("value"))
    )


def sell_through(movement: DataFrame) -> DataFrame:
    """Sell-through per branch: pieces out over pieces in."""
    return movement.groupBy("company_name").agg(
        safe_ratio(F.sum("outwards_qty"), F.sum("inwards_qty"), 100, 2).alias("sell_through_pct")
    )


def sales_totals(sales: DataFrame) -> DataFrame:
    """Revenue, bills (numbered per branch), SKUs and period of the bill lines."""
    return sales.agg(
        exact_sum(F.col("line_revenue")).alias("total_sales"),
        F.count_distinct("company_name", "voucher_no").alias("bills"),
        F.count_distinct("stock_no").alias("skus_sold"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )


def zero_movement(movement: DataFrame) -> DataFrame:
    """Items that came in and never left, and the capital in them."""
    stuck = movement.filter(F.col("movement_status") == "Stagnant")
    return stuck.agg(
        F.count_distinct("stock_no").alias("stagnant_skus"),
        F.count_distinct("company_name").alias("branches"),
        exact_sum(F.col("stagnant_capital")).alias("stagnant_capital"),
    )


def stock_findings(sales: DataFrame, movement: DataFrame) -> DataFrame:
    """Best sellers, and the branches with the highest and lowest sell-through,
    as (finding, name, value)."""
    rate = F.max("sell_through_pct")
    through = sell_through(movement)
    best = top_n(through, "company_name", rate)
    worst = top_n(through, "company_name", rate, ascending=True)
    return (
        best_sellers(sales)
        .unionByName(best.withColumn("finding", F.lit("best sell-through")))
        .unionByName(worst.withColumn("finding", F.lit("lowest sell-through")))
    )


def basket_size(sales: DataFrame) -> DataFrame:
    """Lines and pieces per bill, by branch. Bills are grouped first."""
    bills = sales.groupBy("company_name", "voucher_no").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("sales_qty").alias("pieces")
    )
    return bills.groupBy("company_name").agg(
        F.count(F.lit(1)).alias("bills"),
        safe_ratio(F.sum("lines"), F.count(F.lit(1)), digits=2).alias("lines_per_bill"),
        safe_ratio(F.sum("pieces"), F.count(F.lit(1)), digits=2).alias("pieces_per_bill"),
    )


def b2b_share(sales: DataFrame) -> DataFrame:
    """B2B part of revenue and of bills in percent."""
    bills = sales.groupBy("company_name", "voucher_no").agg(
        exact_sum(F.col("line_revenue")).alias("revenue"),
        exact_sum(where(F.col("is_b2b"), F.col("line_revenue"))).alias("b2b_revenue"),
        F.max("is_b2b").alias("b2b_bill"),
    )
    return bills.agg(
        safe_ratio(F.sum("b2b_revenue"), F.sum("revenue"), 100, 2).alias("revenue_share_pct"),
        safe_ratio(F.count_if("b2b_bill"), F.count(F.lit(1)), 100, 2).alias(
            "transaction_share_pct"
        ),
    )


def return_rates(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Returned value and pieces in percent of sold. Both sides are one row."""
    sold = sales.agg(
        exact_sum(F.col("line_revenue")).alias("revenue"), F.sum("sales_qty").alias("units")
    )
    back = returns.agg(
        exact_sum(F.col("return_value")).alias("returned_value"),
        F.sum("return_qty").alias("returned_units"),
    )
    both = combine_history(sold, back).agg(
        *[F.max(c).alias(c) for c in ("revenue", "units", "returned_value", "returned_units")]
    )
    return both.withColumns(
        {
            "return_value_pct": safe_ratio(F.col("returned_value"), F.col("revenue"), 100, 2),
            "return_unit_pct": safe_ratio(F.col("returned_units"), F.col("units"), 100, 2),
        }
    )


def peak_month(sales: DataFrame) -> DataFrame:
    """The calendar month with the highest revenue."""
    monthly = sales.groupBy(dates.year_month(F.col("sale_date")).alias("year_month")).agg(
        exact_sum(F.col("line_revenue")).alias("revenue")
    )
    return monthly.orderBy(F.col("revenue").desc_nulls_last(), "year_month").limit(1)
