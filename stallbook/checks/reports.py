"""Registered queries: report queries and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.checks import binding as b
from stallbook.checks.binding import CFG
from stallbook.checks.models import MONEY3, fin, movement, returns, sales
from stallbook.checks.registry import query
from stallbook.checks.sql import doubles, ratio, sql
from stallbook.operators.rows import as_double
from stallbook.operators.shared import scratch, share
from stallbook.plans import reporting
from stallbook.plans.staging import stg_stored_sales
from stallbook.streaming import feed

FEED_COLUMNS = ["company_name", "voucher_date", "net_sales", "total_expenses", "net_pnl"]
LIVE_FROM = "2001-01-01"
PERIOD_END = "2001-08-02"


def _feed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Branch totals per day, as the daily feed delivers them."""
    return as_double(fin(spark, d).select(*FEED_COLUMNS))


def _deliver(days: DataFrame, path: str) -> None:
    """Write feed files; range partitioning keeps a day within one file."""
    days.repartitionByRange("voucher_date").write.mode("append").parquet(path)


def _fed(spark: SparkSession, d: str) -> DataFrame:
    """Deliver every day twice, first with doubled sales, and run the feed after
    each delivery; the corrected files must win."""
    source, target = scratch(spark, "feed-in"), scratch(spark, "feed-out")
    state = scratch(spark, "feed-state")
    days = share(_feed_rows(spark, d))
    for version in (days.withColumn("net_sales", F.col("net_sales") * 2), days):
        _deliver(version, source)
        feed.run_daily_feed(spark, source, target, state, days.schema)
    return feed.read_daily_feed(spark, target)


@query(sql("""
select company_name, voucher_date, cast(net_sales as double) as net_sales,
  cast(total_expenses as double) as total_expenses, cast(net_pnl as double) as net_pnl
from financials"""))
def daily_feed_stream(spark: SparkSession, d: str) -> DataFrame:
    return _fed(spark, d)


@query(sql(f"select * replace ({MONEY3}, {doubles('retail_price')}) from stg_sales"))
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Stream all bill lines in files without any order, two at a time, and stage
    what is kept: the same rows as from one batch."""
    source, target = scratch(spark, "lines-in"), scratch(spark, "lines-out")
    lines = b.raw_sales(spark, d)
    lines.repartition(8, "stock_no").write.parquet(source)
    feed.run_stream_dedup(
        spark, source, target, scratch(spark, "lines-state"), lines.schema, max_files_per_batch=2
    )
    return stg_stored_sales(feed.read_stream_dedup(spark, target), CFG)


# --- KPI cards -------------------------------------------------------------

KPI = """
select cast(coalesce(sum(net_sales), 0) as double) as total_net_sales,
  cast(coalesce(sum(total_expenses), 0) as double) as total_expenses,
  cast(coalesce(sum(net_pnl), 0) as double) as total_net_pnl,
  max(voucher_date) as data_as_of
from financials"""


def _kpis(spark: SparkSession, d: str) -> DataFrame:
    days = share(fin(spark, d))
    history = days.filter(F.col("voucher_date") < LIVE_FROM)
    live = days.filter(F.col("voucher_date") >= LIVE_FROM).select(*FEED_COLUMNS)
    return reporting.kpi_totals(history, live)


@query(sql(KPI))
def kpi_totals(spark: SparkSession, d: str) -> DataFrame:
    return _kpis(spark, d)


@query(sql(f"""
select *, coalesce({ratio("total_expenses", "total_net_sales")}, 0) * 100 as expense_ratio_pct
from ({KPI})"""))
def expense_ratio(spark: SparkSession, d: str) -> DataFrame:
    return reporting.expense_ratio(_kpis(spark, d))


@query(sql(f"""
select cast(p.n as bigint) as period_days, cast(sum(net_sales) as double) as net_sales,
  cast(sum(total_expenses) as double) as total_expenses,
  cast(sum(net_pnl) as double) as net_pnl
from financials f join (values (1), (7), (30), (60), (90), (365)) as p(n)
on f.voucher_date >= date '{PERIOD_END}' - p.n and f.voucher_date < date '{PERIOD_END}'
group by p.n"""))
def period_kpis(spark: SparkSession, d: str) -> DataFrame:
    return reporting.period_kpis(fin(spark, d), PERIOD_END)


@query(sql(f"""
select company_name, voucher_date, cast(net_sales as double) as net_sales from financials
where voucher_date >= date '{PERIOD_END}' - 30 and voucher_date < date '{PERIOD_END}'"""))
def last_30_days(spark: SparkSession, d: str) -> DataFrame:
    df = reporting.in_period(fin(spark, d), PERIOD_END, 30)
    return df.select("company_name", "voucher_date", "net_sales")


@query(sql("""
select cast(t.day as date) as date, cast(year(t.day) as bigint) as year,
  cast(month(t.day) as bigint) as month, strftime(t.day, '%b %Y') as month_name,
  cast(quarter(t.day) as bigint) as quarter, cast(week(t.day) as bigint) as week,
  dayname(t.day) as day_of_week
from (select unnest(generate_series(min(voucher_date), max(voucher_date), interval 1 day)) as day
  from financials) t"""))
def calendar_dim(spark: SparkSession, d: str) -> DataFrame:
    return reporting.dim_date(fin(spark, d))


@query(sql("select distinct company_name from financials where company_name <> 'AFRICA'"))
def branch_dim(spark: SparkSession, d: str) -> DataFrame:
    return reporting.dim_branch(fin(spark, d), CFG)


# --- trends and breakdowns -------------------------------------------------


@query(sql("""
select company_name, cast(sum(net_sales) as double) as net_sales
from financials group by company_name"""))
def sales_by_branch(spark: SparkSession, d: str) -> DataFrame:
    return reporting.sales_by_branch(fin(spark, d))


@query(sql("""
select company_name, cast(sum(net_sales) as double) as net_sales,
  cast(sum(total_expenses) as double) as total_expenses,
  cast(sum(net_pnl) as double) as net_pnl
from financials group by company_name"""))
def branch_pnl(spark: SparkSession, d: str) -> DataFrame:
    return reporting.branch_pnl(fin(spark, d))


@query(sql("""
select company_name, voucher_date, cast(sum(net_sales) as double) as net_sales
from financials group by company_name, voucher_date"""))
def daily_trend(spark: SparkSession, d: str) -> DataFrame:
    return reporting.daily_trend(fin(spark, d))


@query(sql("""
select year, month, month_name, cast(sum(net_pnl) as double) as net_pnl,
  sum(net_pnl) >= 0 as is_profit
from financials group by year, month, month_name"""))
def monthly_pnl(spark: SparkSession, d: str) -> DataFrame:
    return reporting.monthly_pnl(fin(spark, d))


@query(sql("""
select company_name, cast(sum(total_expenses) as double) as total_expenses
from financials group by company_name"""))
def expenses_by_branch(spark: SparkSession, d: str) -> DataFrame:
    return reporting.expenses_by_branch(fin(spark, d))


EXPENSES = {
    "Salary": "salary_expense",
    "Shop Expense": "shop_expense",
    "Freight": "freight_expense",
    "General Expense": "general_expense",
    "Home Expense": "home_expense",
    "Other Expense": "other_expense",
}
EXPENSE_SHARES = " union all ".join(
    f"select '{label}' as expense_category, cast(sum({col}) as double) as amount, "
    f"{ratio(f'sum({col})', 'sum(total_expenses)', 100, 2)} as share_pct from financials"
    for label, col in EXPENSES.items()
)


@query(sql(EXPENSE_SHARES))
def expense_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return reporting.expense_breakdown(fin(spark, d))


@query(sql(" union all ".join(
    f"select year, month, month_name, '{label}' as expense_category, "
    f"cast(sum({col}) as double) as amount from financials group by year, month, month_name"
    for label, col in EXPENSES.items()
)))
def expense_trend(spark: SparkSession, d: str) -> DataFrame:
    return reporting.expense_trend(fin(spark, d))


@query(sql(
    f"select * from ({EXPENSE_SHARES}) order by amount desc nulls last, expense_category limit 1"
))
def top_expense(spark: SparkSession, d: str) -> DataFrame:
    return reporting.top_expense(fin(spark, d))


# --- findings --------------------------------------------------------------


@query(sql("""
select cast(sum(line_revenue) as double) as total_sales,
  count(distinct company_name || '/' || voucher_no) as bills,
  count(distinct stock_no) as skus_sold, min(sale_date) as first_sale_date,
  max(sale_date) as last_sale_date
from stg_sales"""))
def sales_totals(spark: SparkSession, d: str) -> DataFrame:
    return reporting.sales_totals(sales(spark, d))


@query(sql("""
select count(distinct stock_no) as stagnant_skus, count(distinct company_name) as branches,
  cast(sum(cast(stagnant_capital as decimal(18,5))) as double) as stagnant_capital
from stg_stock_movement where movement_status = 'Stagnant'"""))
def zero_movement(spark: SparkSession, d: str) -> DataFrame:
    return reporting.zero_movement(movement(spark, d))


SELL_THROUGH = f"""
select company_name as name, {ratio("sum(outwards_qty)", "sum(inwards_qty)", 100, 2)} as value
from stg_stock_movement group by company_name"""


@query(sql(SELL_THROUGH.replace("as name", "").replace("as value", "as sell_through_pct")))
def sell_through_by_branch(spark: SparkSession, d: str) -> DataFrame:
    return reporting.sell_through(movement(spark, d))


def _best(kind: str, col: str) -> str:
    return (
        f"select * from (select '{kind}' as finding, {col} as name, "
        f"cast(sum(line_revenue) as double) as value from stg_sales group by {col} "
        "order by value desc nulls last, name limit 1)"
    )


@query(sql(" union all ".join([
    _best("top branch", "company_name"),
    _best("top product", "product"),
    _best("top brand", "brand"),
    f"select * from (select 'best sell-through' as finding, * from ({SELL_THROUGH}) "
    "order by value desc nulls last, name limit 1)",
    f"select * from (select 'lowest sell-through' as finding, * from ({SELL_THROUGH}) "
    "order by value asc nulls last, name limit 1)",
])))
def findings(spark: SparkSession, d: str) -> DataFrame:
    return reporting.stock_findings(sales(spark, d), movement(spark, d))


@query(sql(f"""
select cast(revenue as double) as revenue, cast(units as bigint) as units,
  cast(returned_value as double) as returned_value,
  cast(returned_units as bigint) as returned_units,
  {ratio("returned_value", "revenue", 100, 2)} as return_value_pct,
  {ratio("returned_units", "units", 100, 2)} as return_unit_pct
from (select sum(line_revenue) as revenue, sum(sales_qty) as units from stg_sales),
  (select sum(return_value) as returned_value, sum(return_qty) as returned_units
   from raw_sales_returns)"""))
def return_rates(spark: SparkSession, d: str) -> DataFrame:
    return reporting.return_rates(sales(spark, d), returns(spark, d))


@query(sql("""
select strftime(sale_date, '%Y-%m') as year_month, cast(sum(line_revenue) as double) as revenue
from stg_sales group by 1 order by sum(line_revenue) desc nulls last, 1 limit 1"""))
def peak_month(spark: SparkSession, d: str) -> DataFrame:
    return reporting.peak_month(sales(spark, d))


@query(sql(f"""
select company_name, count(*) as bills, {ratio("sum(lines)", "count(*)", 1, 2)} as lines_per_bill,
  {ratio("sum(pieces)", "count(*)", 1, 2)} as pieces_per_bill
from (select company_name, voucher_no, count(*) as lines, sum(sales_qty) as pieces
  from stg_sales group by company_name, voucher_no)
group by company_name"""))
def basket_size(spark: SparkSession, d: str) -> DataFrame:
    return reporting.basket_size(sales(spark, d))


@query(sql(f"""
select {ratio("sum(b2b)", "sum(revenue)", 100, 2)} as revenue_share_pct,
  {ratio("count(*) filter (b2b_bill)", "count(*)", 100, 2)} as transaction_share_pct
from (select sum(line_revenue) as revenue, bool_or(is_b2b) as b2b_bill,
    sum(case when is_b2b then line_revenue else 0 end) as b2b
  from stg_sales group by company_name, voucher_no)"""))
def b2b_share(spark: SparkSession, d: str) -> DataFrame:
    return reporting.b2b_share(sales(spark, d))
