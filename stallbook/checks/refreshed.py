"""Registered queries: models refreshed from changed months, approximate counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.checks import binding as b
from stallbook.checks.binding import AS_OF, CFG
from stallbook.checks.models import DAY_MONEY, NET_SALES, VELOCITY_MONEY, ledger, sales
from stallbook.checks.registry import query
from stallbook.checks.sql import doubles, sql
from stallbook.operators import sketches
from stallbook.operators.shared import scratch, share
from stallbook.plans.refresh import Store
from stallbook.plans.staging import stg_stored_sales, stg_sales_returns
from stallbook.sources import snapshots


def in_two_commits(rows: DataFrame, root: str, day: str, refresh) -> list[str]:
    """Commit the rows with half of the last month missing, refresh, commit that
    month as a whole, refresh again; returns what the second refresh took over."""
    spark = rows.sparkSession
    last = rows.agg(F.max(snapshots.month_of(day))).first()[0]
    of_last = F.coalesce(snapshots.month_of(day) == last, F.lit(False))
    half = F.pmod(F.xxhash64("voucher_no"), F.lit(2)) == 0
    state = snapshots.write(rows.where(~of_last | half), root, day, None)
    refresh(root)
    snapshots.write(rows.where(of_last), root, day, state)
    return refresh(root)


def _refreshed_sales(
    spark: SparkSession, d: str, store: Store, *tables: str, lines: DataFrame | None = None
) -> DataFrame:
    lines = sales(spark, d) if lines is None else lines
    in_two_commits(
        lines, scratch(spark, "sales-months"), "sale_date",
        lambda root: store.refresh_sales(root, tables),
    )
    return lines


@query(sql(f"select * replace ({VELOCITY_MONEY}) from velocity"))
def velocity_refreshed(spark: SparkSession, d: str) -> DataFrame:
    store = Store(spark, scratch(spark, "store"))
    _refreshed_sales(spark, d, store, "velocity", "bills")
    return store.velocity(CFG, AS_OF)


@query(sql(NET_SALES))
def net_sales_refreshed(spark: SparkSession, d: str) -> DataFrame:
    store = Store(spark, scratch(spark, "store"))
    open_lines = share(b.open_lines(spark, d))
    _refreshed_sales(
        spark, d, store, "sold", lines=stg_stored_sales(b.raw_sales(spark, d, open_lines), CFG)
    )
    back = stg_sales_returns(b.raw_sales_returns(spark, d, open_lines), CFG)
    in_two_commits(back, scratch(spark, "return-months"), "return_date", store.refresh_returns)
    return store.net_sales(CFG)


@query(sql(f"""
select * replace ({doubles(DAY_MONEY + ' net_sales net_pnl net_purchases')}) from daily_pnl"""))
def daily_pnl_refreshed(spark: SparkSession, d: str) -> DataFrame:
    store = Store(spark, scratch(spark, "store"))
    vouchers = share(ledger(spark, d))
    in_two_commits(
        vouchers, scratch(spark, "ledger-months"), "voucher_date",
        lambda root: store.refresh_ledger(root, CFG),
    )
    return store.daily_pnl()


#: First and last month of each period.
PERIODS = (("1992-01-01", "1998-12-01"), ("1995-01-01", "1995-12-01"), ("1996-03-01", "1996-05-01"))


@query(sql(f"""
select company_name, product, first_month, count(distinct voucher_no) as num_bills,
  true as within_error
from stg_sales join (values {", ".join(f"(date '{a}', date '{b}')" for a, b in PERIODS)})
  as p(first_month, last_month)
on date_trunc('month', sale_date) between first_month and last_month
group by company_name, product, first_month"""))
def bills_approx(spark: SparkSession, d: str) -> DataFrame:
    """Bills of each product at each branch in some periods, counted exactly, and
    whether the count from stored sketches is within its error of that."""
    store = Store(spark, scratch(spark, "store"))
    lines = _refreshed_sales(spark, d, store, "sketches")
    keys = ["company_name", "product"]

    def period(first: str, last: str) -> DataFrame:
        inside = F.trunc("sale_date", "month").between(first, last)
        exact = lines.where(inside).groupBy(*keys).agg(F.count_distinct("voucher_no").alias("num_bills"))
        about = store.bills(keys, first, last).withColumnRenamed("num_bills", "about")
        return exact.join(about, keys, "left").withColumn("first_month", F.lit(first).cast("date"))

    both = reduce(DataFrame.unionByName, [period(a, b) for a, b in PERIODS])
    off = F.abs(F.col("about") - F.col("num_bills"))
    return both.select(
        *keys,
        "first_month",
        "num_bills",
        F.coalesce(off <= sketches.relative_error() * F.col("num_bills"), F.lit(False)).alias("within_error"),
    )
