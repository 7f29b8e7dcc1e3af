"""Registered queries: file cleaning, loads, and the operators below the models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.checks import binding as b
from stallbook.checks.binding import CFG
from stallbook.checks.registry import query
from stallbook.checks.sql import dbl, doubles, even, ratio, rnd, sql
from stallbook.functions import dates, numbers, rules, text
from stallbook.functions.numbers import exact_sum
from stallbook.operators import layouts, rows
from stallbook.operators.shared import scratch, share
from stallbook.operators.windows import add_ranks
from stallbook.plans import cleaning
from stallbook.plans.staging import stg_dead_stock, stg_purchases, stg_stored_sales, stg_stockouts
from stallbook.schemas import (
    BALANCE_FILE,
    DEAD_STOCK_REPORT,
    PURCHASE_REPORT,
    SALES_FILE,
    STOCKOUT_REPORT,
    schema_for,
)
from stallbook.sources import inference, metrics, readers, writers
from stallbook.sources.catalog import Tables


# --- sales -----------------------------------------------------------------

NET = dbl("cast(full_mrp_value - discount_given as decimal(18,5))")
DISCOUNT = even(f"{dbl('full_mrp_value')} - {NET}", 2)
SALES_LINES = "from raw_line where l_linestatus = 'O'"
SALES_MONEY = f"""
  {even(NET, 2)} as line_revenue, {even(dbl('full_mrp_value'), 2)} as full_mrp_value,
  {DISCOUNT} as discount_given,
  {even(f"{DISCOUNT} / nullif({dbl('full_mrp_value')}, 0) * 100", 2)} as discount_pct,
  is_b2b"""
SALES_CALENDAR = """
  txn_date as sale_date, cast(year(txn_date) as bigint) as sale_year,
  cast(month(txn_date) as bigint) as sale_month, strftime(txn_date, '%b') as sale_month_name,
  cast(quarter(txn_date) as bigint) as sale_quarter,
  cast(week(txn_date) as bigint) as sale_week, dayname(txn_date) as sale_dow"""


CLEAN_SALES = sql(f"""
select company_name, case when is_b2b then 'B2B SALE' else 'SALES' end as voucher_type,
  voucher_no, customer_ref, stock_no, item_description, upper(product) as product,
  upper(brand) as brand, style, cast(null as varchar) as shade, size,
  cast(retail_price as double) as retail_price, cast(qty as double) as sales_qty,
  'PCS' as base_uom, {NET} as net_amount, {SALES_CALENDAR}, {SALES_MONEY}
{SALES_LINES}""")


@query(CLEAN_SALES)
def clean_sales(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_sales(b.sales_file(spark, d), CFG)


@query(sql(f"select voucher_no, stock_no, line_no, {SALES_MONEY} {SALES_LINES}"))
def sales_money(spark: SparkSession, d: str) -> DataFrame:
    lines = b.raw_line(spark, d).filter(F.col("l_linestatus") == "O")
    df = lines.select(
        "voucher_no",
        "stock_no",
        "line_no",
        F.when(F.col("is_b2b"), "B2B SALE").otherwise("SALES").alias("voucher_type"),
        F.col("qty").cast("double").alias("sales_qty"),
        "retail_price",
        b._places(F.col("full_mrp_value") - F.col("discount_given"), 5).alias("net_amount"),
    )
    return cleaning.sales_money(df, CFG).drop(
        "voucher_type", "sales_qty", "retail_price", "net_amount"
    )


@query(sql(f"select distinct {SALES_CALENDAR} {SALES_LINES}"))
def sales_calendar(spark: SparkSession, d: str) -> DataFrame:
    days = rows.distinct_keys(b.raw_sales(spark, d), ["sale_date"])
    return dates.calendar(days, "sale_date", "sale_")


# --- returns ---------------------------------------------------------------

RETURNS = f"""
select company_name, voucher_type, voucher_no, customer_ref, stock_no, item_description,
  upper(product) as product, upper(brand) as brand, style, shade, size, cast(retail_price as double) as retail_price,
  cast(return_qty as double) as return_qty, base_uom, return_date, return_year, return_month,
  return_month_name, return_quarter, {even(dbl('return_value'), 2)} as return_value,
  {even(ratio('return_value', 'return_qty'), 2)} as return_value_per_unit, has_customer_name
from raw_sales_returns"""


@query(sql(RETURNS))
def clean_sales_returns(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_sales_returns(b.returns_file(spark, d), CFG)


# --- stock -----------------------------------------------------------------


@query(sql(f"""
select company_name, stock_no, item_description, upper(product) as product,
  upper(brand) as brand, style, shade, size, hsn_code, supplier_name, {doubles('cost_price retail_price')}, base_uom,
  {doubles('opening_qty opening_val inwards_qty outwards_qty closing_qty closing_val')},
  sell_through_pct, capital_locked, retail_value_closing, movement_status, margin_pct
from raw_stock_movement"""))
def clean_stock_movement(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_stock_movement(b.movement_file(spark, d), CFG)


CLEAN_BALANCE = f"""
select company_name, stock_no, item_description, upper(product) as product,
  upper(brand) as brand, style, shade, size, hsn_code, supplier_name, item_type, {doubles('cost_price retail_price')}, base_uom,
  {doubles('closing_qty closing_rate closing_value')}, margin_pct, retail_value, capital_locked
from raw_stock_balance"""


@query(sql(CLEAN_BALANCE))
def clean_stock_balance(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_stock_balance(b.balance_file(spark, d), CFG)


@query(sql("""
select stock_no, 'HSN' as code_kind, hsn_code, upper(product) as product,
  company_name from raw_stock_balance
"""))
def code_cleanup(spark: SparkSession, d: str) -> DataFrame:
    df = rows.drop_null_keys(rows.trim_strings(b.balance_file(spark, d)), ["stock_no"])
    df = df.filter(numbers.num_or_zero(F.col("closing_qty")) > 0)
    return df.select(
        "stock_no",
        F.lit("HSN").alias("code_kind"),
        text.strip_dot_zero(F.col("hsn_code")).alias("hsn_code"),
        text.upper_trim(F.col("product")).alias("product"),
        "company_name",
    )


@query(sql("""
select movement_status, count(*) as rows from raw_stock_movement group by movement_status"""))
def status_distribution(spark: SparkSession, d: str) -> DataFrame:
    return rows.value_counts(b.raw_stock_movement(spark, d), "movement_status")


# --- ledger ----------------------------------------------------------------


@query(sql(f"""
select * replace ({doubles('inwards_qty outwards_qty debit_amount credit_amount amount')})
from ledger"""))
def clean_ledger(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_ledger(b.ledger_file(spark, d), CFG)


@query(sql("""
select voucher_type, count(*) as vouchers, cast(sum(debit_amount) as double) as debit,
  cast(sum(credit_amount) as double) as credit, cast(sum(amount) as double) as amount
from ledger group by voucher_type"""))
def ledger_amounts(spark: SparkSession, d: str) -> DataFrame:
    df = cleaning.clean_ledger(b.ledger_file(spark, d), CFG)
    return df.groupBy("voucher_type").agg(
        F.count(F.lit(1)).alias("vouchers"),
        exact_sum(F.col("debit_amount")).alias("debit"),
        exact_sum(F.col("credit_amount")).alias("credit"),
        exact_sum(F.col("amount")).alias("amount"),
    )


@query(sql("""
select voucher_type = 'Payment' as is_payment, particulars, expense_category,
  count(*) as vouchers
from ledger group by all"""))
def expense_categories(spark: SparkSession, d: str) -> DataFrame:
    df = cleaning.clean_ledger(b.ledger_file(spark, d), CFG)
    return df.groupBy(
        (F.col("voucher_type") == "Payment").alias("is_payment"),
        "particulars",
        "expense_category",
    ).agg(F.count(F.lit(1)).alias("vouchers"))


LEDGER_STEPS = {
    "raw": "true",
    "no_branch": "true",
    "sub_total": "o_orderkey % 97 <> 0",
    "void": "o_orderkey % 97 <> 0 and o_orderkey % 20 <> 13",
    "not_financial": "o_orderkey % 97 <> 0 and o_orderkey % 20 not in (13, 8)",
    "no_date": "o_orderkey % 97 <> 0 and o_orderkey % 20 not in (13, 8) "
    "and o_orderkey % 101 <> 0",
}


@query(" union all ".join(
    f"select '{step}' as step, count(*) filter ({kept}) as rows from orders"
    for step, kept in LEDGER_STEPS.items()
))
def load_counts(spark: SparkSession, d: str) -> DataFrame:
    return metrics.step_counts(b.ledger_file(spark, d), cleaning.ledger_drops(CFG))


@query(sql("""
select branch_type, is_active, count(distinct company_name) as branches, count(*) as vouchers
from ledger group by all"""))
def branch_classes(spark: SparkSession, d: str) -> DataFrame:
    df = cleaning.clean_ledger(b.ledger_file(spark, d), CFG)
    return df.groupBy("branch_type", "is_active").agg(
        F.count_distinct("company_name").alias("branches"),
        F.count(F.lit(1)).alias("vouchers"),
    )


@query("""
select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') as written,
  cast(o_orderdate as date) as day_first, cast(o_orderdate as date) as iso,
  case when day(o_orderdate) <= 12
    then make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) end as month_first
from orders""")
def date_layouts(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("timestamp")
    written = F.date_format(day, "dd/MM/yyyy")
    return b.table(spark, d, "orders").select(
        "o_orderkey",
        written.alias("written"),
        dates.parse_date(written).alias("day_first"),
        dates.parse_date(F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("iso"),
        dates.parse_date(written, dates.MONTH_FIRST).alias("month_first"),
    )


@query("""
select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  cast(cast(l_extendedprice * 10 as hugeint) as double) / 10 as half_even,
  {half_up} as half_up, l_extendedprice / nullif(l_tax, 0) as safe_ratio
from lineitem""".format(half_up=rnd("l_extendedprice", 1)))
def rounding_rules(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return b.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        numbers.round_half_even(price, 1).alias("half_even"),
        F.round(price, 1).alias("half_up"),
        numbers.safe_ratio(price, F.col("l_tax")).alias("safe_ratio"),
    )


@query("""
select o_orderpriority, o_orderstatus, case o_orderstatus when 'O' then 'Open'
  when 'F' then 'Closed' else o_orderstatus end as mapped, count(*) as orders
from orders
where o_orderstatus is null or o_orderstatus not in ('X')
group by all""")
def mapped_values(spark: SparkSession, d: str) -> DataFrame:
    orders = rows.exclude_values(b.table(spark, d, "orders"), "o_orderstatus", ["X"])
    mapped = rules.map_values(F.col("o_orderstatus"), {"O": "Open", "F": "Closed"})
    return orders.groupBy("o_orderpriority", "o_orderstatus", mapped.alias("mapped")).agg(
        F.count(F.lit(1)).alias("orders")
    )


# --- sources and sinks -----------------------------------------------------


@query(CLEAN_SALES)
def csv_sales_scan(spark: SparkSession, d: str) -> DataFrame:
    """Write the sales export as CSV, scan it by position and clean it."""
    path = scratch(spark, "sales-csv")
    writers.write_clean(b.sales_file(spark, d), path, "csv")
    return cleaning.clean_sales(readers.read_csv(spark, path, SALES_FILE), CFG)


@query(sql("""
select company_name, voucher_type, count(*) as vouchers, cast(sum(amount) as double) as amount
from ledger group by all"""))
def csv_ledger_scan(spark: SparkSession, d: str) -> DataFrame:
    """Write the day book with its printed header, scan it by header, clean it."""
    path = scratch(spark, "ledger-csv")
    file = b.ledger_file(spark, d)
    printed = [f" {c.replace('_', ' ').title()} " for c in file.columns]
    writers.write_clean(file.toDF(*printed), path, "csv")
    df = cleaning.clean_ledger(readers.read_csv_by_header(spark, path), CFG)
    return df.groupBy("company_name", "voucher_type").agg(
        F.count(F.lit(1)).alias("vouchers"), exact_sum(F.col("amount")).alias("amount")
    )


@query(sql(f"""
select * from (
with items as ({CLEAN_BALANCE}), branches as (
  select company_name, count(*) as items, count(distinct hsn_code) as codes,
    cast(sum(closing_qty) as double) as pieces
  from raw_stock_balance group by company_name)
select * from items join branches using (company_name))"""))
def csv_balance_scan(spark: SparkSession, d: str) -> DataFrame:
    """Write the stock file as CSV, scan it by position and clean it: every row with
    all columns, and what its branch has of items, codes and pieces."""
    path = scratch(spark, "balance-csv")
    writers.write_clean(b.balance_file(spark, d), path, "csv")
    df = cleaning.clean_stock_balance(readers.read_csv(spark, path, BALANCE_FILE), CFG)
    branches = df.groupBy("company_name").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_distinct("hsn_code").alias("codes"),
        F.sum("closing_qty").alias("pieces"),
    )
    return df.join(branches, "company_name")


def _cell(name: str) -> Column:
    """A quoted cell; nothing between commas for null."""
    c = F.col(name).cast("string")
    return F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))


#: Rows of a landed file, about: less than a workbook sheet holds.
FILE_ROWS = 500_000


def _land(df: DataFrame, by: str, top: list[str], path: str) -> None:
    """Write CSV text as another program would: files of bounded size for each
    value of ``by``, first the given lines, then a line per row with every cell
    quoted. The rows are stored first, since they are counted, headed and written."""
    df = share(df)
    parts = 1 + df.count() // FILE_ROWS
    line = F.concat_ws(",", *[_cell(c) for c in df.columns])
    part = F.pmod(F.xxhash64(line), F.lit(parts)).cast("string")
    rows_ = df.select(
        F.concat_ws("-", F.col(by), part).alias("_file"), F.lit(len(top)).alias("_at"), line.alias("value")
    )
    heads = rows_.select("_file").distinct().select("_file", F.posexplode(F.array(*map(F.lit, top))))
    lines = heads.toDF("_file", "_at", "value").unionByName(rows_)
    in_order = lines.repartition("_file").sortWithinPartitions("_file", "_at", "value")
    in_order.select("_file", "value").write.partitionBy("_file").text(path)


TITLES = ["Report,Period,Jan to Dec", "All branches,,", ",,", '"printed ""today""",x,y']


def _report(df: DataFrame, names: list[str], path: str) -> None:
    """Land a report as it is printed: title lines, a header row in another order
    and with a column more, then rows, a file for each branch."""
    order = [names[-1], "Page", *names[:-1]]
    head = ",".join(f" {n.replace('_', ' ').title()} " for n in order)
    _land(df.withColumn("Page", F.lit("1")).select(*order), "company_name", [*TITLES, head], path)


@query(sql(f"""
select * exclude (tax_rate) replace (
  {doubles('retail_price item_rate item_net_amount tax_amount net_amount')})
from raw_purchase"""))
def report_purchase_scan(spark: SparkSession, d: str) -> DataFrame:
    """Land the purchase report with title lines, scan it in pieces, clean and
    stage it."""
    path = scratch(spark, "purchase-report")
    _report(b.raw_purchase(spark, d), PURCHASE_REPORT, path)
    raw = readers.read_report(spark, path, PURCHASE_REPORT, split_bytes=2**18)
    return stg_purchases(cleaning.clean_purchase(raw), CFG)


@query(sql(f"""
select 'dead_stock' as report, stock_no, company_name, last_purchase_date, last_sold_date,
  closing_bal_qty, sales_qty, cast(closing_bal_value as double) as money from dead_stock
union all
select 'stockout', stock_no, company_name, last_purchase_date, last_sold_date,
  closing_bal_qty, sales_qty, cast(sales_value as double) from stockout"""))
def report_stock_scan(spark: SparkSession, d: str) -> DataFrame:
    dead, out = scratch(spark, "dead-report"), scratch(spark, "stockout-report")
    totals = share(b.movement_totals(spark, d))
    _report(b.raw_dead_stock(spark, d, totals), DEAD_STOCK_REPORT, dead)
    _report(b.raw_stockout(spark, d, totals), STOCKOUT_REPORT, out)
    dead_df = stg_dead_stock(
        cleaning.clean_dead_stock(readers.read_report(spark, dead, DEAD_STOCK_REPORT)), CFG
    )
    out_df = stg_stockouts(
        cleaning.clean_stockout(readers.read_report(spark, out, STOCKOUT_REPORT)), CFG
    )
    shared = "stock_no company_name last_purchase_date last_sold_date closing_bal_qty sales_qty"
    return dead_df.select(
        F.lit("dead_stock").alias("report"),
        *shared.split(),
        F.col("closing_bal_value").alias("money"),
    ).unionByName(
        out_df.select(
            F.lit("stockout").alias("report"), *shared.split(), F.col("sales_value").alias("money")
        )
    )


@query(sql("""
select company_name, stock_no, item_description || chr(10) || 'second "line"' as item_description,
  hsn_code, cast(closing_qty as double) as closing_qty from raw_stock_balance"""))
def csv_quoted_scan(spark: SparkSession, d: str) -> DataFrame:
    """A stock file of a foreign program with line breaks and quotes in cells, read
    by many tasks: splits begin anywhere, also inside cells."""
    path = scratch(spark, "quoted-csv")
    broken = F.concat(F.col("item_description"), F.lit('\nsecond "line"'))
    file = b.balance_file(spark, d).withColumn("item_description", broken)
    _land(file, "company_name", [",".join(file.columns)], path)
    raw = readers.read_csv(spark, f"{path}/*", BALANCE_FILE, multi_line=True, split_bytes=2**15)
    df = cleaning.clean_stock_balance(raw, CFG)
    return df.select("company_name", "stock_no", "item_description", "hsn_code", "closing_qty")


@query(sql("""
select company_name, count(*) as records from raw_stock_balance group by company_name"""))
def csv_width_error(spark: SparkSession, d: str) -> DataFrame:
    """Stock files with a column too many: each record is reported, none read."""
    path = scratch(spark, "wide-csv")
    file = b.balance_file(spark, d).where(numbers.num_or_zero(F.col("closing_qty")) > 0)
    wide = rows.drop_null_keys(file, ["stock_no"]).withColumn("more", F.lit("x"))
    _land(wide, "company_name", [",".join(wide.columns)], path)
    found = readers.broken_records(spark, f"{path}/*", BALANCE_FILE)
    # the folder name is escaped once in the path and once more in the file's address
    folder = F.regexp_extract(F.url_decode(F.url_decode("_file")), "_file=(.*)-[0-9]+/", 1)
    branch = text.strip(folder)
    return found.groupBy(branch.alias("company_name")).agg(F.sum("records").alias("records"))


@query(sql(f"""
select * exclude (tax_rate) replace (
  {doubles('retail_price item_rate item_net_amount tax_amount net_amount')})
from raw_purchase"""))
def report_named_scan(spark: SparkSession, d: str) -> DataFrame:
    """The purchase report, all rows, with its columns in another order."""
    path = scratch(spark, "purchase-named")
    _report(b.raw_purchase(spark, d), PURCHASE_REPORT, path)
    df = cleaning.clean_purchase(readers.read_report(spark, path, PURCHASE_REPORT))
    return stg_purchases(df, CFG)


@query("""
select l_returnflag, l_linestatus,
  round(cast(sum(cast(v as decimal(38,18))) as double), 6) as total,
  round(cast(sum(cast(v as decimal(38,18))) as double) / count(v), 9) as average
from (select l_returnflag, l_linestatus, l_extendedprice * l_discount * l_tax / 7 as v from lineitem)
group by all""")
def exact_sums(spark: SparkSession, d: str) -> DataFrame:
    """Amounts with many places: neither sum nor mean is cut."""
    amount = F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax") / 7
    return b.table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(exact_sum(amount).cast("double"), 6).alias("total"),
        numbers.mean(amount, 9).alias("average"),
    )


@query(sql(f"""
select * replace (cast(inwards_qty as bigint) as inwards_qty,
  cast(outwards_qty as bigint) as outwards_qty, {doubles('debit_amount credit_amount amount')})
from ledger"""))
def table_load(spark: SparkSession, d: str) -> DataFrame:
    """The ledger after a full-refresh load of two month-partitioned tables, whose
    row counts are taken while writing and again from the stored files."""
    frames = {
        "ledger": cleaning.clean_ledger(b.ledger_file(spark, d), CFG),
        "sales": cleaning.clean_sales(b.sales_file(spark, d), CFG),
    }
    root = scratch(spark, "tables")
    writers.load_all(frames, root)
    stored = Tables.load(spark, root, ("ledger",))["ledger"]
    return rows.typed(stored, schema_for("ledger"))


@query(sql(f"""
select company_name, stock_no, sale_date, {dbl('line_revenue')} as line_revenue from stg_sales"""))
def catalog_table(spark: SparkSession, d: str) -> DataFrame:
    """Staged sales loaded twice into a bucketed catalog table of a namespace that
    is ensured twice, read by SQL."""
    folder = scratch(spark, "catalog")
    name = f"check_{folder[-12:]}"
    for _ in range(2):
        writers.ensure_namespace(spark, name, folder)
        lines = stg_stored_sales(share(b.raw_sales(spark, d)), CFG).select(
            "company_name", "stock_no", "sale_date", "line_revenue"
        )
        writers.load_table(lines, f"{name}.sales", bucket_by=(8, ["stock_no"]))
    return spark.sql(f"select * from {name}.sales")


@query(sql("""
select sale_year, count(*) as lines, count(distinct sale_date) as days
from raw_sales group by sale_year"""))
def typed_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """Read a loaded table back through its partition columns."""
    path = scratch(spark, "typed-sales")
    clean = cleaning.clean_sales(b.sales_file(spark, d), CFG)
    writers.save_table(
        rows.typed(clean, schema_for("sales")), path, writers.PARTITIONS["sales"]
    )
    stored = rows.typed(spark.read.parquet(path), schema_for("sales"))
    return stored.groupBy("sale_year").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("sale_date").alias("days")
    )


# --- ranks -----------------------------------------------------------------


@query(sql("""
select company_name, voucher_no, stock_no, sales_qty, cast(line_revenue as double) as revenue,
  rank() over (order by line_revenue desc nulls last) as overall_rank,
  rank() over (partition by company_name order by sales_qty desc nulls last) as qty_rank
from stg_sales"""))
def distributed_rank(spark: SparkSession, d: str) -> DataFrame:
    """Rank every bill line, overall and per branch, in range buckets."""
    from stallbook.checks.models import sales

    lines = sales(spark, d).select(
        "company_name", "voucher_no", "stock_no", "sales_qty", F.col("line_revenue").alias("revenue")
    )
    ranks = {
        "overall_rank": ((), "revenue"),
        "qty_rank": (["company_name"], "sales_qty"),
    }
    return add_ranks(lines, ranks)


@query("""
select c_mktsegment, c_custkey, c_acctbal,
  rank() over (partition by c_mktsegment order by c_acctbal desc nulls last) as balance_rank
from customer""")
def partition_rank(spark: SparkSession, d: str) -> DataFrame:
    customers = b.table(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return add_ranks(customers, {"balance_rank": (["c_mktsegment"], "c_acctbal")})


# --- types found from text -------------------------------------------------

GIVEN = "region nation customer supplier part orders lineitem events".split()


def _landed(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A given table as text, written as CSV and read back by its header."""
    path = scratch(spark, f"{name}-text")
    writers.write_clean(b.table(spark, d, name), path, "csv")
    return readers.read_csv_by_header(spark, path)


INFERRED = """
select '{0}' as file, "column", count(x) as filled, case
  when bool_and(lower(x) in ('true', 'false')) then 'boolean'
  when bool_and(regexp_full_match(x, '[+-]?(0|[1-9][0-9]{{0,17}})')) then 'bigint'
  when bool_and(try_cast(x as double) is not null) then 'double'
  when bool_and(length(x) = 10 and try_cast(x as date) is not null) then 'date'
  when bool_and(try_cast(x as timestamp) is not null) then 'timestamp'
  else 'string' end as type
from (unpivot (select cast(columns(*) as varchar) from {0}) on columns(*)
  into name "column" value x)
group by "column" """


@query(" union all ".join(INFERRED.format(t) for t in GIVEN))
def inferred_types(spark: SparkSession, d: str) -> DataFrame:
    """The type of every column of the given tables, found from their text."""
    found = [
        inference.profile(_landed(spark, d, t)).withColumn("file", F.lit(t)) for t in GIVEN
    ]
    return reduce(DataFrame.unionByName, found)


@query("""
select * replace (cast(l_linenumber as bigint) as l_linenumber) from lineitem""")
def inferred_load(spark: SparkSession, d: str) -> DataFrame:
    """Order lines from text, with the types that were found, after a load that
    replaces an earlier one."""
    path = scratch(spark, "inferred")
    lines = inference.typed(_landed(spark, d, "lineitem"))
    for df in (lines.limit(10), lines):
        writers.load_report(df, path)
    return spark.read.parquet(path)


# --- date layouts ----------------------------------------------------------

FILE_LAYOUTS = ("d/M/yyyy", "M/d/yyyy", "yyyy-M-d")


@query(f"""
with c as (
  select cast(o_orderkey % 3 as integer) as file, cast(o_orderdate as date) as d,
    o_orderkey % 97 = 0 as junk
  from orders)
select file, [{", ".join(f"'{f}[ H:mm[:ss]]'" for f in FILE_LAYOUTS)}][file + 1] as layout,
  count(*) as cells, count(*) filter (not junk) as read, count(*) filter (junk) as dropped,
  count(*) filter (not junk and file < 2 and day(d) <= 12 and day(d) <> month(d)) as ambiguous,
  min(d) filter (not junk) as first_day, max(d) filter (not junk) as last_day,
  cast(sum(case when not junk then datediff('day', date '1970-01-01', d) end) as bigint) as days
from c group by file""")
def date_layouts_found(spark: SparkSession, d: str) -> DataFrame:
    """Order dates as three files print them, some cells unreadable: the layout
    found for each file, what it drops, and the dates read with it."""
    file = (F.col("o_orderkey") % 3).cast("int")
    printed = F.coalesce(
        *[F.when(file == i, F.date_format("o_orderdate", f)) for i, f in enumerate(FILE_LAYOUTS)]
    )
    cells = b.table(spark, d, "orders").select(
        file.alias("file"), F.when(F.col("o_orderkey") % 97 == 0, "n.a.").otherwise(printed).alias("day")
    )
    found = layouts.find_layouts(cells, "file", "day")
    read = layouts.parse_found(cells, "file", "day", found).groupBy("file").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.sum(F.unix_date("day")).cast("long").alias("days"),
    )
    return found.join(read, "file")
