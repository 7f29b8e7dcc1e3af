"""Retail tables derived from the order tables (region, nation, customer,
supplier, part, orders, lineitem).

A region plays a branch, an open order line a bill line, a closed one a purchase
line, an order a ledger voucher. Money is rounded to five places at most. No join
carries a broadcast hint: tables are joined one by one onto the larger side, so
Spark sees the file size of each and broadcasts it only while that is small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.config import RetailConfig
from stallbook.functions import dates
from stallbook.functions.numbers import safe_ratio
from stallbook.operators.shared import at_once, share
from stallbook.plans.cleaning import balance_measures, clean_ledger, movement_measures

CFG = RetailConfig(
    head_offices=("AFRICA",),
    active_branches=("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    branch_alias={},
)
# The same, with two branches known under an earlier name.
ALIAS_CFG = RetailConfig(
    head_offices=("AFRICA",),
    active_branches=("AMERICA", "ASIA"),
    branch_alias={"EUROPE": "ASIA", "MIDDLE EAST": "AMERICA"},
)
AS_OF = "2001-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(c: Column, digits: int) -> Column:
    """The double nearest to the value with that many decimal places."""
    return F.rint(c * float(10**digits)) / F.lit(float(10**digits))


def _amount_text(c: Column, digits: int) -> Column:
    return c.cast(f"decimal(18,{digits})").cast("string")


def _branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", F.col("r_name").alias("company_name")
    )


def _customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    places = _branches(spark, sf_dir)
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        places, customer.c_nationkey == places.n_nationkey
    )


def raw_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with branch, item and money."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    orders = _customer_orders(spark, sf_dir)
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey).join(
        part, line.l_partkey == part.p_partkey
    )
    qty = F.col("l_quantity").cast("bigint")
    price = _places(F.col("p_retailprice"), 2)
    mrp = _places(qty * price, 2)
    return joined.select(
        "company_name",
        F.col("o_orderdate").cast("date").alias("txn_date"),
        F.col("l_orderkey").cast("string").alias("voucher_no"),
        F.col("l_partkey").cast("string").alias("stock_no"),
        F.col("p_name").alias("item_description"),
        F.col("p_type").alias("product"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("style"),
        F.col("p_size").cast("string").alias("size"),
        price.alias("retail_price"),
        qty.alias("qty"),
        F.col("l_linenumber").alias("line_no"),
        mrp.alias("full_mrp_value"),
        # scaled so that discounts above 20 % occur
        _places(mrp * _places(F.col("l_discount") * 2.5, 3), 5).alias("discount_given"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_b2b"),
        F.col("c_name").alias("customer_ref"),
        "l_returnflag",
        "l_linestatus",
    )


def open_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that sales and returns are made of; stored, they are joined once."""
    return raw_line(spark, sf_dir).filter(F.col("l_linestatus") == "O")


def _bill_lines(lines: DataFrame) -> DataFrame:
    """Bill lines without the calendar columns, which follow from the date."""
    return lines.select(
        "company_name",
        F.when(F.col("is_b2b"), "B2B SALE").otherwise("SALES").alias("voucher_type"),
        F.col("txn_date").alias("sale_date"),
        "voucher_no",
        "customer_ref",
        "stock_no",
        "item_description",
        "product",
        "brand",
        "style",
        F.lit(None).cast("string").alias("shade"),
        "size",
        F.lit("PCS").alias("base_uom"),
        "retail_price",
        F.col("qty").alias("sales_qty"),
        _places(F.col("full_mrp_value") - F.col("discount_given"), 5).alias("line_revenue"),
        "full_mrp_value",
        "discount_given",
        safe_ratio(F.col("discount_given"), F.col("full_mrp_value"), 100, digits=2).alias(
            "discount_pct"
        ),
        "is_b2b",
    )


def raw_sales(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    lines = open_lines(spark, sf_dir) if lines is None else lines
    return dates.calendar(_bill_lines(lines), "sale_date", "sale_")


def stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`raw_sales`, stored; the calendar is made where it is read, so plans that
    do not use it neither make nor write its texts."""
    return dates.calendar(share(_bill_lines(open_lines(spark, sf_dir))), "sale_date", "sale_")


def raw_sales_returns(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    lines = open_lines(spark, sf_dir) if lines is None else lines
    lines = lines.filter(F.col("l_returnflag") == "R")
    value = _places(F.col("full_mrp_value") - F.col("discount_given"), 5)
    # the seventh line of an order returns one more than was sold
    returned = F.when(F.col("line_no") == 7, F.col("qty") + 1).otherwise(F.col("qty"))
    df = lines.select(
        "company_name",
        F.lit("SALES RETURN").alias("voucher_type"),
        F.col("txn_date").alias("return_date"),
        "voucher_no",
        F.when(F.col("line_no") != 1, F.col("customer_ref")).alias("customer_ref"),
        "stock_no",
        "item_description",
        "product",
        "brand",
        "style",
        F.lit(None).cast("string").alias("shade"),
        "size",
        F.lit("PCS").alias("base_uom"),
        "retail_price",
        returned.alias("return_qty"),
        value.alias("return_value"),
    )
    df = df.withColumns(
        {
            "return_value_per_unit": safe_ratio(
                F.col("return_value"), F.col("return_qty"), digits=2
            ),
            "has_customer_name": F.col("customer_ref").isNotNull(),
        }
    )
    return dates.calendar(df, "return_date", "return_", ["year", "month", "month_name", "quarter"])


def raw_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier, places = table(spark, sf_dir, "supplier"), _branches(spark, sf_dir)
    joined = (
        line.filter(F.col("l_linestatus") == "F")
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(places, supplier.s_nationkey == places.n_nationkey)
        .join(part, line.l_partkey == part.p_partkey)
    )
    qty = F.col("l_quantity").cast("bigint") * F.when(F.length("p_brand") == 7, 3).otherwise(1)
    price = _places(F.col("p_retailprice"), 2)
    part_of_price = _places(0.35 + 0.15 * (F.length("p_type") % 3) + F.col("l_tax") * 5, 2)
    rate = _places(price * part_of_price, 4)
    net = _places(qty * rate, 4)
    tax = _places(net * F.col("l_tax"), 5)
    return joined.select(
        "company_name",
        F.col("l_partkey").cast("string").alias("stock_no"),
        F.col("p_name").alias("item_description"),
        F.col("p_type").alias("product"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("style"),
        F.lit(None).cast("string").alias("shade"),
        F.col("p_size").cast("string").alias("size"),
        F.col("l_orderkey").cast("string").alias("voucher_no"),
        F.lit("PURCHASE").alias("voucher_type"),
        F.col("l_shipdate").cast("date").alias("voucher_date"),
        F.col("s_name").alias("supplier_name"),
        qty.alias("purchase_qty"),
        price.alias("retail_price"),
        rate.alias("item_rate"),
        net.alias("item_net_amount"),
        tax.alias("tax_amount"),
        _places(net + tax, 5).alias("net_amount"),
    )


def movement_totals(
    spark: SparkSession,
    sf_dir: str,
    sales: DataFrame | None = None,
    purchases: DataFrame | None = None,
) -> DataFrame:
    """Pieces in (purchases) and out (sales) per branch and SKU; both are derived
    here unless the caller has them."""
    sales = raw_sales(spark, sf_dir) if sales is None else sales
    purchases = raw_purchase(spark, sf_dir) if purchases is None else purchases
    item = ["company_name", "stock_no", "item_description", "product", "brand", "size"]
    moved_in = purchases.select(
        *item,
        "retail_price",
        F.col("item_rate").alias("cost_price"),
        "supplier_name",
        F.col("purchase_qty").alias("q_in"),
        F.lit(0).cast("bigint").alias("q_out"),
        F.col("voucher_date").alias("purchased"),
        F.lit(None).cast("date").alias("sold"),
    )
    moved_out = (
        sales
        .filter(F.col("sales_qty") > 0)
        .select(
            *item,
            "retail_price",
            F.lit(None).cast("double").alias("cost_price"),
            F.lit(None).cast("string").alias("supplier_name"),
            F.lit(0).cast("bigint").alias("q_in"),
            F.col("sales_qty").alias("q_out"),
            F.lit(None).cast("date").alias("purchased"),
            F.col("sale_date").alias("sold"),
        )
    )
    return (
        moved_in.unionByName(moved_out)
        # texts are aggregated in sorted rows, and a code decides more than a branch
        .groupBy("stock_no", "company_name")
        .agg(
            *[F.max(c).alias(c) for c in item[2:]],
            F.max("retail_price").alias("retail_price"),
            F.max("cost_price").alias("cost_price"),
            F.max("supplier_name").alias("supplier_name"),
            F.sum("q_in").alias("inwards_qty"),
            F.sum("q_out").alias("outwards_qty"),
            F.max("purchased").alias("last_purchase_date"),
            F.max("sold").alias("last_sold_date"),
        )
        .withColumn("closing_qty", F.col("inwards_qty") - F.col("outwards_qty"))
        .select(
            *item,
            "retail_price",
            "cost_price",
            "supplier_name",
            "inwards_qty",
            "outwards_qty",
            "last_purchase_date",
            "last_sold_date",
            "closing_qty",
        )
    )


def _item_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "style": F.concat(F.lit("S"), F.col("size")),
            "shade": F.lit(None).cast("string"),
            "hsn_code": F.concat(F.lit("61"), F.col("size")),
            "item_type": F.lit("GOODS"),
            "base_uom": F.lit("PCS"),
        }
    )


def raw_stock_movement(
    spark: SparkSession, sf_dir: str, totals: DataFrame | None = None
) -> DataFrame:
    totals = movement_totals(spark, sf_dir) if totals is None else totals
    df = _item_columns(totals).withColumns(
        {
            "opening_qty": F.lit(0).cast("bigint"),
            "opening_val": F.lit(0).cast("double"),
            "closing_val": _places(F.col("closing_qty") * F.col("cost_price"), 4),
        }
    )
    return movement_measures(df)


def raw_stock_balance(
    spark: SparkSession, sf_dir: str, totals: DataFrame | None = None
) -> DataFrame:
    totals = movement_totals(spark, sf_dir) if totals is None else totals
    df = _item_columns(totals).filter(F.col("closing_qty") > 0)
    df = df.withColumns(
        {
            "closing_rate": F.col("cost_price"),
            "closing_value": _places(F.col("closing_qty") * F.col("cost_price"), 4),
        }
    )
    return balance_measures(df)


def raw_dead_stock(
    spark: SparkSession, sf_dir: str, totals: DataFrame | None = None
) -> DataFrame:
    """In stock and never sold."""
    totals = movement_totals(spark, sf_dir) if totals is None else totals
    df = _item_columns(totals).filter(
        (F.col("closing_qty") > 0) & (F.col("outwards_qty") == 0)
    )
    return df.select(
        *"company_name stock_no item_description product brand style shade size".split(),
        "last_purchase_date",
        "last_sold_date",
        "retail_price",
        F.col("closing_qty").alias("closing_bal_qty"),
        _places(F.col("closing_qty") * F.col("cost_price"), 4).alias("closing_bal_value"),
        F.col("outwards_qty").alias("sales_qty"),
    )


def raw_stockout(
    spark: SparkSession, sf_dir: str, totals: DataFrame | None = None
) -> DataFrame:
    """Sold and out of stock."""
    totals = movement_totals(spark, sf_dir) if totals is None else totals
    df = _item_columns(totals).filter(
        (F.col("closing_qty") == 0) & (F.col("outwards_qty") > 0)
    )
    return df.select(
        *"company_name stock_no item_description product brand style shade size".split(),
        "last_purchase_date",
        "last_sold_date",
        "retail_price",
        F.col("closing_qty").alias("closing_bal_qty"),
        F.col("outwards_qty").alias("sales_qty"),
        _places(F.col("outwards_qty") * F.col("retail_price"), 2).alias("sales_value"),
    )


# --- files as text: what the cleaning plans start from ----------------------

VOUCHERS = (
    "B2B Sale",
    "Retail Credit Note",
    "Sales Return",
    "Purchase",
    "Purchase Return",
    "Transfer In",
    "Transfer Out",
    "Receipt",
    "Stock Journal",
    "Payment",
    "Payment",
    "Payment",
    "Payment",
    "Sales (Void)",
)
CREDIT_SIDE = (
    "Sales Return",
    "Retail Credit Note",
    "Purchase",
    "Transfer In",
    "Receipt",
)
PARTICULARS = {
    "1-URGENT": "Salary Exp",
    "2-HIGH": "SHOP EXP ",
    "3-MEDIUM": "freight",
    "4-NOT SPECIFIED": "General Exp",
}


def _padded(c: Column, key: Column) -> Column:
    """Blanks and tabs around every third text."""
    return F.when(key % 3 == 0, F.concat(F.lit(" \t"), c, F.lit("  "))).otherwise(c)


def _text_date(c: Column) -> Column:
    return F.date_format(c, "dd-MM-yyyy HH:mm:ss")


def ledger_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day book as delivered: one text row per order, the amount on the side
    its voucher type is booked on, with padding, voids, sub-totals and gaps."""
    orders = _customer_orders(spark, sf_dir)
    key = F.col("o_orderkey")
    voucher = F.coalesce(
        F.get(F.array(*[F.lit(v) for v in VOUCHERS]), (key % 20).cast("int")), F.lit("Sales")
    )
    particulars = F.when(F.col("o_orderstatus") == "P", F.lit("Misc"))
    for priority, label in PARTICULARS.items():
        particulars = particulars.when(F.col("o_orderpriority") == priority, label)
    particulars = particulars.otherwise("HOME EXP")
    gross = _amount_text(F.col("o_totalprice"), 2)
    credit_side = voucher.isin(*CREDIT_SIDE)
    return orders.select(
        _padded(F.col("company_name"), key).alias("company_name"),
        F.col("n_name").alias("city"),
        F.when(key % 101 == 0, F.lit("unknown"))
        .otherwise(_text_date(F.col("o_orderdate")))
        .alias("voucher_date"),
        key.cast("string").alias("voucher_no"),
        voucher.alias("voucher_type"),
        F.when(key % 97 == 0, F.lit("SUB TOTAL")).otherwise(particulars).alias("particulars"),
        F.when(key % 2 == 0, F.lit("narration ")).alias("narration"),
        F.col("c_name").alias("user_name"),
        F.lit("0").alias("inwards_qty"),
        F.when(key % 5 == 0, F.lit("n/k")).otherwise("1").alias("outwards_qty"),
        F.when(credit_side, F.when(key % 2 == 0, F.lit("abc"))).otherwise(gross).alias(
            "debit_amount"
        ),
        F.when(credit_side, gross).alias("credit_amount"),
    )


def sales_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales export as delivered: 18 text columns."""
    lines = raw_line(spark, sf_dir).filter(F.col("l_linestatus") == "O")
    net = F.col("full_mrp_value") - F.col("discount_given")
    return lines.select(
        _padded(F.col("company_name"), F.col("line_no")).alias("company_name"),
        F.when(F.col("is_b2b"), "B2b Sale").otherwise("Sales ").alias("voucher_type"),
        _text_date(F.col("txn_date").cast("timestamp")).alias("voucher_date"),
        "voucher_no",
        F.col("customer_ref").alias("particulars"),
        "stock_no",
        "item_description",
        F.lower("product").alias("product"),
        F.concat(F.col("brand"), F.lit("  ")).alias("brand"),
        "style",
        F.lit(None).cast("string").alias("shade"),
        "size",
        _amount_text(F.col("retail_price"), 2).alias("retail_price"),
        F.col("qty").cast("string").alias("sales_qty"),
        F.lit("PCS").alias("base_uom"),
        F.lit(None).cast("string").alias("alt_sales_qty"),
        _amount_text(net, 5).alias("net_amount"),
        F.lit(None).cast("string").alias("remarks"),
    )


def returns_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returns export as delivered: 17 text columns."""
    raw = raw_sales_returns(spark, sf_dir)
    return raw.select(
        F.concat(F.lit(" "), F.col("company_name")).alias("company_name"),
        F.lit("Sales Return").alias("voucher_type"),
        _text_date(F.col("return_date").cast("timestamp")).alias("voucher_date"),
        "voucher_no",
        F.col("customer_ref").alias("particulars"),
        "stock_no",
        "item_description",
        F.lower("product").alias("product"),
        "brand",
        "style",
        "shade",
        "size",
        _amount_text(F.col("retail_price"), 2).alias("retail_price"),
        F.col("return_qty").cast("string").alias("return_qty"),
        "base_uom",
        _amount_text(F.col("return_value"), 5).alias("net_amount"),
        F.lit(None).cast("string").alias("remarks"),
    )


def _stock_file(df: DataFrame, numbers: dict[str, Column]) -> DataFrame:
    return df.select(
        F.concat(F.col("company_name"), F.lit("\t")).alias("company_name"),
        "stock_no",
        "item_description",
        F.lower("product").alias("product"),
        "brand",
        "style",
        "shade",
        "size",
        F.concat(F.col("hsn_code"), F.lit(".0")).alias("hsn_code"),
        "supplier_name",
        "item_type",
        F.lit("agent").alias("agent"),
        F.lit("party").alias("party"),
        _amount_text(F.col("cost_price"), 4).alias("cost_price"),
        _amount_text(F.col("retail_price"), 2).alias("retail_price"),
        "base_uom",
        *[c.cast("string").alias(name) for name, c in numbers.items()],
    )


def movement_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock movement export as delivered: 22 text columns."""
    return _stock_file(
        _item_columns(movement_totals(spark, sf_dir)),
        {
            "opening_qty": F.lit(0),
            "opening_val": F.lit(0),
            "inwards_qty": F.col("inwards_qty"),
            "outwards_qty": F.col("outwards_qty"),
            "closing_qty": F.col("closing_qty"),
            "closing_val": _amount_text(F.col("closing_qty") * F.col("cost_price"), 4),
        },
    )


def balance_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock balance export as delivered: 19 text columns."""
    return _stock_file(
        _item_columns(movement_totals(spark, sf_dir)),
        {
            "closing_qty": F.col("closing_qty"),
            "closing_rate": _amount_text(F.col("cost_price"), 4),
            "closing_value": _amount_text(F.col("closing_qty") * F.col("cost_price"), 4),
        },
    )


def raw_tables(
    spark: SparkSession,
    sf_dir: str,
    store: Callable[[str, DataFrame], DataFrame] = lambda _, df: share(df),
) -> dict[str, DataFrame]:
    """Every raw table by its catalog name. The ledger comes from its file; the
    four stock tables come from one stored movement table. Sales and purchases are
    read for it again: ``store`` keeps them under their names and reads them back.
    Sales and returns come from stored lines."""

    def sold() -> tuple[DataFrame, DataFrame]:
        lines = share(open_lines(spark, sf_dir))
        return lines, store("sales", raw_sales(spark, sf_dir, lines))

    def purchased() -> DataFrame:
        return store("purchase", raw_purchase(spark, sf_dir))

    (lines, sales), bought = at_once(spark, sold, purchased)
    totals = share(movement_totals(spark, sf_dir, sales, bought))
    return {
        "sales": sales,
        "sales_returns": raw_sales_returns(spark, sf_dir, lines),
        "purchase": bought,
        "stock_movement": raw_stock_movement(spark, sf_dir, totals),
        "stock_balance": raw_stock_balance(spark, sf_dir, totals),
        "dead_stock": raw_dead_stock(spark, sf_dir, totals),
        "stockout": raw_stockout(spark, sf_dir, totals),
        "ledger": clean_ledger(ledger_file(spark, sf_dir), CFG),
    }
