"""Declared schemas of the raw files, and of the tables loaded from them."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: column order of the exported files ----------------------

SALES_FILE = (
    "company_name voucher_type voucher_date voucher_no particulars stock_no "
    "item_description product brand style shade size retail_price sales_qty "
    "base_uom alt_sales_qty net_amount remarks"
).split()
RETURNS_FILE = (
    "company_name voucher_type voucher_date voucher_no particulars stock_no "
    "item_description product brand style shade size retail_price return_qty "
    "base_uom net_amount remarks"
).split()
BALANCE_FILE = (
    "company_name stock_no item_description product brand style shade size "
    "hsn_code supplier_name item_type agent party cost_price retail_price "
    "base_uom closing_qty closing_rate closing_value"
).split()
MOVEMENT_FILE = (
    "company_name stock_no item_description product brand style shade size "
    "hsn_code supplier_name item_type agent party cost_price retail_price "
    "base_uom opening_qty opening_val inwards_qty outwards_qty closing_qty closing_val"
).split()
LEDGER_FILE = (
    "company_name city voucher_date voucher_no voucher_type particulars narration "
    "user_name inwards_qty outwards_qty debit_amount credit_amount"
).split()
PURCHASE_REPORT = (
    "company_name stock_no item_description product brand style shade size "
    "voucher_no voucher_type voucher_date supplier_name purchase_qty retail_price "
    "item_rate item_net_amount tax_amount net_amount"
).split()
DEAD_STOCK_REPORT = (
    "company_name stock_no item_description product brand style shade size "
    "last_purchase_date last_sold_date retail_price closing_bal_qty "
    "closing_bal_value sales_qty"
).split()
STOCKOUT_REPORT = (
    "company_name stock_no item_description product brand style shade size "
    "last_purchase_date last_sold_date retail_price closing_bal_qty sales_qty "
    "sales_value"
).split()

FILES = {
    "sales": SALES_FILE,
    "sales_returns": RETURNS_FILE,
    "stock_balance": BALANCE_FILE,
    "stock_movement": MOVEMENT_FILE,
    "ledger": LEDGER_FILE,
    "purchase": PURCHASE_REPORT,
    "dead_stock": DEAD_STOCK_REPORT,
    "stockout": STOCKOUT_REPORT,
}

# Types by name, the same in every table; everything else is text.
DOUBLES = frozenset(
    "retail_price sales_qty alt_sales_qty net_amount return_qty cost_price closing_qty "
    "closing_rate closing_value opening_qty opening_val inwards_qty outwards_qty "
    "closing_val item_rate item_net_amount tax_amount closing_bal_value sales_value "
    "line_revenue full_mrp_value discount_given discount_pct return_value "
    "return_value_per_unit margin_pct retail_value capital_locked sell_through_pct "
    "retail_value_closing debit_amount credit_amount amount".split()
)
# Cells of a text file that are read as numbers.
NUMBERS = DOUBLES | {"purchase_qty", "closing_bal_qty"}
LONGS = frozenset(
    "sale_year sale_month sale_quarter sale_week return_year return_month "
    "return_quarter year month week quarter purchase_qty closing_bal_qty".split()
)
DATES = frozenset(
    "sale_date return_date voucher_date last_purchase_date last_sold_date".split()
)
BOOLEANS = frozenset("is_b2b has_customer_name is_active".split())

# Columns of the loaded (clean) tables.
CLEAN_TABLES = {
    "sales": (
        "company_name voucher_type voucher_no customer_ref stock_no item_description "
        "product brand style shade size retail_price sales_qty base_uom net_amount "
        "sale_date sale_year sale_month sale_month_name sale_quarter sale_week sale_dow "
        "line_revenue full_mrp_value discount_given discount_pct is_b2b"
    ).split(),
    "sales_returns": (
        "company_name voucher_type voucher_no customer_ref stock_no item_description "
        "product brand style shade size retail_price return_qty base_uom return_date "
        "return_year return_month return_month_name return_quarter return_value "
        "return_value_per_unit has_customer_name"
    ).split(),
    "stock_balance": (
        "company_name stock_no item_description product brand style shade size hsn_code "
        "supplier_name item_type cost_price retail_price base_uom closing_qty "
        "closing_rate closing_value margin_pct retail_value capital_locked"
    ).split(),
    "stock_movement": (
        "company_name stock_no item_description product brand style shade size hsn_code "
        "supplier_name cost_price retail_price base_uom opening_qty opening_val "
        "inwards_qty outwards_qty closing_qty closing_val sell_through_pct "
        "capital_locked retail_value_closing movement_status margin_pct"
    ).split(),
    "ledger": LEDGER_FILE
    + (
        "amount expense_category branch_type is_active year month month_name week "
        "quarter day_of_week"
    ).split(),
    "purchase": PURCHASE_REPORT,
    "dead_stock": DEAD_STOCK_REPORT,
    "stockout": STOCKOUT_REPORT,
}

# Tables where a quantity is a whole number of pieces.
LONG_QTY = {
    "ledger": {"inwards_qty", "outwards_qty"},
    "dead_stock": {"sales_qty"},
    "stockout": {"sales_qty"},
}


def text_schema(names: list[str]) -> T.StructType:
    """All columns as string: files are read as text and cast afterwards."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def schema_for(table: str) -> T.StructType:
    """Declared types of a clean table: by column name, text otherwise."""
    longs = LONGS | LONG_QTY.get(table, set())

    def kind(name: str) -> T.DataType:
        if name in longs:
            return T.LongType()
        if name in DOUBLES:
            return T.DoubleType()
        if name in DATES:
            return T.DateType()
        if name in BOOLEANS:
            return T.BooleanType()
        return T.StringType()

    return T.StructType([T.StructField(n, kind(n)) for n in CLEAN_TABLES[table]])
