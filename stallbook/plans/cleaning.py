"""Text files as delivered -> clean raw tables. Row-local: no shuffle anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.config import RetailConfig
from stallbook.functions import dates, numbers, rules, text
from stallbook.functions.numbers import round_half_even, safe_ratio
from stallbook.operators import rows
from stallbook.schemas import BALANCE_FILE, CLEAN_TABLES, LEDGER_FILE, MOVEMENT_FILE, NUMBERS

SUB_TOTAL = "Sub Total"
VOID = "(Void)"


def _numbers(df: DataFrame) -> DataFrame:
    """Numeric columns of a file read as text; unreadable cells become null."""
    return rows.with_existing(df, sorted(NUMBERS), numbers.parse_number)


def _percent(num: Column, den: Column) -> Column:
    return round_half_even(safe_ratio(num, den, 100), 2)


def _branch_rows(df: DataFrame, cfg: RetailConfig, keys: Sequence[str]) -> DataFrame:
    """Trim, drop rows without key, keep known branches. Names are compared as
    written, before upper-casing."""
    df = rows.trim_strings(df)
    df = rows.drop_null_keys(df, keys)
    return rows.keep_values(df, "company_name", cfg.branches)


# --- sales and returns -----------------------------------------------------


def sales_money(df: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Money of a bill line: revenue, value at list price, discount, B2B flag."""
    df = df.withColumns(
        {
            "line_revenue": round_half_even(F.col("net_amount"), 2),
            "full_mrp_value": round_half_even(F.col("sales_qty") * F.col("retail_price"), 2),
        }
    )
    df = df.withColumn(
        "discount_given", round_half_even(F.col("full_mrp_value") - F.col("net_amount"), 2)
    )
    return df.withColumns(
        {
            "discount_pct": _percent(F.col("discount_given"), F.col("full_mrp_value")),
            "is_b2b": F.coalesce(F.col("voucher_type") == cfg.b2b_voucher, F.lit(False)),
        }
    )


def clean_sales(
    file: DataFrame, cfg: RetailConfig, formats: Sequence[str] = dates.DAY_FIRST
) -> DataFrame:
    df = _numbers(_branch_rows(file, cfg, ["company_name", "stock_no", "voucher_date"]))
    df = rows.upper_trim(df, ["company_name", "product", "brand", "voucher_type"])
    df = rows.rename(df, {"particulars": "customer_ref"})
    df = df.withColumn("sale_date", dates.parse_date(F.col("voucher_date"), formats, strict=True))
    df = dates.calendar(df, "sale_date", "sale_")
    return sales_money(df, cfg).select(*CLEAN_TABLES["sales"])


def return_money(df: DataFrame) -> DataFrame:
    """Money of a return line, and whether a customer was named."""
    return df.withColumns(
        {
            "return_value": round_half_even(F.col("net_amount"), 2),
            "return_value_per_unit": round_half_even(
                safe_ratio(F.col("net_amount"), F.col("return_qty")), 2
            ),
            "has_customer_name": F.col("customer_ref").isNotNull(),
        }
    )


def clean_sales_returns(
    file: DataFrame, cfg: RetailConfig, formats: Sequence[str] = dates.DAY_FIRST
) -> DataFrame:
    df = _numbers(_branch_rows(file, cfg, ["company_name", "stock_no", "voucher_date"]))
    df = rows.upper_trim(df, ["company_name", "product", "brand", "voucher_type"])
    df = rows.rename(df, {"particulars": "customer_ref"})
    df = df.withColumn("return_date", dates.parse_date(F.col("voucher_date"), formats, strict=True))
    df = dates.calendar(df, "return_date", "return_", ["year", "month", "month_name", "quarter"])
    return return_money(df).select(*CLEAN_TABLES["sales_returns"])


# --- stock -----------------------------------------------------------------


def balance_measures(df: DataFrame) -> DataFrame:
    """Margin (null where the price is 0), value at list price, capital."""
    price = F.col("retail_price")
    return df.withColumns(
        {
            "margin_pct": _percent(price - F.col("cost_price"), price),
            "retail_value": round_half_even(F.col("closing_qty") * price, 2),
            "capital_locked": round_half_even(F.col("closing_value"), 2),
        }
    )


def clean_stock_balance(file: DataFrame, cfg: RetailConfig) -> DataFrame:
    df = _numbers(_branch_rows(file.select(*BALANCE_FILE), cfg, ["company_name", "stock_no"]))
    df = df.filter(F.col("closing_qty") > 0).drop("agent", "party")
    df = rows.with_existing(df, ["hsn_code"], text.strip_dot_zero)
    df = rows.upper_trim(df, ["company_name", "product", "brand", "item_type"])
    return balance_measures(df).select(*CLEAN_TABLES["stock_balance"])


def movement_measures(df: DataFrame) -> DataFrame:
    """Sell-through, capital, value at list price, status and margin."""
    price = F.col("retail_price")
    return df.withColumns(
        {
            "sell_through_pct": _percent(F.col("outwards_qty"), F.col("inwards_qty")),
            "capital_locked": round_half_even(F.col("closing_val"), 2),
            "retail_value_closing": round_half_even(F.col("closing_qty") * price, 2),
            "movement_status": rules.movement_status(
                F.col("inwards_qty"), F.col("outwards_qty"), F.col("closing_qty")
            ),
            "margin_pct": _percent(price - F.col("cost_price"), price),
        }
    )


def clean_stock_movement(file: DataFrame, cfg: RetailConfig) -> DataFrame:
    df = _numbers(_branch_rows(file.select(*MOVEMENT_FILE), cfg, ["company_name", "stock_no"]))
    df = df.drop("agent", "party", "item_type")
    df = rows.with_existing(df, ["hsn_code"], text.strip_dot_zero)
    df = rows.upper_trim(df, ["company_name", "product", "brand"])
    return movement_measures(df).select(*CLEAN_TABLES["stock_movement"])


# --- ledger ----------------------------------------------------------------


def ledger_drops(cfg: RetailConfig, formats: Sequence[str] = dates.DAY_FIRST) -> dict[str, Column]:
    """The rules that drop ledger rows, in order. Voucher types are compared as
    delivered: a padded name is not excluded."""
    voucher = F.col("voucher_type")
    return {
        "no_branch": F.coalesce(text.strip(F.col("company_name")) == "", F.lit(True)),
        "sub_total": text.contains_ci(F.col("particulars"), SUB_TOTAL),
        "void": text.contains_ci(voucher, VOID),
        "not_financial": rows.excluded(voucher, cfg.excluded_vouchers),
        "no_date": dates.parse_date(F.col("voucher_date"), formats).isNull(),
    }


def clean_ledger(
    file: DataFrame, cfg: RetailConfig, formats: Sequence[str] = dates.DAY_FIRST
) -> DataFrame:
    df = file.select(*LEDGER_FILE)
    for drops in ledger_drops(cfg, formats).values():
        df = df.filter(~drops)

    df = df.withColumn("voucher_date", dates.parse_date(F.col("voucher_date"), formats))
    df = rows.fill_text(
        df, ["company_name", "city", "voucher_type", "particulars", "narration", "user_name"]
    )
    df = rows.with_existing(
        df,
        ["inwards_qty", "outwards_qty", "debit_amount", "credit_amount"],
        numbers.num_or_zero,
    )
    df = rows.upper_trim(df, ["particulars"])
    df = df.withColumn("voucher_type", rules.map_values(F.col("voucher_type"), cfg.voucher_map))

    voucher, branch = F.col("voucher_type"), F.col("company_name")
    df = df.withColumns(
        {
            "amount": rules.ledger_amount(
                cfg, voucher, F.col("debit_amount"), F.col("credit_amount")
            ),
            "expense_category": rules.expense_category(cfg, voucher, F.col("particulars")),
            "branch_type": rules.branch_type(branch, cfg),
            "is_active": branch.isin(*cfg.active_branches),
        }
    )
    df = dates.calendar(
        df, "voucher_date", label_format="MMM yyyy", names={"dow": "day_of_week"}
    )
    return df.select(*CLEAN_TABLES["ledger"])


# --- reports ---------------------------------------------------------------


def clean_report(
    file: DataFrame, date_cols: Sequence[str], formats: Sequence[str] = dates.MONTH_FIRST
) -> DataFrame:
    """Purchase, dead-stock and stockout reports: drop rows without branch, read
    the dates leniently. These exports are not day-first, hence the parameter."""
    df = rows.drop_null_keys(file, ["company_name"])
    df = rows.with_existing(df, date_cols, lambda c: dates.parse_date(c, formats))
    return _numbers(df)


def clean_purchase(file: DataFrame, formats: Sequence[str] = dates.MONTH_FIRST) -> DataFrame:
    return clean_report(file, ["voucher_date"], formats)


def clean_dead_stock(file: DataFrame, formats: Sequence[str] = dates.MONTH_FIRST) -> DataFrame:
    return clean_report(file, ["last_purchase_date", "last_sold_date"], formats)


clean_stockout = clean_dead_stock
