"""Ordered business rules and code maps as ``when`` chains and map look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallbook.config import RetailConfig


def tier(rules: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """First rule that holds gives the label; a null condition does not hold."""
    (condition, label), *rest = rules
    out = F.when(condition, label)
    for condition, label in rest:
        out = out.when(condition, label)
    return out.otherwise(otherwise)


def lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped value, null for a key that is not in the mapping."""
    if not mapping:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])[c]


def map_values(c: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped value; values outside the mapping pass through."""
    return F.coalesce(lookup(c, mapping), c)


def canonical_branch(c: Column, cfg: RetailConfig) -> Column:
    """Retired branch names -> the name in use."""
    return map_values(c, cfg.branch_alias)


def branch_type(c: Column, cfg: RetailConfig) -> Column:
    return tier(
        [
            (c.isin(*cfg.head_offices), "Head Office"),
            (c.isin(*cfg.active_branches), "Active Branch"),
        ],
        "Inactive",
    )


def ledger_amount(cfg: RetailConfig, voucher: Column, debit: Column, credit: Column) -> Column:
    """The positive amount of a voucher, from the side its type is booked on."""
    return tier(
        [
            (voucher.isin(*cfg.debit_vouchers), debit),
            (voucher.isin(*cfg.credit_vouchers), credit),
        ],
        F.lit(0.0),
    )


def expense_category(cfg: RetailConfig, voucher: Column, particulars: Column) -> Column:
    """Category by particulars for every voucher; unmapped payments are "other"."""
    return F.coalesce(
        lookup(particulars, cfg.expense_map),
        F.when(voucher == "Payment", cfg.default_expense).otherwise(""),
    )


def movement_status(inwards: Column, outwards: Column, closing: Column) -> Column:
    has_stock = closing > 0
    return tier(
        [
            ((inwards > 0) & (outwards == 0) & has_stock, "Stagnant"),
            ((outwards > 0) & (closing == 0), "Fully sold"),
            ((outwards > 0) & has_stock, "Partially sold"),
            ((inwards > 0) & has_stock, "Stagnant"),
        ],
        "Other",
    )


def sell_through_tier(
    cfg: RetailConfig, pct: Column, inwards: Column, outwards: Column, closing: Column
) -> Column:
    return tier(
        [
            (pct >= cfg.fast_sell_through, "Fast mover"),
            (pct >= cfg.medium_sell_through, "Medium mover"),
            (pct > 0, "Slow mover"),
            ((inwards > 0) & (outwards == 0) & (closing > 0), "No movement"),
        ],
        "Other",
    )


def units_per_day_tier(cfg: RetailConfig, units_per_day: Column) -> Column:
    return tier(
        [
            (units_per_day >= cfg.fast_units_per_day, "Fast mover"),
            (units_per_day >= cfg.medium_units_per_day, "Medium mover"),
            (units_per_day > 0, "Slow mover"),
        ],
        "No sales",
    )


def stock_value_bucket(cfg: RetailConfig, value: Column) -> Column:
    return tier(
        [(value >= cfg.high_value, "High value"), (value >= cfg.medium_value, "Medium value")],
        "Low value",
    )


def strategic_quadrant(cfg: RetailConfig, margin: Column, sell_through: Column) -> Column:
    good_margin = margin >= cfg.star_margin_pct
    poor_margin = margin < cfg.star_margin_pct
    sells = sell_through >= cfg.star_sell_through_pct
    sits = sell_through < cfg.star_sell_through_pct
    return tier(
        [
            (good_margin & sells, "Star — buy more"),
            (good_margin & sits, "Margin trap — slow seller"),
            (poor_margin & sells, "Volume driver — low margin"),
            (poor_margin & sits, "Dog — review or drop"),
        ],
        "Insufficient data",
    )


def discount_risk(cfg: RetailConfig, discount_pct: Column) -> Column:
    return tier(
        [
            (discount_pct > cfg.high_discount_pct, "High discount risk"),
            (discount_pct > cfg.moderate_discount_pct, "Moderate discount"),
        ],
        "Healthy pricing",
    )
