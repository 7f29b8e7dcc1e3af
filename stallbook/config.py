"""Business configuration: branches, code maps and thresholds.

Operators take a :class:`RetailConfig` and hard-code none of these values, so a
deployment replaces the placeholder branch names without touching a query.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- Fixed values: must equal what the billing export writes ---------------

# Voucher types that carry no money and are left out of the ledger.
EXCLUDED_VOUCHERS = (
    "Delivery Note",
    "Delivery Note Closure",
    "Stock Journal",
    "Physical Stock",
)

# Voucher type in the export -> voucher type in the ledger. Others pass through.
VOUCHER_MAP = {"Retail Credit Note": "Sales Return"}

# Which side of the ledger holds the amount of a voucher type.
DEBIT_VOUCHERS = ("Sales", "B2B Sale", "Payment", "Purchase Return", "Transfer Out")
CREDIT_VOUCHERS = ("Sales Return", "Purchase", "Transfer In", "Receipt")

# Upper-cased particulars -> expense category (spelling as exported).
EXPENSE_MAP = {
    "SALARY EXP": "Salary",
    "SHOP EXP": "Shop Expense",
    "FREIGHT EXP": "Freight",
    "FREIGHT": "Freight",
    "GENERAL EXP": "General Expense",
    "HOME EXP": "Home Expense",
    "CREDIT NOTE": "Credit Note",
    "GIFT VOUCHER": "Gift Voucher",
    "ADDITONAL INCOME -GIFT VOUCHER": "Gift Voucher",
    "< MULTIPLE PARTY >": "Multiple Party",
}

# Expense categories with a column of their own in the daily P&L; all other
# payments are "other".
EXPENSE_COLUMNS = {
    "Salary": "salary_expense",
    "Shop Expense": "shop_expense",
    "Freight": "freight_expense",
    "General Expense": "general_expense",
    "Home Expense": "home_expense",
}

# --- Configuration ---------------------------------------------------------


@dataclass(frozen=True)
class RetailConfig:
    """Branch lists, code maps, thresholds and switches of one deployment."""

    head_offices: tuple[str, ...] = ("HO",)
    active_branches: tuple[str, ...] = ("A", "B", "C", "D")
    branch_alias: Mapping[str, str] = field(
        default_factory=lambda: {"A-old": "A", "B-old": "B", "C-old": "C"}
    )

    excluded_vouchers: tuple[str, ...] = EXCLUDED_VOUCHERS
    voucher_map: Mapping[str, str] = field(default_factory=lambda: dict(VOUCHER_MAP))
    debit_vouchers: tuple[str, ...] = DEBIT_VOUCHERS
    credit_vouchers: tuple[str, ...] = CREDIT_VOUCHERS
    expense_map: Mapping[str, str] = field(default_factory=lambda: dict(EXPENSE_MAP))
    default_expense: str = "Other Expense"
    b2b_voucher: str = "B2B SALE"

    # stock value buckets, from (closing value)
    high_value: int = 100_000
    medium_value: int = 10_000

    # sell-through tiers (percent)
    fast_sell_through: float = 80.0
    medium_sell_through: float = 40.0

    # velocity tiers (units per day)
    fast_units_per_day: float = 1.0
    medium_units_per_day: float = 0.1

    # a month is "high return" above this share of units sold
    high_return_share: float = 0.10

    # action board
    reorder_days: int = 7
    reorder_default_units: int = 5
    watch_discount_pct: float = 15.0
    healthy_margin_pct: float = 20.0

    # product and brand scorecard
    star_margin_pct: float = 30.0
    star_sell_through_pct: float = 50.0
    high_discount_pct: float = 20.0
    moderate_discount_pct: float = 10.0

    # False: weeks are keyed by calendar year + ISO week, and "last week" is
    # seven rows back. True: ISO year, and calendar days.
    iso_year: bool = False
    calendar_true: bool = False

    @property
    def branches(self) -> tuple[str, ...]:
        """Every branch that delivers files: retail branches and head office."""
        return self.active_branches + self.head_offices

    @property
    def non_selling(self) -> tuple[str, ...]:
        """Branches left out of healthy items: head office and retired names."""
        return self.head_offices + tuple(self.branch_alias)
