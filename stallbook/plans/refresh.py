"""Models kept up to date from the months that changed.

Bill lines, returns and vouchers lie in month tables (``sources.snapshots``), as
the feeds write them. Beside them this keeps what each month adds to the velocity,
the net sales and the daily P&L. A refresh reads the lines of those months only
that were committed since the last one; the models are then made from the months'
results, which are about as many rows as there are items. Sums over lines are
exact decimals, so the parts add up to the same numbers as a full build.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.config import RetailConfig
from stallbook.operators import sketches
from stallbook.plans import intermediate
from stallbook.sources import snapshots


SALES_TABLES = ("velocity", "bills", "sold", "sketches")


def _dated(df: DataFrame) -> DataFrame:
    """With ``month``, the first day of the month that a row sums up."""
    first = F.make_date(F.col("txn_year").cast("int"), F.col("txn_month").cast("int"), F.lit(1))
    return df.withColumn("month", first)


@dataclasses.dataclass(frozen=True)
class Store:
    """Results by month below ``root``, made from month tables of staged rows."""

    spark: SparkSession
    root: str

    def refresh_sales(self, sales: str, tables: Sequence[str] = SALES_TABLES) -> list[str]:
        """Take over the changed months of the table of deduplicated bill lines, all
        of what is kept or some ``tables`` of it; returns the months. Each table
        is a commit of its own and knows what it covers, so after a crash the
        next refresh does what is left."""
        made = {
            "velocity": intermediate.velocity_months,
            "bills": intermediate.bill_months,
            "sold": lambda lines: _dated(intermediate.sold_months(lines)),
            "sketches": sketches.bills_by_month,
        }
        changed = [
            snapshots.refresh(self.spark, sales, f"{self.root}/{name}", made[name], "month")
            for name in tables
        ]
        return sorted(set().union(*changed))

    def refresh_returns(self, returns: str) -> list[str]:
        return snapshots.refresh(
            self.spark,
            returns,
            f"{self.root}/returned",
            lambda lines: _dated(intermediate.returned_months(lines)),
            "month",
        )

    def refresh_ledger(self, ledger: str, cfg: RetailConfig) -> list[str]:
        return snapshots.refresh(
            self.spark,
            ledger,
            f"{self.root}/daily_pnl",
            lambda lines: intermediate.daily_pnl(lines, cfg),
            "voucher_date",
        )

    def _read(self, name: str) -> DataFrame:
        return snapshots.read(self.spark, f"{self.root}/{name}")

    def velocity(self, cfg: RetailConfig, as_of: dt.date | str | None = None) -> DataFrame:
        return intermediate.velocity_from_months(
            self._read("velocity"), self._read("bills"), cfg, as_of
        )

    def net_sales(self, cfg: RetailConfig) -> DataFrame:
        sold, returned = (self._read(n).drop("month") for n in ("sold", "returned"))
        return intermediate.net_of_months(sold, returned, cfg)

    def daily_pnl(self) -> DataFrame:
        return self._read("daily_pnl")

    def bills(self, keys: list[str], first: str, last: str) -> DataFrame:
        """About how many bills each of ``keys`` (of item and ``month``) has in the
        months from ``first`` to ``last``, from sketches alone; see
        :mod:`stallbook.operators.sketches` for the error."""
        months = self._read("sketches").where(F.col("month").between(first, last))
        return sketches.merged_count(months, keys, "bills", "num_bills")
