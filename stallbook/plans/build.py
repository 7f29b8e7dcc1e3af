"""The whole flow from raw tables to marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame

from stallbook.config import RetailConfig
from stallbook.operators.joins import stored_groups_with_counts
from stallbook.operators.rows import as_double
from stallbook.operators.shared import at_once, share, shared_results
from stallbook.plans import intermediate, marts, staging
from stallbook.plans.columns import arranged
from stallbook.sources.writers import load_report

MARTS = (
    "mart_financials",
    "mart_branch_performance",
    "mart_action_board",
    "mart_product_brand_performance",
    "mart_supplier_analysis",
    "mart_procurement_analysis",
)


def build_staging(tables: Mapping[str, DataFrame], cfg: RetailConfig) -> dict[str, DataFrame]:
    """Staging models of those raw tables that are given; all lazy."""
    models: dict[str, tuple[str, Callable[[DataFrame, RetailConfig], DataFrame]]] = {
        "stg_sales": ("sales", staging.stg_sales),
        "stg_sales_returns": ("sales_returns", staging.stg_sales_returns),
        "stg_ledger": ("ledger", staging.stg_ledger),
        "stg_purchases": ("purchase", staging.stg_purchases),
        "stg_dead_stock": ("dead_stock", staging.stg_dead_stock),
        "stg_stockouts": ("stockout", staging.stg_stockouts),
        "stg_stock_balance": ("stock_balance", staging.stg_stock_balance),
        "stg_stock_movement": ("stock_movement", staging.stg_stock_movement),
    }
    return {
        name: model(tables[raw], cfg) for name, (raw, model) in models.items() if raw in tables
    }


def build_all(
    tables: Mapping[str, DataFrame],
    cfg: RetailConfig | None = None,
    as_of: dt.date | str | None = None,
) -> dict[str, DataFrame]:
    """All 20 models by name. Results that several models read are computed once
    and kept in the checkpoint folder: bill lines whose key comes twice, the item velocity,
    the product summary and the daily financials. Ranked models store the values
    that they rank. All other models are lazy. Sales and purchases are read several
    times and should be stored tables: they are not stored again. Models of sales, of
    the ledger and of purchases are built at once."""
    cfg = cfg or RetailConfig()
    spark = tables["sales"].sparkSession
    staged = build_staging(tables, cfg)
    purchases = staged["stg_purchases"]

    def of_items(sales: DataFrame) -> dict[str, DataFrame]:
        velocity = share(
            intermediate.inventory_velocity(sales, cfg, as_of, stored_groups_with_counts)
        )
        balance, movement = staged["stg_stock_balance"], staged["stg_stock_movement"]
        return {
            "int_inventory_velocity": velocity,
            "int_transfer_opportunities": intermediate.transfer_opportunities(movement, velocity),
            "mart_action_board": marts.action_board(balance, velocity, movement, cfg),
        }

    def of_products(sales: DataFrame) -> dict[str, DataFrame]:
        summary = share(intermediate.product_summary(sales, purchases))
        return {
            "int_product_performance": intermediate.product_performance(sales, purchases, summary),
            "mart_product_brand_performance": marts.product_brand_performance(summary, cfg),
        }

    def of_sales() -> dict[str, DataFrame]:
        sales = staging.stg_sales(tables["sales"], cfg, staging.settled_stored_sale)
        items, products = at_once(spark, lambda: of_items(sales), lambda: of_products(sales))
        net = intermediate.net_sales(sales, staged["stg_sales_returns"], cfg)
        return {"stg_sales": sales, "int_net_sales": net} | items | products

    def of_ledger() -> dict[str, DataFrame]:
        daily = intermediate.daily_pnl(staged["stg_ledger"], cfg)
        fin = share(marts.financials(daily, cfg, as_of))
        return {
            "int_daily_pnl": daily,
            "mart_financials": fin,
            "mart_branch_performance": marts.branch_performance(fin, cfg),
        }

    def of_suppliers() -> dict[str, DataFrame]:
        found = marts.supplier_analysis(purchases, cfg, as_of, stored_groups_with_counts)
        return {"mart_supplier_analysis": found}

    def of_months() -> dict[str, DataFrame]:
        months = marts.purchase_months(purchases)
        return {"mart_procurement_analysis": marts.procurement_analysis(months, cfg, as_of)}

    out = dict(staged)
    out["stg_healthy_items"] = staging.healthy_items(
        purchases, staged["stg_dead_stock"], staged["stg_stockouts"], cfg
    )
    for models in at_once(spark, of_sales, of_suppliers, of_months, of_ledger):
        out |= models
    return arranged(out)


def build_marts(
    tables: Mapping[str, DataFrame],
    root: str,
    cfg: RetailConfig | None = None,
    as_of: dt.date | str | None = None,
) -> dict[str, dict[str, int]]:
    """Write the six marts as Parquet folders below ``root``; returns row counts.
    Results kept for the job are removed at its end, also if it fails."""
    spark = next(iter(tables.values())).sparkSession
    with shared_results(spark):
        models = build_all(tables, cfg, as_of)

        def load(name: str) -> dict[str, int]:
            return load_report(as_double(models[name]), f"{root}/{name}")

        return dict(zip(MARTS, at_once(spark, *[partial(load, name) for name in MARTS])))
