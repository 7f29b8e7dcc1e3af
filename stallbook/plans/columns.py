"""Column order of the stored intermediate and mart models (fixed values)."""

from __future__ import annotations

from pyspark.sql import DataFrame

DAY = "company_name branch_type is_active voucher_date year month month_name week quarter day_of_week"
MODEL_COLUMNS = {
    name: text.split()
    for name, text in {
        "stg_healthy_items": """
            company_name stock_no item_description product brand style shade size retail_price
            total_purchase_qty total_purchase_value avg_item_rate first_purchase_date
            last_purchase_date""",
        "int_inventory_velocity": """
            company_name stock_no item_description product brand total_units_sold total_revenue
            total_mrp_value total_discount first_sale_date last_sale_date days_with_sales
            num_bills b2b_units b2b_revenue retail_units retail_revenue avg_selling_price
            avg_discount_pct days_since_first_sale selling_period_days units_per_day
            revenue_per_day velocity_tier days_of_stock_remaining""",
        "int_net_sales": """
            company_name stock_no item_description product brand txn_year txn_month
            txn_month_name txn_quarter gross_units_sold gross_revenue total_discount
            total_mrp_value num_bills b2b_units b2b_revenue returned_units returned_value
            net_units_sold net_revenue return_rate_pct return_value_rate_pct
            is_high_return_item""",
        "int_product_performance": """
            product brand company_name units_sold total_revenue total_mrp_value
            total_discount_given avg_retail_price avg_actual_selling_price avg_discount_pct
            num_transactions active_selling_days first_sale last_sale units_purchased
            avg_cost_price total_purchase_cost avg_unit_margin margin_pct estimated_profit
            sell_through_pct revenue_rank_in_branch revenue_rank_overall""",
        "int_daily_pnl": f"""
            {DAY} gross_sales sales_returns net_sales b2b_sales total_expenses salary_expense
            shop_expense freight_expense general_expense home_expense other_expense net_pnl
            pnl_margin_pct purchases purchase_returns net_purchases transfer_in transfer_out
            receipts transaction_count""",
        "int_transfer_opportunities": """
            from_branch to_branch stock_no item_description product brand qty_available
            capital_locked velocity_at_destination total_sold_at_destination
            est_days_to_sell_if_transferred""",
        "mart_financials": f"""
            {DAY} gross_sales sales_returns net_sales b2b_sales total_expenses salary_expense
            shop_expense freight_expense general_expense home_expense other_expense net_pnl
            pnl_margin_pct purchases purchase_returns net_purchases transfer_in transfer_out
            receipts transaction_count mtd_net_sales mtd_expenses mtd_net_pnl wtd_net_sales
            net_sales_last_week net_sales_last_month ytd_net_sales net_sales_7day_avg
            report_date""",
        "mart_branch_performance": """
            company_name branch_type is_active total_gross_sales total_sales_returns
            total_net_sales total_expenses total_salary total_shop_expense total_freight
            total_net_pnl avg_pnl_margin_pct active_days first_sale_date last_sale_date
            total_transactions revenue_rank expense_ratio_pct avg_daily_sales""",
        "mart_action_board": """
            company_name stock_no item_description product brand supplier_name cost_price
            retail_price margin_pct stock_on_hand capital_locked stock_retail_value
            stock_value_bucket total_units_sold total_revenue units_per_day velocity_tier
            avg_discount_pct first_sale_date last_sale_date days_with_sales
            bills_containing_item days_of_stock_remaining branches_selling fast_at_branch
            total_units_all_branches total_revenue_all_branches movement_status
            sell_through_pct inwards_qty outwards_qty action_tag""",
        "mart_product_brand_performance": """
            product brand total_units_sold total_revenue total_discount_given
            total_estimated_profit total_units_purchased avg_margin_pct avg_discount_pct
            avg_sell_through_pct avg_cost_price avg_retail_price num_branches_selling
            first_sale_date last_sale_date revenue_rank profit_rank volume_rank
            strategic_quadrant discount_risk""",
        "mart_supplier_analysis": """
            supplier_name brand product total_purchase_orders total_units_purchased
            total_purchase_value avg_order_value avg_item_cost avg_retail_price
            avg_gross_margin_pct first_purchase_date last_purchase_date relationship_months
            unique_items_supplied supplier_rank rank_within_category report_date""",
        "mart_procurement_analysis": """
            year_month purchase_year purchase_month product brand total_units total_spend
            gross_margin_pct unique_items unique_suppliers total_brand_spend
            brand_gross_margin_pct brand_rank unique_styles total_category_spend
            category_gross_margin_pct category_rank unique_brands report_date""",
    }.items()
}


def arranged(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Models with their columns in stored order (joins put keys first)."""
    return {
        name: df.select(*MODEL_COLUMNS[name]) if name in MODEL_COLUMNS else df
        for name, df in models.items()
    }
