from decimal import Decimal

import pytest
from conftest import day
from pyspark.sql import functions as F

from stallbook import RetailConfig
from stallbook.plans import intermediate, marts, staging

CFG = RetailConfig()

SALES = (
    "company_name string, voucher_type string, sale_date date, voucher_no string, "
    "customer_ref string, stock_no string, item_description string, product string, "
    "brand string, style string, shade string, size string, base_uom string, "
    "retail_price double, sales_qty double, line_revenue double, full_mrp_value double, "
    "discount_given double, discount_pct double, is_b2b boolean, sale_year bigint, "
    "sale_month bigint, sale_month_name string, sale_quarter bigint, sale_week bigint, "
    "sale_dow string"
)
LINE = dict(
    company_name="A", sale_date=day("2026-01-05"), voucher_no="v1", stock_no="s1",
    item_description="x", product="P", brand="B", retail_price=100, sales_qty=1,
    line_revenue=90, full_mrp_value=100, discount_given=10, discount_pct=10, is_b2b=False,
    sale_year=2026, sale_month=1,
)
RETURNS = (
    "company_name string, stock_no string, return_qty double, return_value double, "
    "return_year bigint, return_month bigint"
)
PURCHASES = (
    "company_name string, stock_no string, item_description string, product string, "
    "brand string, style string, shade string, size string, voucher_no string, "
    "voucher_type string, voucher_date date, supplier_name string, purchase_qty bigint, "
    "retail_price double, item_rate double, item_net_amount double, tax_amount double, "
    "net_amount double"
)
BUY = dict(
    company_name="A", stock_no="s1", product="P", brand="B", voucher_no="p1",
    voucher_date=day("2026-01-01"), supplier_name="S", purchase_qty=10, retail_price=100,
    item_rate=60, item_net_amount=600,
)


def only(df):
    (row,) = df.collect()
    return row


# --- deduplication ---------------------------------------------------------


def test_dedup_rules(frame):
    raw = frame(
        SALES,
        LINE | {"voucher_no": "v1", "line_revenue": 10},
        LINE | {"voucher_no": "v1", "line_revenue": 12},
        LINE | {"voucher_no": "v1", "company_name": "B", "line_revenue": 1},
        LINE | {"voucher_no": "v2", "line_revenue": None},
        LINE | {"voucher_no": "v2", "line_revenue": 3},
        LINE | {"voucher_no": "v3", "company_name": "A-old", "line_revenue": 7},
        LINE | {"voucher_no": "v3", "line_revenue": 8},
    )
    out = staging.stg_sales(raw, CFG)
    kept = sorted((r.company_name, r.voucher_no, r.line_revenue) for r in out.collect())
    assert kept == [("A", "v1", 12), ("A", "v2", 3), ("A", "v3", 8), ("B", "v1", 1)]
    assert staging.stg_sales(out, CFG).count() == 4  # idempotent
    assert out.columns == staging.SALES_COLUMNS


def test_hot_bill_line_and_hot_item(frame):
    """A third of all rows are copies of one bill line, another third bills of
    one item: compared with plain dictionaries."""
    lines = [LINE | {"stock_no": "hot", "line_revenue": i % 97} for i in range(500)]
    lines += [LINE | {"stock_no": "hot", "voucher_no": f"h{i % 400}", "line_revenue": i,
                      "sale_date": day(f"2026-01-{i % 28 + 1:02d}")} for i in range(500)]
    lines += [LINE | {"stock_no": f"s{i % 60}", "voucher_no": f"v{i}"} for i in range(500)]
    best: dict = {}
    for x in lines:
        key = (x["voucher_no"], x["stock_no"], x["sale_date"])
        best[key] = max(best.get(key, 0), x["line_revenue"])
    expected = {}
    for (bill, sku, date), revenue in best.items():
        total, bills, days = expected.setdefault(sku, [0, set(), set()])
        expected[sku][0] = total + revenue
        bills.add(bill)
        days.add(date)
    sales = staging.stg_sales(frame(SALES, *lines).repartition(5), CFG)
    out = intermediate.inventory_velocity(sales, CFG, "2026-05-01").collect()
    assert {r.stock_no: (r.total_revenue, r.num_bills, r.days_with_sales) for r in out} == {
        sku: (total, len(bills), len(days)) for sku, (total, bills, days) in expected.items()
    }


# --- velocity and net sales ------------------------------------------------


def test_velocity(frame):
    sales = frame(
        SALES,
        LINE | {"stock_no": "once", "sales_qty": 3},
        LINE | {"stock_no": "medium", "sales_qty": 4},
        LINE | {"stock_no": "medium", "sales_qty": 6, "sale_date": day("2026-04-14")},
        LINE | {"stock_no": "slow", "sales_qty": 4, "is_b2b": True},
        LINE | {"stock_no": "slow", "sales_qty": 5, "sale_date": day("2026-04-14"), "voucher_no": "v2"},
        LINE | {"stock_no": "none", "sales_qty": 0, "line_revenue": 0, "is_b2b": None},
    )
    out = {r.stock_no: r for r in intermediate.inventory_velocity(sales, CFG, "2026-05-01").collect()}
    once = out["once"]
    assert (once.selling_period_days, once.units_per_day, once.velocity_tier) == (1, 3, "Fast mover")
    assert (out["medium"].units_per_day, out["medium"].velocity_tier) == (0.1, "Medium mover")
    assert (out["medium"].days_with_sales, out["medium"].num_bills) == (2, 1)
    slow = out["slow"]
    assert (slow.units_per_day, slow.velocity_tier, slow.num_bills) == (0.09, "Slow mover", 2)
    assert (slow.b2b_units, slow.retail_units) == (4, 5)
    assert (slow.b2b_revenue, slow.retail_revenue) == (90, 90)
    assert slow.days_since_first_sale == 116 and slow.days_of_stock_remaining is None
    none = out["none"]
    assert (none.velocity_tier, none.avg_selling_price) == ("No sales", None)
    assert (none.b2b_units, none.retail_units) == (0, 0)


def test_net_sales(frame):
    sales = frame(
        SALES,
        LINE | {"stock_no": "over", "sales_qty": 2, "line_revenue": 20},
        LINE | {"stock_no": "edge", "sales_qty": 10, "line_revenue": 100},
        LINE | {"stock_no": "clean", "sales_qty": 5},
        LINE | {"stock_no": "unknown", "sales_qty": None, "line_revenue": None},
    )
    back = dict(company_name="A", return_year=2026, return_month=1, return_value=30)
    returns = frame(
        RETURNS,
        back | {"stock_no": "over", "return_qty": 3},
        back | {"stock_no": "edge", "return_qty": 1},
        back | {"stock_no": "unknown", "return_qty": 1},
        back | {"stock_no": "edge", "return_qty": 9, "return_month": 2},
        back | {"stock_no": "never sold", "return_qty": 1},
    )
    out = {r.stock_no: r for r in intermediate.net_sales(sales, returns, CFG).collect()}
    assert set(out) == {"over", "edge", "clean", "unknown"}
    over = out["over"]
    assert (over.net_units_sold, over.net_revenue, over.return_rate_pct) == (0, 0, 150)
    assert over.is_high_return_item
    assert (out["edge"].return_rate_pct, out["edge"].is_high_return_item) == (10, False)
    assert (out["clean"].returned_units, out["clean"].net_units_sold) == (0, 5)
    unknown = out["unknown"]
    assert unknown.net_units_sold is None and unknown.net_revenue is None
    assert unknown.is_high_return_item is False


# --- products --------------------------------------------------------------


def test_product_performance(frame):
    sales = frame(
        SALES,
        LINE,
        LINE | {"voucher_no": "v2", "sales_qty": 2, "line_revenue": 100},
        LINE | {"product": "no purchase"},
        LINE | {"brand": None},
    )
    purchases = frame(PURCHASES, BUY, BUY | {"item_rate": 40}, BUY | {"brand": None})
    out = intermediate.product_performance(sales, purchases)
    rows = {(r.product, r.brand): r for r in out.collect()}
    p = rows["P", "B"]
    assert (p.avg_actual_selling_price, p.avg_cost_price, p.avg_unit_margin) == (70, 50, 20)
    assert (p.margin_pct, p.estimated_profit, p.sell_through_pct) == (28.57, 60, 15)
    assert (p.revenue_rank_in_branch, p.revenue_rank_overall) == (1, 1)
    for key in (("no purchase", "B"), ("P", None)):
        assert rows[key].avg_cost_price is None and rows[key].margin_pct is None
        assert rows[key].revenue_rank_overall == 2
    card = {(r.product, r.brand): r for r in marts.product_brand_performance(out, CFG).collect()}
    assert card["P", "B"].strategic_quadrant == "Dog — review or drop"
    assert card["no purchase", "B"].strategic_quadrant == "Insufficient data"
    assert card["no purchase", "B"].total_estimated_profit is None
    assert card["no purchase", "B"].profit_rank == 2


def test_supplier_analysis(frame):
    purchases = frame(
        PURCHASES,
        BUY | {"voucher_date": day("2026-01-31")},
        BUY | {"item_rate": None, "voucher_date": day("2026-02-01"), "voucher_no": "p2"},
        BUY | {"supplier_name": None},
        BUY | {"supplier_name": "T", "item_net_amount": 1200},
        BUY | {"supplier_name": "U", "product": "Q", "item_net_amount": 5},
    )
    out = {r.supplier_name: r for r in marts.supplier_analysis(purchases, CFG, "2026-05-01").collect()}
    assert set(out) == {"S", "T", "U"}
    s = out["S"]
    assert (s.avg_gross_margin_pct, s.relationship_months, s.total_purchase_orders) == (20, 1, 2)
    assert (s.total_purchase_value, s.avg_order_value, s.avg_item_cost) == (1200, 600, 60)
    assert {k: r.supplier_rank for k, r in out.items()} == {"S": 1, "T": 1, "U": 3}
    assert out["U"].rank_within_category == 1 and s.report_date == day("2026-05-01")


def test_procurement_analysis(frame):
    purchases = frame(
        PURCHASES,
        BUY,
        BUY | {"stock_no": "s2", "supplier_name": "T", "style": "x"},
        BUY | {"voucher_date": day("2026-02-01"), "style": "y"},
        BUY | {"brand": None},
        BUY | {"product": "Q", "brand": "C", "item_net_amount": 9000},
    )
    out = {
        (r.year_month, r.product, r.brand): r
        for r in marts.procurement_analysis(marts.purchase_months(purchases), CFG, "2026-05-01").collect()
    }
    jan = out["2026-01", "P", "B"]
    assert (jan.total_units, jan.total_spend, jan.unique_items, jan.unique_suppliers) == (20, 1200, 2, 2)
    assert (jan.total_brand_spend, jan.brand_rank, jan.unique_styles) == (1800, 2, 2)
    assert (jan.total_category_spend, jan.category_rank, jan.unique_brands) == (2400, 2, 1)
    unbranded = out["2026-01", "P", None]
    assert unbranded.total_brand_spend is None and unbranded.category_rank == 2
    assert out["2026-01", "Q", "C"].brand_rank == 1 and len(out) == 4


# --- stock -----------------------------------------------------------------

STOCK = (
    "company_name string, stock_no string, item_description string, product string, "
    "brand string, supplier_name string, cost_price double, retail_price double, "
    "margin_pct double, closing_qty double, capital_locked double, retail_value double, "
    "stock_value_bucket string"
)
VELOCITY = (
    "company_name string, stock_no string, total_units_sold double, total_revenue double, "
    "units_per_day double, velocity_tier string, avg_discount_pct double, "
    "first_sale_date date, last_sale_date date, days_with_sales bigint, num_bills bigint"
)
MOVEMENT = (
    "company_name string, stock_no string, item_description string, product string, "
    "brand string, closing_qty double, capital_locked double, movement_status string, "
    "sell_through_pct double, inwards_qty double, outwards_qty double"
)


def fast(per_day=1, discount=30, **more):
    return dict(
        company_name="A", units_per_day=per_day, avg_discount_pct=discount, total_units_sold=9,
        velocity_tier="Fast mover", **more,
    )


SLOW = dict(
    company_name="A", units_per_day=0.05, avg_discount_pct=0, total_units_sold=1,
    velocity_tier="Slow mover",
)
ELSEWHERE = dict(company_name="B", units_per_day=2, total_units_sold=99, velocity_tier="Fast mover")


def test_action_tags(frame):
    cases = {
        # stock on hand, margin, velocity rows, movement status -> tag
        "k1": (7, 40, [fast()], None, "Reorder"),
        "k2": (8, 40, [fast(discount=15.01)], None, "Watch — high discount"),
        "k3": (8, 20, [fast(discount=15)], None, "Healthy"),
        "k4": (8, 19.99, [fast(discount=15)], None, "Monitor"),
        "k5": (5, 40, [SLOW, ELSEWHERE], None, "Transfer"),
        "k6": (5, 40, [ELSEWHERE], "Stagnant", "Transfer"),
        "k7": (5, 40, [], "Stagnant", "Liquidate"),
        "k8": (5, 40, [], None, "Review"),
        "k9": (5, 40, [SLOW, fast() | {"total_units_sold": None}], None, None),
    }
    balance = frame(
        STOCK,
        *[
            dict(company_name="A", stock_no=k, closing_qty=c[0], margin_pct=c[1])
            for k, c in cases.items()
        ],
    )
    velocity = frame(VELOCITY, *[v | {"stock_no": k} for k, c in cases.items() for v in c[2]])
    movement = frame(
        MOVEMENT,
        *[
            dict(company_name="A", stock_no=k, movement_status=c[3])
            for k, c in cases.items()
            if c[3]
        ],
    )
    out = marts.action_board(balance, velocity, movement, CFG).collect()
    tags = {r.stock_no: r.action_tag for r in out if r.stock_no != "k9"}
    assert tags == {k: c[4] for k, c in cases.items() if k != "k9"}
    by_sku = {r.stock_no: r for r in out}
    assert (by_sku["k5"].fast_at_branch, by_sku["k5"].branches_selling) == ("B", 2)
    assert by_sku["k1"].days_of_stock_remaining == 7 and by_sku["k7"].branches_selling is None
    # fast only at the own branch is no reason to transfer; two velocity rows
    # for one item (two descriptions) give two board rows
    own = [r for r in out if r.stock_no == "k9"]
    assert sorted(r.action_tag for r in own) == ["Monitor", "Reorder"]


def test_transfer_opportunities(frame):
    movement = frame(
        MOVEMENT,
        dict(company_name="A", stock_no="s1", movement_status="Stagnant", closing_qty=5),
        dict(company_name="A", stock_no="s2", movement_status="Stagnant", closing_qty=5),
        dict(company_name="A", stock_no="s3", movement_status="Stagnant", closing_qty=0),
        dict(company_name="A", stock_no="s4", movement_status="Partially sold", closing_qty=5),
    )
    row = dict(velocity_tier="Fast mover", units_per_day=2)
    velocity = frame(
        VELOCITY,
        *[row | {"stock_no": "s1", "company_name": c} for c in "AB"],
        *[row | {"stock_no": "s2", "company_name": c} for c in "BC"],
        *[row | {"stock_no": s, "company_name": "B"} for s in ("s3", "s4")],
    )
    out = intermediate.transfer_opportunities(movement, velocity).collect()
    assert sorted((r.stock_no, r.from_branch, r.to_branch) for r in out) == [
        ("s1", "A", "B"), ("s2", "A", "B"), ("s2", "A", "C"),
    ]
    assert out[0].est_days_to_sell_if_transferred == 3  # 2.5 rounds up


def test_healthy_items(frame):
    purchases = frame(
        PURCHASES,
        BUY | {"stock_no": "dead here"},
        BUY | {"stock_no": "dead there"},
        BUY | {"stock_no": "sold out"},
        BUY | {"company_name": "HO"},
        BUY | {"company_name": None},
        BUY | {"stock_no": "fine", "item_rate": 50},
        BUY | {"stock_no": "fine", "retail_price": 120, "voucher_date": day("2026-03-01")},
    )
    key = "company_name string, stock_no string"
    dead = frame(key, {"company_name": "A", "stock_no": "dead here"},
                 {"company_name": "B", "stock_no": "dead there"})
    out_of_stock = frame(key, {"company_name": "A", "stock_no": "sold out"})
    df = staging.healthy_items(purchases, dead, out_of_stock, CFG)
    rows = {r.stock_no: r for r in df.collect()}
    assert set(rows) == {"dead there", "fine"}
    fine = rows["fine"]
    assert (fine.retail_price, fine.total_purchase_qty, fine.avg_item_rate) == (120, 20, 55)
    assert fine.total_purchase_value == 1200 and fine.last_purchase_date == day("2026-03-01")
    assert "LeftAnti" in df._jdf.queryExecution().optimizedPlan().toString()


def test_balance_and_movement_staging(frame):
    raw = frame(
        "company_name string, stock_no string, item_description string, product string, "
        "brand string, style string, shade string, size string, hsn_code string, "
        "item_type string, supplier_name string, cost_price double, retail_price double, "
        "base_uom string, closing_qty double, closing_rate double, closing_value double, "
        "margin_pct double, retail_value double, capital_locked double",
        dict(company_name="A-old", cost_price=5, retail_price=4, closing_value=10000.128,
             capital_locked=10000.13),
        dict(company_name="A", cost_price=None, retail_price=4),
    )
    negative, unknown = staging.stg_stock_balance(raw, CFG).collect()
    assert negative.company_name == "A" and negative.is_negative_margin
    assert negative.capital_locked == 10000.128  # the closing value, unrounded
    assert (unknown.is_negative_margin, unknown.stock_value_bucket) == (False, "Low value")


# --- profit and loss -------------------------------------------------------

LEDGER = (
    "company_name string, branch_type string, is_active boolean, voucher_date date, "
    "year bigint, month bigint, month_name string, week bigint, quarter bigint, "
    "day_of_week string, voucher_type string, expense_category string, amount double"
)
DAY = dict(company_name="A", branch_type="Active Branch", is_active=True,
           voucher_date=day("2026-01-05"), year=2026, month=1, week=2, quarter=1)


def test_daily_pnl(frame):
    def voucher(kind, amount, category="", **more):
        return DAY | dict(voucher_type=kind, amount=amount, expense_category=category) | more

    ledger = frame(
        LEDGER,
        voucher("Sales", 100),
        voucher("Sales Return", 20),
        voucher("Payment", 30, "Salary"),
        voucher("Payment", 5, "Gift Voucher"),
        voucher("B2B Sale", 50),
        voucher("Receipt", 3, "Salary"),
        voucher("Payment", 7, "Freight", voucher_date=day("2026-01-06")),
    )
    out = {r.voucher_date.day: r for r in intermediate.daily_pnl(ledger, CFG).collect()}
    d = out[5]
    assert (d.net_sales, d.total_expenses, d.salary_expense, d.other_expense) == (80, 35, 30, 5)
    assert (d.net_pnl, d.pnl_margin_pct, d.b2b_sales, d.transaction_count) == (45, 45, 50, 6)
    assert out[6].pnl_margin_pct is None and out[6].freight_expense == 7


DAILY = ", ".join(
    f"{c} {t}"
    for c, t in [
        *[(x.split()[0], x.split()[1]) for x in LEDGER.split(", ")[:10]],
        *[(m, "double") for m in marts.DAY_MEASURES],
    ]
)


def daily_rows(days, **more):
    return [
        DAY | dict(voucher_date=day(d), net_sales=v, total_expenses=1, net_pnl=v - 1,
                   year=int(d[:4]), month=int(d[5:7])) | more
        for d, v in days
    ]


def test_financials(frame):
    days = [(f"2026-01-{25 + i:02d}", i + 1) for i in range(7)] + [("2026-02-02", 8)]
    out = marts.financials(frame(DAILY, *daily_rows(days)), CFG, "2026-05-01")
    rows = sorted(out.collect(), key=lambda r: r.voucher_date)
    assert rows[-1].net_sales_last_week == 1 and rows[-1].net_sales_last_month is None
    assert (rows[-1].net_sales_7day_avg, rows[2].net_sales_7day_avg) == (5, 2)
    assert (rows[6].mtd_net_sales, rows[7].mtd_net_sales, rows[7].ytd_net_sales) == (28, 8, 36)
    assert rows[6].mtd_expenses == 7 and rows[6].mtd_net_pnl == 21
    assert rows[0].report_date == day("2026-05-01")


def test_week_to_date_keys(frame):
    days = daily_rows([("2024-01-01", 5), ("2024-12-30", 7), ("2025-01-01", 9)], week=1)
    df = frame(DAILY, *days)

    def wtd(cfg):
        out = marts.financials(df, cfg, "2026-05-01").collect()
        return [r.wtd_net_sales for r in sorted(out, key=lambda r: r.voucher_date)]

    assert wtd(CFG) == [5, 12, 9]  # calendar year and ISO week, as delivered
    assert wtd(RetailConfig(iso_year=True)) == [5, 7, 16]


def test_old_and_new_name_on_one_day_have_a_fixed_order(frame):
    rows = daily_rows([("2026-01-05", 1)], branch_type="Inactive", is_active=False)
    rows += daily_rows([("2026-01-05", 2), ("2026-01-06", 3)])
    results = set()
    for parts in (1, 4):
        out = marts.financials(frame(DAILY, *rows).repartition(parts), CFG, "2026-05-01").collect()
        results.add(tuple(sorted((r.voucher_date, r.branch_type, r.mtd_net_sales) for r in out)))
    assert results == {(
        (day("2026-01-05"), "Active Branch", 2.0),
        (day("2026-01-05"), "Inactive", 3.0),
        (day("2026-01-06"), "Active Branch", 6.0),
    )}


def test_branch_performance(frame):
    rows = daily_rows([("2026-01-05", 10), ("2026-01-06", 30)], gross_sales=20, pnl_margin_pct=10.01)
    rows += daily_rows([("2026-01-05", 0)], company_name="HO", pnl_margin_pct=None)
    rows += daily_rows([("2026-01-05", 40)], company_name="Z")
    fin = frame(DAILY, *rows)
    out = {r.company_name: r for r in marts.branch_performance(fin, CFG).collect()}
    a, ho, z = out["A"], out["HO"], out["Z"]
    assert (a.total_net_sales, a.active_days, a.avg_daily_sales) == (40, 2, 20)
    assert (a.expense_ratio_pct, a.avg_pnl_margin_pct, a.revenue_rank) == (5, 10.01, 1)
    assert (ho.branch_type, ho.is_active, ho.expense_ratio_pct, ho.revenue_rank) == (
        "Head Office", True, None, 3,
    )
    assert (z.branch_type, z.is_active, z.revenue_rank) == ("Retail Branch", False, 1)


@pytest.mark.parametrize("parts", [1, 5])
def test_sums_are_exact_in_any_partitioning(frame, parts):
    lines = [LINE | {"voucher_no": str(i), "line_revenue": 0.1} for i in range(300)]
    sales = frame(SALES, *lines).repartition(parts)
    row = only(intermediate.inventory_velocity(sales, CFG, "2026-05-01"))
    assert row.total_revenue == Decimal("30.00000")


def test_ledger_staging_drops_null_particulars(frame):
    schema = (
        "company_name string, city string, voucher_date date, voucher_no string, "
        "voucher_type string, particulars string, narration string, user_name string, "
        "inwards_qty double, outwards_qty double, debit_amount double, credit_amount double, "
        "amount double, expense_category string, branch_type string, is_active boolean, "
        "year bigint, month bigint, month_name string, week bigint, quarter bigint, "
        "day_of_week string"
    )
    row = dict(company_name="A", voucher_date=day("2026-01-05"), inwards_qty=2.5)
    raw = frame(
        schema, row | {"particulars": "X"}, row | {"particulars": None},
        row | {"particulars": "x Sub Total"}, row | {"particulars": "X", "voucher_date": None},
    )
    out = only(staging.stg_ledger(raw, CFG))
    assert out.inwards_qty == 3 and out.particulars == "X"


def test_row_filter_of_missing_sku(frame):
    purchases = frame(PURCHASES, BUY, BUY | {"stock_no": None})
    assert staging.stg_purchases(purchases, CFG).filter(F.col("stock_no").isNull()).count() == 0
