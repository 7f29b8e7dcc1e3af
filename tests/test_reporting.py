from conftest import day
from test_models import DAILY, LINE, MOVEMENT, RETURNS, SALES, daily_rows

from stallbook import RetailConfig
from stallbook.plans import reporting

CFG = RetailConfig()
MOVED = MOVEMENT + ", stagnant_capital double"


def test_totals_over_history_and_live(spark, frame):
    history = frame(DAILY, *daily_rows([("2026-01-05", 10), ("2026-01-06", 30)]))
    live = history.limit(0).select("company_name", "voucher_date", "net_sales",
                                   "total_expenses", "net_pnl")
    row = reporting.expense_ratio(reporting.kpi_totals(history, live)).first()
    assert (row.total_net_sales, row.total_expenses, row.total_net_pnl) == (40, 2, 38)
    assert row.expense_ratio_pct == 5 and row.data_as_of == day("2026-01-06")
    empty = reporting.expense_ratio(reporting.kpi_totals(live, live)).first()
    assert (empty.total_net_sales, empty.expense_ratio_pct) == (0, 0)


def test_periods(frame):
    fin = frame(DAILY, *daily_rows([("2026-01-01", 1), ("2026-01-07", 2), ("2026-01-08", 4)]))
    out = {r.period_days: r.net_sales for r in reporting.period_kpis(fin, "2026-01-08").collect()}
    assert out == {1: 2, 7: 3, 30: 3, 60: 3, 90: 3, 365: 3}
    assert reporting.in_period(fin, "2026-01-08", 1).count() == 1


def test_report_order(frame):
    df = frame(
        "txn_year bigint, txn_month bigint, net_revenue double",
        dict(txn_year=2026, txn_month=1, net_revenue=1),
        dict(txn_year=2025, txn_month=2, net_revenue=None),
        dict(txn_year=2025, txn_month=2, net_revenue=5),
        dict(txn_year=2026, txn_month=1, net_revenue=3),
    )
    out = reporting.report("int_net_sales", df).collect()
    assert [(r.txn_year, r.net_revenue) for r in out] == [(2025, 5), (2025, None), (2026, 3), (2026, 1)]
    assert reporting.report("stg_sales", df) is df


def test_dimensions(frame):
    rows = daily_rows([("2026-02-27", 1), ("2026-03-02", 2)])
    rows += daily_rows([("2026-02-28", 1)], company_name="HO")
    fin = frame(DAILY, *rows)
    assert [r.date.day for r in reporting.dim_date(fin).orderBy("date").collect()] == [27, 28, 1, 2]
    assert [r.company_name for r in reporting.dim_branch(fin, CFG).collect()] == ["A"]
    assert reporting.dim_date(fin.limit(0)).count() == 0


def test_expenses(frame):
    rows = daily_rows([("2026-01-05", 10)], salary_expense=6, shop_expense=3, freight_expense=0,
                      general_expense=0, home_expense=0, other_expense=3)
    fin = frame(DAILY, *[r | {"total_expenses": 12} for r in rows])
    shares = {r.expense_category: r.share_pct for r in reporting.expense_breakdown(fin).collect()}
    assert shares["Salary"] == 50 and shares["Other Expense"] == 25 and sum(shares.values()) == 100
    assert reporting.top_expense(fin).first().expense_category == "Salary"
    assert reporting.expense_trend(fin).count() == 6


def test_findings(frame):
    sales = frame(
        SALES,
        LINE | {"product": "p1", "brand": None, "line_revenue": 5},
        LINE | {"product": "p0", "brand": "b", "line_revenue": 5, "company_name": "C"},
        LINE | {"product": "p2", "brand": "b", "line_revenue": 1, "company_name": "B",
                "voucher_no": "v2", "is_b2b": True},
        LINE | {"product": "p3", "brand": "b", "line_revenue": None},
    )
    movement = frame(
        MOVED,
        dict(company_name="A", stock_no="s1", inwards_qty=10, outwards_qty=9),
        dict(company_name="B", stock_no="s1", inwards_qty=10, outwards_qty=0,
             movement_status="Stagnant", stagnant_capital=12.5),
    )
    out = {r.finding: (r.name, r.value) for r in reporting.stock_findings(sales, movement).collect()}
    assert out == {
        "top branch": ("A", 5), "top product": ("p0", 5), "top brand": ("b", 6),
        "best sell-through": ("A", 90), "lowest sell-through": ("B", 0),
    }
    stuck = reporting.zero_movement(movement).first()
    assert (stuck.stagnant_skus, stuck.branches, float(stuck.stagnant_capital)) == (1, 1, 12.5)
    share = reporting.b2b_share(sales).first()
    assert (share.revenue_share_pct, share.transaction_share_pct) == (9.09, 33.33)
    totals = reporting.sales_totals(sales).first()
    assert (float(totals.total_sales), totals.bills, totals.skus_sold) == (11, 3, 1)


def test_returns_and_baskets(frame):
    sales = frame(SALES, LINE, LINE | {"stock_no": "s2"}, LINE | {"voucher_no": "v2", "sales_qty": 4})
    returns = frame(RETURNS, dict(company_name="A", return_qty=3, return_value=27))
    rate = reporting.return_rates(sales, returns).first()
    assert (rate.return_value_pct, rate.return_unit_pct) == (10, 50)
    basket = reporting.basket_size(sales).first()
    assert (basket.bills, basket.lines_per_bill, basket.pieces_per_bill) == (2, 1.5, 3)
    assert reporting.peak_month(sales).first().year_month == "2026-01"
