"""Month tables: refreshes read what changed, equal full builds, survive crashes."""

import datetime as dt

import pytest
from conftest import day
from pyspark.sql import functions as F

from stallbook import RetailConfig
from stallbook.operators import sketches
from stallbook.plans import intermediate
from stallbook.plans.refresh import Store
from stallbook.sources import snapshots

CFG = RetailConfig(head_offices=("HO",), active_branches=("A", "B"))
SALES = (
    "company_name string,stock_no string,item_description string,product string,brand string,"
    "voucher_no string,sale_date date,sale_year long,sale_month long,sale_month_name string,"
    "sale_quarter long,sales_qty long,line_revenue double,full_mrp_value double,"
    "discount_given double,is_b2b boolean"
)


def lines(frame, month, n=40, qty=1):
    def one(i):
        date = day(f"2026-{month:02d}-{1 + i * 7 % 28:02d}")
        return dict(
            company_name="AB"[i % 2], stock_no=f"s{i % 5}", item_description="x", product="p",
            brand=None if i % 3 else "b", voucher_no=f"v{i % 11}", sale_date=date, sale_year=2026,
            sale_month=month, sale_month_name="m", sale_quarter=1, sales_qty=qty + i,
            line_revenue=0.1 * i, full_mrp_value=0.3 * i, discount_given=0.01 * i, is_b2b=i % 4 == 0,
        )

    return frame(SALES, *[one(i) for i in range(n)])


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    key = lambda r: [str(x) for x in r]
    return sorted(map(tuple, a.select(columns).collect()), key=key) == sorted(
        map(tuple, b.select(columns).collect()), key=key
    )


def test_a_refresh_reads_only_the_changed_months(spark, frame, tmp_path, monkeypatch):
    root, store = str(tmp_path / "sales"), Store(spark, str(tmp_path / "store"))
    months = {m: lines(frame, m) for m in (1, 2, 3)}
    state = snapshots.write(months[1].union(months[2]).union(months[3]), root, "sale_date", None)
    assert store.refresh_sales(root) == ["2026-01", "2026-02", "2026-03"]
    assert store.refresh_sales(root) == []

    months[2] = lines(frame, 2, n=9, qty=5)
    snapshots.write(months[2], root, "sale_date", state)
    rows, read = [], snapshots.read

    def counted(spark, at, *args):
        df = read(spark, at, *args)
        if at == root:
            rows.append(df.count())
        return df

    monkeypatch.setattr(snapshots, "read", counted)
    assert store.refresh_sales(root) == ["2026-02"]
    assert set(rows) == {9}
    whole = months[1].union(months[2]).union(months[3])
    as_of = dt.date(2026, 4, 30)
    assert same(store.velocity(CFG, as_of), intermediate.inventory_velocity(whole, CFG, as_of))


def test_a_month_that_vanishes_goes(spark, frame, tmp_path):
    root, store = str(tmp_path / "sales"), Store(spark, str(tmp_path / "store"))
    state = snapshots.write(lines(frame, 1).union(lines(frame, 2)), root, "sale_date", None)
    store.refresh_sales(root)
    snapshots.write(lines(frame, 1, n=0), root, "sale_date", state, replaced=["2026-02"])
    store.refresh_sales(root)
    as_of = dt.date(2026, 4, 30)
    full = intermediate.inventory_velocity(lines(frame, 1), CFG, as_of)
    assert same(store.velocity(CFG, as_of), full)


def test_a_refresh_that_dies_is_run_again(spark, frame, tmp_path, monkeypatch):
    root, store = str(tmp_path / "sales"), Store(spark, str(tmp_path / "store"))
    snapshots.write(lines(frame, 1).union(lines(frame, 2)), root, "sale_date", None)
    with monkeypatch.context() as m:
        m.setattr(sketches, "bills_by_month", lambda df: 1 / 0)  # the last of four tables
        with pytest.raises(ZeroDivisionError):
            store.refresh_sales(root)
    assert store.refresh_sales(root) == ["2026-01", "2026-02"]
    as_of = dt.date(2026, 4, 30)
    full = intermediate.inventory_velocity(lines(frame, 1).union(lines(frame, 2)), CFG, as_of)
    assert same(store.velocity(CFG, as_of), full)
    assert store.bills(["company_name"], "2026-01-01", "2026-02-01").count() == 2


@pytest.mark.parametrize("n", [10, 3_000, 200_000])
def test_sketches_are_within_their_error(spark, n):
    rows = spark.range(n * 2).select(
        (F.col("id") % n).cast("string").alias("v"), (F.col("id") % 7).alias("part"), F.lit(None).cast("string").alias("none")
    )
    parts = sketches.sketched(rows, ["part"], "v", "s")
    about = sketches.merged_count(parts, [], "s", "n").first().n
    assert abs(about - n) <= sketches.relative_error() * n
    empty = sketches.sketched(rows, ["part"], "none", "s")
    assert sketches.merged_count(empty, [], "s", "n").first().n == 0


def test_counts_beside_sums_meet_without_another_shuffle(spark):
    from pyspark.sql import functions as F

    from stallbook.operators.joins import groups_with_counts

    data = [("a", None, 1, "x"), ("a", None, 2, "x"), ("a", "", 3, "y"), (None, "0", 4, None), ("0", "0", 5, "z")]
    df = spark.createDataFrame(data, "k string, l string, n long, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = groups_with_counts(df, ["k", "l"], [F.sum("n").alias("n")], {"vs": "v", "ns": "n"})
        # sums, and both counts from pairs: five shuffles, none for the joins
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 5
        assert out.columns == ["k", "l", "n", "vs", "ns"]
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(
            map(str, [("a", None, 3, 1, 2), ("a", "", 3, 1, 1), (None, "0", 4, 0, 1), ("0", "0", 5, 1, 1)])
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("large", [False, True])
def test_groups_of_stored_rows_move_once(spark, large):
    """Sums and both counts are taken after one shuffle, without a join; a group that
    is too large for a task takes the other way, with the same rows."""
    from stallbook.operators.joins import groups_with_counts, stored_groups_with_counts

    data = [("a", None, 1, "x"), ("a", None, 2, "x"), ("a", "", 3, "y"), (None, "a", 4, None), ("0", "0", 5, "z")]
    data += [(f"k{i // 2}", "l", i % 2, f"v{i}") for i in range(400)]
    data += [("hot", "l", i % 7, f"v{i % 9}") for i in range(300 if large else 0)]
    df = spark.createDataFrame(data, "k string, l string, n long, v string")
    args = (["k", "l"], [F.sum("n").alias("n")], {"vs": "v", "ns": "n"})
    out, want = stored_groups_with_counts(df, *args, large=100), groups_with_counts(df, *args)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == large
    assert large or plan.count("Exchange") == 1
    assert out.columns == want.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_days_of_a_month_need_no_pairs(spark):
    import datetime as dt

    from stallbook.plans import intermediate

    days = [dt.date(2026, 1, 1), dt.date(2026, 1, 31), dt.date(2026, 1, 31), dt.date(2026, 2, 28), None]
    line = ("A", "s", None, "p", "b")
    data = [(*line, f"v{i}", day, i % 2 == 0, 1, 1.0, 1.0, 0.0) for i, day in enumerate(days)]
    schema = (
        "company_name string, stock_no string, item_description string, product string, brand string, "
        "voucher_no string, sale_date date, is_b2b boolean, sales_qty long, line_revenue double, "
        "full_mrp_value double, discount_given double"
    )
    df = spark.createDataFrame(data, schema)
    assert df.columns == list(intermediate.VELOCITY_LINE)
    months = intermediate.velocity_months(df)
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    found = {r.month: r.days_with_sales for r in months.collect()}
    assert found == {dt.date(2026, 1, 1): 2, dt.date(2026, 2, 1): 1, None: 0}
    whole = intermediate.inventory_velocity(df, checked_cfg(), "2026-04-30").collect()
    parts = intermediate.velocity_from_months(
        months, intermediate.bill_months(df), checked_cfg(), "2026-04-30"
    )
    assert [r.asDict() for r in parts.select(*whole[0].asDict()).collect()] == [r.asDict() for r in whole]
    assert (whole[0].num_bills, whole[0].days_with_sales) == (5, 3)


def checked_cfg():
    from stallbook import RetailConfig

    return RetailConfig()
