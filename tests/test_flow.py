"""The whole flow on the given tables: SQL parity, invariants, plans."""

import re
import sys
import threading
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
import verify
from stallbook.checks import binding
from stallbook.checks import models as checked_models
from stallbook.checks.registry import ORACLES, QUERIES
from stallbook.operators import shared, windows
from stallbook.operators.shared import clear_shared, share
from stallbook.plans import build
from stallbook.plans.columns import MODEL_COLUMNS

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")

PARITY = (
    "sales_dedup net_sales_monthly product_brand_scorecard financials branch_performance "
    "action_board healthy_items supplier_analysis procurement_trends clean_sales clean_ledger "
    "report_stock_scan daily_feed_stream stream_dedup distributed_rank findings product_performance"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", PARITY)
def test_parity(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = verify.table_of(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == verify.table_of(names, cur.fetchall())


@pytest.mark.parametrize(
    "name, column",
    [
        ("action_board", "action_tag"),
        ("net_sales_monthly", "net_units_sold"),
        ("product_performance", "revenue_rank_overall"),
        ("procurement_trends", "brand_rank"),
        ("transfer_opportunities", "est_days_to_sell_if_transferred"),
    ],
)
def test_a_seeded_fault_is_seen(spark, duck, name, column):
    """One value of one row is changed: the comparison must not hold."""
    df = entry.queries()[name](spark, SF_DIR)
    got = [r.asDict() for r in df.collect()]
    kind = type(next(r[column] for r in got if r[column] is not None))
    got[len(got) // 2][column] = "Review!" if kind is str else kind(987654)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    wrong = verify.table_of(df.columns, [tuple(r[c] for c in df.columns) for r in got])
    assert wrong != verify.table_of(names, cur.fetchall())


@pytest.fixture(scope="module")
def models(spark):
    return build.build_all(binding.raw_tables(spark, SF_DIR), binding.CFG, binding.AS_OF)


def test_all_models_are_built(models):
    assert len(models) == 20
    lists = list(MODEL_COLUMNS.values())
    assert len(lists) == 12 and all(len(set(c)) == len(c) for c in lists)


def test_stored_columns_are_all_the_columns_of_a_model(spark):
    queries = entry.queries()
    for name, model in {
        "velocity": "int_inventory_velocity",
        "net_sales_monthly": "int_net_sales",
        "transfer_opportunities": "int_transfer_opportunities",
        "financials": "mart_financials",
        "branch_performance": "mart_branch_performance",
    }.items():
        assert set(queries[name](spark, SF_DIR).columns) == set(MODEL_COLUMNS[model]), model


def test_invariants(models):
    fin = models["mart_financials"]
    parts = "salary shop freight general home other".split()
    total = sum((F.col(f"{p}_expense") for p in parts), F.lit(0))
    assert fin.filter(total != F.col("total_expenses")).count() == 0

    months = fin.groupBy("company_name", "year", "month").agg(
        F.sum("net_sales").alias("s"), F.max_by("mtd_net_sales", "voucher_date").alias("mtd")
    )
    assert months.filter(F.col("s") != F.col("mtd")).count() == 0

    keys = ["company_name", "stock_no"]
    healthy = models["stg_healthy_items"].select(*keys)
    for other in ("stg_dead_stock", "stg_stockouts"):
        assert healthy.join(models[other], keys, "left_semi").count() == 0

    board = models["mart_action_board"]
    assert board.count() == models["stg_stock_balance"].count()
    assert board.filter(F.col("action_tag").isNull()).count() == 0


def test_marts_are_written_with_their_counts(spark, tmp_path):
    tables = binding.raw_tables(spark, SF_DIR)
    counts = build.build_marts(tables, str(tmp_path / "marts"), binding.CFG, binding.AS_OF)
    assert list(counts) == list(build.MARTS)
    assert counts["mart_branch_performance"] == {"rows_written": 5, "rows_loaded": 5}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cross_join_in_any_model(models):
    for name, df in models.items():
        text = plan(df)
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct", text), name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_no_task_ranks_a_whole_model(models):
    """The only exchange to one partition comes after a sum per range."""
    for name, df in models.items():
        lines = plan(df).splitlines()
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                assert any("sum(_rows" in below for below in lines[i + 1 : i + 4]), name




def test_plans_without_a_rank_are_made_without_a_job(spark):
    from stallbook.plans import intermediate, marts

    tables = binding.raw_tables(spark, SF_DIR)
    spark.sparkContext.setJobGroup("plans-only", "plans of models without a rank")
    try:
        staged = build.build_staging(tables, binding.CFG)
        sales, purchases = staged["stg_sales"], staged["stg_purchases"]
        velocity = intermediate.inventory_velocity(sales, binding.CFG, binding.AS_OF)
        intermediate.net_sales(sales, staged["stg_sales_returns"], binding.CFG)
        intermediate.product_summary(sales, purchases)
        daily = intermediate.daily_pnl(staged["stg_ledger"], binding.CFG)
        intermediate.transfer_opportunities(staged["stg_stock_movement"], velocity)
        marts.financials(daily, binding.CFG, binding.AS_OF)
        marts.purchase_months(purchases)
        marts.action_board(
            staged["stg_stock_balance"], velocity, staged["stg_stock_movement"], binding.CFG
        )
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plans-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_the_summary_copies_no_line_for_its_distinct_counts(spark):
    from stallbook.plans import intermediate

    tables = binding.raw_tables(spark, SF_DIR)
    staged = build.build_staging(tables, binding.CFG)
    out = intermediate.product_summary(staged["stg_sales"], staged["stg_purchases"])
    assert "Expand" not in plan(out)


@pytest.mark.parametrize("name", ["velocity", "supplier_analysis", "net_sales_monthly"])
def test_no_plan_copies_lines_for_distinct_counts(spark, monkeypatch, name):
    """Neither the result nor anything that is stored on the way."""
    plans, original = [], shared.share

    def noted(df):
        plans.append(plan(df))
        return original(df)

    for module in (checked_models, binding, windows):
        monkeypatch.setattr(module, "share", noted)
    plans.append(plan(QUERIES[name](spark, SF_DIR)))
    assert not [p for p in plans if "Expand" in p]


@pytest.mark.parametrize("name", ["action_board", "transfer_opportunities"])
def test_order_lines_are_read_twice_at_most(spark, name):
    """Once for sales and once for purchases, over all stored results."""
    shared.seen = []
    original = shared.share

    def counted(df):
        shared.seen.append(plan(df))
        return original(df)

    for module in (checked_models, binding):
        module.share = counted
    try:
        shared.seen.append(plan(QUERIES[name](spark, SF_DIR)))
    finally:
        for module in (checked_models, binding):
            module.share = original
    assert sum(len(re.findall(r"FileScan.*lineitem", p)) for p in shared.seen) <= 2


def test_scans_read_only_what_a_model_needs(spark, tmp_path):
    from stallbook.plans import staging

    path = str(tmp_path / "purchase")
    binding.raw_purchase(spark, SF_DIR).write.parquet(path)
    raw = spark.read.parquet(path)
    df = staging.stg_purchases(raw, binding.CFG).groupBy("brand").agg(F.sum("purchase_qty"))
    scan = next(line for line in plan(df).splitlines() if "FileScan" in line)
    assert "[stock_no" in scan and "supplier_name" not in scan
    assert "PushedFilters: [IsNotNull(stock_no)]" in scan


def test_shared_results_can_be_cleared(spark):
    df = share(spark.range(3))
    assert df.count() == 3
    clear_shared(spark)
    with pytest.raises(Exception):
        spark.read.schema("id bigint").parquet(df.inputFiles()[0]).count()


def test_raw_sales_are_written_once(spark, monkeypatch):
    """The catalog's sales and purchases are the files that the other tables come from."""
    shared = []
    monkeypatch.setattr(binding, "share", lambda df: shared.append(df.columns) or share(df))
    kept = {}

    def store(name, df):
        kept[name] = share(df)
        return kept[name]

    tables = binding.raw_tables(spark, SF_DIR, store)
    assert set(kept) == {"sales", "purchase"} and all(tables[n] is kept[n] for n in kept)
    assert len(shared) == 2  # open lines and movement totals
    want = binding.raw_sales_returns(spark, SF_DIR)
    got = tables["sales_returns"]
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_the_summary_moves_no_sums_for_every_bill(spark):
    """Aggregates that are keyed by bill hold nothing but the bill."""
    from stallbook.plans import intermediate

    tables = binding.raw_tables(spark, SF_DIR)
    staged = build.build_staging(tables, binding.CFG)
    out = intermediate.product_summary(staged["stg_sales"], staged["stg_purchases"])
    by_bill = [
        line for line in plan(out).splitlines() if re.search(r"Aggregate\(keys=\[[^]]*voucher_no", line)
    ]
    assert by_bill and all("functions=[]" in line for line in by_bill)


def test_stored_sales_keep_no_calendar(spark):
    """The calendar is not written with the lines, and is there when they are read."""
    stored, raw = binding.stored_sales(spark, SF_DIR), binding.raw_sales(spark, SF_DIR)
    assert stored.columns == raw.columns
    assert stored.exceptAll(raw).isEmpty() and raw.exceptAll(stored).isEmpty()
    kept = spark.read.parquet(*stored.inputFiles()).columns
    assert "sale_date" in kept and not {"sale_year", "sale_month_name", "sale_dow"} & set(kept)


def test_a_build_does_not_store_its_lines_again(spark, monkeypatch):
    """Sales and purchases are stored tables: of their lines, only those are kept whose
    key comes twice."""
    from stallbook.plans import intermediate, marts, staging

    tables = binding.raw_tables(spark, SF_DIR)
    kept = []
    for module in (build, marts, staging, windows):
        if hasattr(module, "share"):
            monkeypatch.setattr(module, "share", lambda df: kept.append(share(df)) or kept[-1])
    models = build.build_all(tables, binding.CFG, binding.AS_OF)
    lines = [df.count() for df in kept if "voucher_no" in df.columns and df.columns[0] == "company_name"]
    assert all(n < 1000 for n in lines)
    assert not [df for df in kept if {"stock_no", "supplier_name", "margin"} <= set(df.columns)]
    want = staging.stg_sales(tables["sales"], binding.CFG)
    got = models["stg_sales"]
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    want = intermediate.inventory_velocity(want, binding.CFG, binding.AS_OF)
    got = models["int_inventory_velocity"].select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_steps_run_beside_each_other(spark):
    """Each step waits for the other one; properties of the caller hold in both."""
    met = threading.Barrier(2, timeout=60)

    def step(n):
        met.wait()
        return spark.range(n).count(), spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    spark.sparkContext.setJobGroup("beside", "steps")
    try:
        got = shared.at_once(spark, lambda: step(3), lambda: step(4))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == [(3, "beside"), (4, "beside")] and shared.at_once(spark) == []
    done = []
    with pytest.raises(ZeroDivisionError):
        shared.at_once(spark, lambda: 1 // 0, lambda: done.append(spark.range(5).count()))
    assert done == [5]
