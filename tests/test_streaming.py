import pytest
from conftest import day
from pyspark.sql import functions as F

from stallbook.operators import windows
from stallbook.sources import snapshots
from stallbook.streaming import feed

FEED = "company_name string, voucher_date date, net_sales double"


def test_second_delivery_replaces_the_first(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    one = dict(company_name="A", voucher_date=day("2026-01-05"), net_sales=10)

    def deliver(*rows):
        df = frame(FEED, *rows)
        df.coalesce(1).write.mode("append").parquet(source)
        return df.schema

    def live():
        return sorted(
            (r.company_name, r.voucher_date.day, r.net_sales)
            for r in feed.read_daily_feed(spark, target).collect()
        )

    schema = deliver(one, one | {"company_name": "B"})
    feed.run_daily_feed(spark, source, target, state, schema)
    assert live() == [("A", 5, 10), ("B", 5, 10)]

    feed.run_daily_feed(spark, source, target, state, schema)  # nothing new
    assert live() == [("A", 5, 10), ("B", 5, 10)]

    deliver(one | {"net_sales": 12})
    deliver(one | {"voucher_date": day("2026-01-06")})
    feed.run_daily_feed(spark, source, target, state, schema)
    assert live() == [("A", 5, 12), ("A", 6, 10), ("B", 5, 10)]


def test_two_versions_in_one_run(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    one = dict(company_name="A", voucher_date=day("2026-01-05"))
    for value in (1, 2, 3):
        df = frame(FEED, one | {"net_sales": value})
        df.coalesce(1).write.mode("append").parquet(source)
    feed.run_daily_feed(spark, source, target, state, df.schema)
    assert [r.net_sales for r in feed.read_daily_feed(spark, target).collect()] == [3]


def test_late_lines_count_in_any_order_of_files(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    lines = spark.range(400).select(
        (F.col("id") % 80).alias("bill"),
        F.expr("date_add(date'2026-01-01', cast(id % 80 as int))").alias("sale_date"),
        F.col("id").cast("double").alias("line_revenue"),
    )
    lines.repartition(8, "line_revenue").write.parquet(source)

    def best(df):
        return windows.dedup_latest(df, ["bill"], [F.col("line_revenue").desc()])

    feed.run_stream_dedup(
        spark, source, target, state, lines.schema, settle=best, max_files_per_batch=2
    )
    out = feed.read_stream_dedup(spark, target).collect()
    assert sorted((r.bill, r.line_revenue) for r in out) == [(i, 320.0 + i) for i in range(80)]
    assert len(list((tmp_path / "state" / "commits").glob("[0-9]*"))) >= 4


def test_a_batch_writes_only_the_months_that_it_touches(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    one = dict(company_name="A", voucher_date=day("2026-01-05"), net_sales=1)
    for date in ("2026-01-05", "2026-02-05", None):
        row = one | {"voucher_date": date and day(date)}
        df = frame(FEED, row)
        df.coalesce(1).write.mode("append").parquet(source)
        before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "data").rglob("*.parquet")}
        feed.run_daily_feed(spark, source, target, state, df.schema)
        after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "data").rglob("*.parquet")}
        assert before.items() <= after.items() and len(after) == len(before) + 1
    assert feed.read_daily_feed(spark, target).count() == 3


class Died(Exception):
    pass


def _days(frame, month, value):
    dates = [day(f"2026-0{month}-{d:02d}") for d in (3, 9, 27)]
    return frame(FEED, *[dict(company_name="A", voucher_date=d, net_sales=value) for d in dates])


@pytest.mark.parametrize("where", ["in the write", "before the commit", "after the commit"])
def test_a_batch_that_dies_loses_no_row(spark, frame, tmp_path, monkeypatch, where):
    """The second batch replaces January, adds to February, and dies on the way."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def deliver(df):
        df.coalesce(1).write.mode("append").parquet(source)
        return df.schema

    def run():
        feed.run_daily_feed(spark, source, target, state, schema)

    def rows():
        found = feed.read_daily_feed(spark, target).collect()
        return sorted((r.voucher_date.month, r.voucher_date.day, r.net_sales) for r in found)

    schema = deliver(_days(frame, 1, 1).union(_days(frame, 2, 1)))
    run()
    first = rows()
    deliver(_days(frame, 1, 2).union(frame(FEED, dict(company_name="A", voucher_date=day("2026-02-28"), net_sales=2))))
    with monkeypatch.context() as m:
        if where == "in the write":
            # half of the months are written, then a task fails for good
            settle = feed._latest
            late = F.month("voucher_date") == 2
            fails = F.when(late, F.raise_error(F.lit("died")).cast("double")).otherwise(F.col("net_sales"))
            m.setattr(feed, "_latest", lambda df: settle(df).withColumn("net_sales", fails))
        elif where == "before the commit":
            def dead(*_):
                raise Died

            m.setattr(snapshots.files, "write_small", dead)
        else:
            def dead(*_):
                raise Died

            m.setattr(snapshots, "clean", dead)
        with pytest.raises(Exception, match="(?i)died"):
            run()
    if where != "after the commit":
        assert rows() == first
    run()
    january = [(1, d, 2.0) for d in (3, 9, 27)]
    assert rows() == january + [(2, d, 1.0) for d in (3, 9, 27)] + [(2, 28, 2.0)]


def test_readers_keep_the_state_that_they_began_on(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    state, held = None, []
    for value in range(4):
        state = snapshots.write(_days(frame, 1, value), root, "voucher_date", state)
        held.append(snapshots.read(spark, root))
        snapshots.clean(spark, root)
        for df, expected in zip(held[-2:], range(max(0, value - 1), value + 1)):
            assert {r.net_sales for r in df.collect()} == {float(expected)}
    assert len(list((tmp_path / "t" / "commits").glob("[0-9]*"))) == 2
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert snapshots.read(spark, root, months=["2025-01"]).count() == 0
    with pytest.raises(ValueError, match="nothing was committed"):
        snapshots.read(spark, str(tmp_path / "none"))


def test_stored_rows_stay_in_place_and_new_ones_replace_them(spark, tmp_path):
    """Bills come again in later batches with more revenue; the tables of all states
    have neither marks nor repeated bills, and a month that gets no rows keeps its folder."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def lines(ids, revenue):
        return spark.range(*ids).select(
            F.col("id").alias("bill"),
            F.expr("date_add(date'2026-01-01', cast(id as int))").alias("sale_date"),
            (F.col("id") + revenue).cast("double").alias("line_revenue"),
        )

    def best(df):
        return windows.dedup_stored(df, ["bill"], [F.col("line_revenue").desc()])

    folders = []
    for ids, revenue in (((0, 80), 100), ((20, 50), 200), ((40, 60), 50)):
        df = lines(ids, revenue)
        df.coalesce(1).write.mode("append").parquet(source)
        feed.run_stream_dedup(spark, source, target, state, df.schema, settle=best)
        folders.append(snapshots.current(spark, target).months)
    out = feed.read_stream_dedup(spark, target)
    assert out.columns == df.columns
    want = [(i, i + (200.0 if 20 <= i < 50 else 100.0)) for i in range(80)]
    assert sorted((r.bill, r.line_revenue) for r in out.collect()) == want
    assert folders[0]["2026-03"] == folders[1]["2026-03"] and folders[0]["2026-01"] != folders[1]["2026-01"]


def test_marked_rows_are_all_written_without_their_mark(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    state = snapshots.write(_days(frame, 1, 1).union(_days(frame, 2, 1)), root, "voucher_date", None)
    stored = snapshots.read(spark, root, state).withColumn("_fresh", F.lit(False))
    both = stored.unionByName(_days(frame, 2, 3).withColumn("_fresh", F.lit(True)))
    made = snapshots.write(both, root, "voucher_date", state)
    assert "_fresh" not in made.schema.fieldNames() and set(made.months) == {"2026-01", "2026-02"}
    rows = snapshots.read(spark, root, made).collect()
    assert sorted((r.voucher_date.month, r.net_sales) for r in rows) == [(1, 1.0)] * 3 + [(2, 1.0)] * 3 + [(2, 3.0)] * 3
