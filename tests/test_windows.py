import random
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stallbook.operators import windows
from stallbook.operators.shared import share, shared_root


def ranked(spark, n=4000, seed=7):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        hot = rng.random() < 0.34
        value = None if rng.random() < 0.05 else 1.5 if hot else round(rng.gauss(100, 900), 1)
        part = None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else rng.choice("abc")
        data.append((i, part, value))
    return spark.createDataFrame(data, "id bigint, part string, v double")


def plain(df, part, col):
    w = Window.partitionBy(*part).orderBy(F.col(col).desc_nulls_last())
    return sorted(map(tuple, df.withColumn("r", F.rank().over(w)).collect()), key=repr)


def test_ranks_equal_the_window(spark):
    df = ranked(spark)
    for part in ([], ["part"]):
        out = windows.add_ranks(df, {"r": (part, "v")})
        assert sorted(map(tuple, out.collect()), key=repr) == plain(df, part, "v")


def test_ranks_with_one_hot_value_and_with_one_hot_group(spark):
    value = F.when(F.col("id") % 10 > 0, 7.5).otherwise((F.col("id") % 113).cast("double"))
    group = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7))
    ids = spark.range(3000)
    for df in (
        ids.withColumn("g", F.lit("a")).withColumn("v", value),
        ids.withColumn("g", group).withColumn("v", (F.col("id") * 7919 % 1009).cast("double")),
    ):
        out = windows.add_ranks(df, {"r": (["g"], "v")})
        assert sorted(map(tuple, out.collect()), key=repr) == plain(df, ["g"], "v")


def test_a_hot_group_is_cut_into_ranges(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.col("id").cast("double").alias("v"))
    ranks = windows.value_ranks(df, "r", ["g"], "v")
    assert ranks.count() == 4000
    stored = max(
        Path(shared_root(spark).removeprefix("file:")).glob("result-*"),
        key=lambda p: p.stat().st_mtime_ns,
    )
    sizes = [r["count"] for r in spark.read.parquet(str(stored)).groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_ranks_of_decimals_and_of_nulls_only(spark):
    df = ranked(spark, 500).withColumn("v", F.col("v").cast("decimal(28,5)"))
    out = windows.global_rank(df, "r", "v")
    assert sorted(map(tuple, out.collect()), key=repr) == plain(df, [], "v")
    nothing = spark.range(5).withColumn("v", F.lit(None).cast("double"))
    assert {r.r for r in windows.global_rank(nothing, "r", "v").collect()} == {1}


def test_only_one_row_per_range_meets_in_one_task(spark):
    out = windows.global_rank(ranked(spark, 200), "r", "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sum("SinglePartition" in line for line in plan.splitlines()) <= 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_ties_share_a_rank_and_null_is_last(frame):
    df = frame("v double", {"v": 9.0}, {"v": 9.0}, {"v": 5.0}, {"v": None})
    out = windows.global_rank(df, "r", "v").collect()
    assert sorted(r.r for r in out) == [1, 1, 3, 4]
    assert next(r.r for r in out if r.v is None) == 4


def test_dedup_does_not_depend_on_partitions(spark):
    df = spark.range(3000).select(
        (F.col("id") % 50).alias("k"),
        (F.col("id") % 7).cast("double").alias("v"),
        F.concat(F.lit("t"), (F.col("id") % 11).cast("string")).alias("note"),
    )
    results = set()
    for parts in (1, 3, 8):
        out = windows.dedup_latest(
            df.repartition(parts), ["k"], [F.col("v").desc_nulls_last()], ["note"]
        )
        results.add(tuple(sorted(map(tuple, out.collect()))))
    assert len(results) == 1
    rows = results.pop()
    assert len(rows) == 50 and all(r[1] == 6.0 for r in rows)


@pytest.mark.parametrize("most", [100, 1])
def test_stored_rows_are_shuffled_only_if_their_key_repeats(spark, most):
    """Two keys come twice, null keys three times; the other rows stay in place."""
    ids = spark.range(200).select(
        F.when(F.col("id") < 3, None).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").cast("double").alias("v"),
    )
    twice = ids.where("v in (50, 60)").withColumn("v", F.col("v") + 1000)
    df = share(ids.unionByName(twice))
    order = [F.col("v").desc_nulls_last()]
    out = windows.dedup_stored(df, ["k"], order, ["v"], most=most)
    want = windows.dedup_latest(df, ["k"], order, ["v"])
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert out.where("k is null").first().v == 2.0 and out.count() == 198
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("LeftAnti" in plan) == (most == 100)
    alone = share(ids.where("v > 2"))
    assert "Exchange" not in windows.dedup_stored(alone, ["k"], order)._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    plan = windows.dedup_latest(df, ["k"], [F.col("v").desc()])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("WindowGroupLimit") == 2


def test_rows_and_days_differ_when_a_day_is_missing(frame):
    days = [1, 2, 3, 4, 5, 6, 7, 9]  # the 8th is missing
    df = frame("b string, d string, v double", *[{"b": "A", "d": f"2026-01-{x:02d}", "v": float(x)} for x in days])
    df = df.withColumn("d", F.col("d").cast("date"))
    out = df.select(
        "d",
        windows.lag_rows("v", 7, ["b"], ["d"]).alias("lag"),
        windows.lag_days("v", 7, ["b"], "d").alias("lag_days"),
        windows.rolling_avg("v", 7, ["b"], ["d"]).alias("avg"),
        windows.rolling_avg_days("v", 7, ["b"], "d").alias("avg_days"),
        windows.running_sum("v", ["b"], ["d"]).alias("total"),
    ).orderBy("d").collect()
    assert out[-1].lag == 1 and out[-1].lag_days == 2
    assert out[-1].avg == (2 + 3 + 4 + 5 + 6 + 7 + 9) / 7
    assert out[-1].avg_days == (3 + 4 + 5 + 6 + 7 + 9) / 6
    assert out[2].avg == 2 and out[-1].total == 37
