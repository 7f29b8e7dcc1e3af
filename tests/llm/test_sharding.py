from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.llm import sharding


def test_hypergeometric_follows_its_law():
    rng = np.random.default_rng(5)
    good, bad, drawn, n = 7, 11, 6, 20_000
    seen = Counter(sharding.hypergeometric(rng, good, bad, drawn) for _ in range(n))
    for x in range(0, 7):
        p = math.comb(good, x) * math.comb(bad, drawn - x) / math.comb(good + bad, drawn)
        assert abs(seen[x] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 1


def test_hypergeometric_beyond_a_thousand_millions():
    rng = np.random.default_rng(6)
    good, bad, drawn = 3 * 10**11, 10**12, 10**6
    x = np.array([sharding.hypergeometric(rng, good, bad, drawn) for _ in range(300)])
    mean, sd = drawn * 3 / 13, math.sqrt(drawn * 3 / 13 * 10 / 13)
    assert abs(x.mean() - mean) < 5 * sd / math.sqrt(300)
    assert 0.8 < x.std() / sd < 1.2
    assert sharding.hypergeometric(rng, 0, 10, 5) == 0
    assert sharding.hypergeometric(rng, 10, 0, 5) == 5


def test_matrix_has_exact_sums(spark):
    counts = [(b, (b * 37) % 101) for b in range(2500)]
    blocks = spark.createDataFrame(counts, "block long, n_rows long").repartition(4)
    rows = sharding.communication_matrix(blocks, 7, seed=3).collect()
    assert {r.block: sum(r.to) for r in rows} == dict(counts)
    total = sum(n for _, n in counts)
    assert [sum(r.to[j] for r in rows) for j in range(7)] == sharding.shard_sizes(total, 7)
    again = sharding.communication_matrix(blocks.repartition(3), 7, seed=3).collect()
    assert {r.block: r.to for r in rows} == {r.block: r.to for r in again}


def placed(df, **more):
    return sharding.shuffle_into_shards(df, **more).collect()


@pytest.mark.parametrize("n", [0, 5, 17, 1000])
def test_shards_are_exact_and_slots_without_gaps(spark, n):
    rows = placed(spark.range(n).repartition(3), shards=16, seed=1)
    assert sorted(r.id for r in rows) == list(range(n))
    sizes = Counter(r.shard for r in rows)
    assert [sizes[j] for j in range(16)] == sharding.shard_sizes(n, 16)
    for j in range(16):
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(sizes[j]))


def test_cells_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    rows = placed(spark.range(0, 900, 1, 5), shards=3, seed=4)
    for j in range(3):
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(300))


def test_every_place_is_equally_likely(spark):
    """Over some seeds, which row comes to which place is as for random orders."""
    n, seeds = 12, 16
    df = spark.range(0, n, 1, 3).cache()
    seen = np.zeros((n, n))
    for seed in range(seeds):
        for r in placed(df, shards=4, seed=seed):
            seen[r.id, r.shard * 3 + r.slot] += 1
    df.unpersist()
    chi = ((seen - seeds / n) ** 2).sum() / (seeds / n) * (n - 1) / n
    free = (n - 1) ** 2
    assert abs(chi - free) < 4 * math.sqrt(2 * free)


def test_places_do_not_follow_the_input(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 100)
    n = 6000
    rows = sorted(placed(spark.range(0, n, 1, 6), shards=4, seed=9))
    at = np.array([r.shard * (n // 4) + r.slot for r in rows])
    assert sorted(at) == list(range(n))
    assert abs(np.corrcoef(np.arange(n), at)[0, 1]) < 4 / math.sqrt(n)
    assert abs(np.corrcoef(at[:-1], at[1:])[0, 1]) < 4 / math.sqrt(n)
    # rows of an input partition per quarter of each shard
    cells = np.zeros((6, 16))
    np.add.at(cells, (np.arange(n) // 1000, at // (n // 16)), 1)
    chi = ((cells - n / 96) ** 2 / (n / 96)).sum()
    assert abs(chi - 75) < 4 * math.sqrt(150)


def test_nulls_copies_and_clashing_columns(spark):
    schema = "doc_id long, text string, shard string, Slot string, _at int, at int, cell int, made int, block int, `a b` int, before int, `to` int"
    rows = [(None, None, "x", "y", 1, 2, 3, 4, 5, 6, 7, 8)] * 20 + [(1, "t" * 300_000, None, None, *[None] * 8)] * 3
    out = sharding.shuffle_into_shards(spark.createDataFrame(rows, schema), shards=4)
    assert set(out.columns) == {"doc_id", "text", "shard", "slot", "_at", "at", "cell", "made", "block", "a b", "before", "to"}
    got = out.collect()
    assert len(got) == 23 and sum(r["a b"] == 6 for r in got) == 20
    assert sorted(Counter(r.shard for r in got).values()) == [5, 6, 6, 6]


def test_same_seed_same_places(spark):
    df = spark.range(0, 500, 1, 4)
    first, second = (sorted(placed(df, shards=5, seed=s)) for s in (2, 2))
    assert first == second != sorted(placed(df, shards=5, seed=3))


def test_query(spark):
    from stallbook.llm.queries import QUERIES

    df = QUERIES["op11_sharding"](spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), "doc_id"
    )
    text = F.coalesce("text", F.lit(""))
    wrong = (F.col("size") != F.length(text.cast("binary")) + 1) | (F.col("law") != "rows")
    assert df.count() == 200 and df.where(wrong).count() == 0
    assert dict(df.dtypes)["grown_shard"] == "int"
