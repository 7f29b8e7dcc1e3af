"""The pipeline's stages against brute force, on the smallest given documents."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest

from stallbook.llm import packing
from stallbook.llm.common import word_list
from . import test_decontaminate, test_jaccard, test_packing, test_suffix

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage gets and returns, written and read as in a run."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs.collect()))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "repeated_passages", "decontamination", "packing",
    ]
    for _, rows in stages[:-1]:
        assert rows[0].__fields__ == corpus_pipeline.COLUMNS
        assert all(r.n_chars == len(r.text) for r in rows)


def test_quality_keeps_good_and_rejects_bad(spark, stages):
    kept = {r.doc_id for r in stages[1][1]}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.2


def test_one_of_each_group_stays(stages):
    before, after = stages[1][1], stages[2][1]
    want = {c for _, c, *_ in test_jaccard.brute_force([(r.doc_id, r.text) for r in before])}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_repeated_passages_go(stages):
    before, after = stages[2][1], stages[3][1]
    left = {r.doc_id: r.text for r in after}
    assert set(left) == {r.doc_id for r in before}
    order = sorted(before, key=lambda r: r.doc_id)
    want = test_suffix.brute_force([r.text for r in order], 400)
    for r, (n, removed, *_) in zip(order, want):
        # A cut through a character leaves up to three of its bytes on either side.
        assert 0 <= n - removed - len(left[r.doc_id].encode()) <= 6 * (removed // 400 + 1)
        assert removed or left[r.doc_id] == r.text


def test_benchmark_passages_go(spark, stages):
    before, after = stages[3][1], stages[4][1]
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    items = [(r.item_id, r.text) for r in bench]
    left = {r.doc_id: r.text for r in after}
    found = 0
    for r in before:
        n, _, hit = test_decontaminate.brute_force(r.text, items)
        found += bool(hit)
        if n and len(hit) == n:
            assert r.doc_id not in left
        else:
            words = word_list(r.text.encode())
            kept = [w for i, w in enumerate(words) if i not in set(hit)]
            assert word_list(left[r.doc_id].encode()) == kept
    assert found


def test_every_token_is_packed(stages):
    docs, rows = stages[4][1], stages[5][1]
    tokens = {r.doc_id: len(re.findall(rb"[^\x20\x09-\x0d]+", r.text.encode())) + 1 for r in docs}
    packed: dict[int, int] = {}
    for r in rows:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.piece_tokens
    assert packed == tokens
    test_packing.check(rows, packing.CAPACITIES)


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(stages[-1][1])
