from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.llm import jaccard
from stallbook.llm.common import word_list


def shingles(text):
    w = word_list((text or "").encode())
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(rows):
    """Links and class of each (id, text)."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    near = [[] for _ in rows]
    root = list(range(n))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                near[i].append(j)
                near[j].append(i)
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    classes = [min(rows[j][0] for j in range(n) if find(j) == find(i)) for i in range(n)]
    texts = [len({sets[j] for j in near[i]} - {sets[i]}) for i in range(n)]
    return [(rows[i][0], classes[i], len(near[i]), texts[i]) for i in range(n)]


def near_copies(seed, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([5, 30, 80, 200]))
        for _ in range(rng.randint(1, 25)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts.append(" ".join(t))
    texts += ["", None, "one", "one", "One!", "a b c d", "a b c d", "!!"]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts, 1)]


@pytest.mark.parametrize("bucket, block", [(256, 512), (8, 5)])
def test_equals_brute_force(docs_of, monkeypatch, bucket, block):
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(block)
    got = jaccard.near_duplicates(docs_of(*rows)).collect()
    want = brute_force(rows)
    assert sorted((r.doc_id, r.class_id, r.n_links, r.n_texts) for r in got) == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_equals_brute_force_on_given_documents(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    got = jaccard.near_duplicates(corpus).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links, r.n_texts) for r in got) == sorted(brute_force(rows))


def test_shingles_match_words():
    texts = [t for _, t in near_copies(1)] + ["Ä b, c d e f", "ä B c D e F!"]
    sets = jaccard.shingle_sets([None if t is None else t.encode() for t in texts])
    for i in range(len(texts)):
        assert len(sets[i]) == len(shingles(texts[i]))
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert both == len(shingles(texts[i]) & shingles(texts[j]))


def test_shared_tokens_by_product_and_postings():
    rng = np.random.default_rng(2)
    common = np.arange(50, dtype=np.uint64)
    sets = [
        np.unique(np.concatenate([common, rng.integers(100, 400, 30).astype(np.uint64)]))
        for _ in range(40)
    ]
    rows = np.arange(40)
    got = jaccard.shared_tokens(sets, rows, rows)
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    apart = ~np.eye(40, dtype=bool)  # a set is not compared with itself
    assert (got == want)[apart].all()
    part = jaccard.shared_tokens(sets, rows[:15], rows[15:])
    assert part.tolist() == got[:15, 15:].tolist()


def test_runs_reach_the_recall():
    rng = np.random.default_rng(7)
    met = 0
    runs = jaccard.runs_for(0.9995, 0.8, 2)
    for _ in range(300):
        base = rng.integers(0, 2**63, 90).astype(np.uint64)
        a, b = np.unique(base[:80]), np.unique(np.concatenate([base[:80][9:], base[80:89]]))
        hit = False
        for run in range(runs):
            root = np.full(2, jaccard.mix(np.array([run + 1], np.uint64))[0])
            row, path = jaccard.deeper([a, b], root, 2)
            hit = hit or bool(set(path[row == 0]) & set(path[row == 1]))
        met += hit
    assert met >= 298


def test_one_of_each_group_stays(docs_of):
    text = " ".join(f"w{i}" for i in range(50))
    docs = docs_of(
        (5, text), (3, text + " x"), (3, text + " x"), (9, "other words are here to stay"),
        (None, text), (7, ""), (8, None),
    ).withColumnRenamed("lang", "class_id")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8, 9]
    assert jaccard.one_of_each(docs.where("false")).count() == 0


def test_rows_without_ids(docs_of):
    text = " ".join(f"w{i}" for i in range(50))
    rows = jaccard.near_duplicates(docs_of((None, text), (None, text), (None, "alone in the world"))).collect()
    assert sorted(r.n_links for r in rows) == [0, 1, 1]
    assert sum(r.kept for r in rows) == 2


def test_members_carry_the_size_of_their_bucket(spark):
    """So that no later step joins them by path again; a member stays one row."""
    paths = {1: "abc", 2: "abc", 3: "ab", 4: "d", 5: "cd"}
    rows = [(s.encode(), p) for p, own in paths.items() for s in own]
    buckets, final = jaccard.in_buckets(spark.createDataFrame(rows, "set binary, path long"))
    assert {(r.path, r.n) for r in buckets.collect()} == {(1, 3), (3, 2), (5, 2)}
    got = sorted((r.path, bytes(r.set).decode(), r.n) for r in final.collect())
    assert got == [(1, s, 3) for s in "abc"] + [(3, s, 2) for s in "ab"] + [(5, s, 2) for s in "cd"]


def test_rows_that_match_nothing_are_not_moved(spark):
    """All wanted rows, null keys too, and hardly any other."""
    key = F.unhex(F.md5(F.col("id").cast("string").cast("binary")))
    rows = spark.range(50_000).select("id", key.alias("text_key"), F.lit("x").alias("text"))
    rows = rows.withColumn("id", F.when(F.col("id") != 10, F.col("id")))
    wanted = rows.where("id % 50 = 3 or id is null").select("text_key", "id")
    left = jaccard.may_match(rows, wanted, "text_key", "id")
    assert left.columns == rows.columns
    assert left.where("id % 50 = 3 or id is null").count() == wanted.count() == 1001
    assert left.count() < 1100
    assert jaccard.may_match(rows, wanted.limit(0), "text_key", "id").isEmpty()
