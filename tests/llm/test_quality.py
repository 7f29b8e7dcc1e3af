from __future__ import annotations

import random

import pytest

from stallbook.llm import quality


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    parts = "ka lo mi ten dar sil vo pra en tu".split()
    rows = []
    for i in range(400):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 400))]
        good = i % 4 > 0
        text = " ".join(words) if good else " ".join(f"{w.upper()}!!%%" for w in words)
        rows.append((i, text, int(good)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    return docs, labels


def test_held_out_texts_are_told_apart(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels.where("doc_id % 3 > 0"))
    scored = quality.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    right = sum((r.score >= 0.7) == (r.quality == 1) for r in scored)
    assert right / len(scored) > 0.97
    assert all(0 <= r.score <= 1 for r in scored)


def test_given_documents_are_told_apart(spark):
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    model = quality.train(docs, labels.where("doc_id % 4 > 0"))
    rows = quality.score(docs, model).join(labels, "doc_id").where("doc_id % 4 = 0").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.score >= 0.7 for r in good) / len(good) > 0.93
    assert sum(r.score < 0.7 for r in bad) / len(bad) > 0.8


def test_every_piece_of_a_long_text_counts(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels)
    sizes = quality.Sizes(model.good, model.bad)
    good, bad = (docs.where(f"doc_id = {i}").first().text.encode() for i in (1, 0))
    long = (good + b" ") * 200
    assert sizes.features(long + bad * 3)[2] > sizes.features(long)[2]


def test_odd_rows(labelled, docs_of, spark):
    docs, labels = labelled
    odd = labels.union(spark.createDataFrame([(None, 1), (5, None), (6, 7), (9999, 0)], labels.schema))
    model = quality.train(docs, odd.union(labels))
    table = docs_of(None, "", (None, "kalo mi"), (3, "x"), (3, "x")).withColumnRenamed("lang", "score")
    rows = quality.score(table, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3 and r.text == "x"}) == 1
    assert quality.score(table.where("false"), model).count() == 0
    blank = quality.train(docs.where("false"), labels)
    assert {r.score for r in quality.score(table, blank).collect()} == {0.5}
    one = quality.train(docs, labels.where("quality = 1"))
    assert all(0 <= r.score <= 1 for r in quality.score(table, one).collect())
