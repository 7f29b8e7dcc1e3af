from __future__ import annotations

import numpy as np

from stallbook.llm import langid
from stallbook.llm.common import crc_of, held_out


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out("doc_id", 4)))
    assert model.languages == sorted(model.languages) == ["de", "en", "es", "fr"]
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.predict(docs.select("doc_id", "text"), model).collect()
    rest = [r for r in rows if crc_of(r.doc_id, 4) == 2]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rest) / len(rest) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_binding_depends_on_order_and_keeps_apart():
    vectors = langid.letter_vectors()
    n = langid.LETTERS
    abc, cba, abd = ((x * n + y) * n + z for x, y, z in ((1, 2, 3), (3, 2, 1), (1, 2, 4)))
    v = langid.bound(np.array([abc, cba, abd]), vectors)
    assert set(np.unique(v)) == {-1.0, 1.0}
    cosine = v @ v.T / langid.DIMENSIONS
    assert abs(cosine[0, 1]) < 0.15 and abs(cosine[0, 2]) < 0.15


def brute_grams(text):
    out = {}
    letters = [c if c.isalpha() else " " for c in text]
    words = "".join(letters).split()
    line = " " + " ".join(words) + " "
    for i in range(1, len(line) - 1):
        if line[i] != " " and (len(words) > 0):
            g = line[i - 1 : i + 2].lower()
            out[g] = out.get(g, 0) + 1
    return out


def test_trigrams_are_counted_per_text():
    grams = langid.Trigrams()
    texts = ["Abc, abd!", "", "42", "Äb abc"]
    pair, n, has = grams.of([t.encode() for t in texts])
    assert has.tolist() == [True, False, False, True]
    for i, t in enumerate(texts):
        want = {}
        for g, k in brute_grams(t).items():
            a, b, c = (grams.table[ord(x)] for x in g)
            want[int((a * langid.LETTERS + b) * langid.LETTERS + c)] = k
        got = dict(zip(pair[1][pair[0] == i].tolist(), n[pair[0] == i].tolist()))
        assert got == want


def test_odd_rows(docs_of, spark):
    train = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None),
         ("12", "nl"), ("y", "und")],
        "text string, lang string",
    )
    model = langid.train(train)
    assert set(model.languages) <= {"de", "en", "nl"}
    docs = docs_of(None, "", "12 !?", "the dog", "und der hund", "the dog " * 40_000, (None, "the dog"))
    docs = docs.withColumnRenamed("source", "lang_pred")
    rows = langid.predict(docs, model).collect()
    assert [r.lang_pred for r in rows] == ["und"] * 3 + ["en", "de", "en", "en"]
    assert [r.score for r in rows[:3]] == [0.0] * 3
    assert langid.predict(docs.where("false"), model).count() == 0
    blank = langid.train(train.where("false"))
    assert {r.lang_pred for r in langid.predict(docs, blank).collect()} == {"und"}
