from __future__ import annotations

import re

import pytest

from stallbook.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute_force(text, items, size=10):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        b = words(t)
        k = min(size, len(b))
        windows = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(w), sorted(found), sorted(hit)


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_equals_brute_force(corpus, spark, block_words, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 25)
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(12)
    items = [(r.item_id, r.text) for r in bench.collect()] + [(900, "Ist der"), (None, "of the")]
    items += [(901, ""), (902, None), (10, "zu und"), (10, "zu und")]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = corpus.where("doc_id < 60").select("doc_id", "text")
    got = decontaminate.scan(docs, table, block_words=block_words).collect()
    real = [(i, t) for i, t in items if i is not None]
    assert any(r.hit_words for r in got)
    for r in got:
        assert (r.n_words, list(r["items"]), list(r.hit_words)) == brute_force(r.text, real)


def test_spans_go_and_the_rest_stays(docs_of, spark):
    item = "One two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_of(f"Before, {item.upper()}! After it.", "clean", None, "", item)
    cleaned = decontaminate.without_spans(decontaminate.scan(docs, bench))
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts == {1: "Before, ! After it.", 2: "clean", 3: None, 4: "", 5: ""}


def test_empty_tables_clashing_names_and_a_long_text(docs_of, spark):
    bench = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert decontaminate.scan(docs_of("a").where("false"), bench).count() == 0
    none = decontaminate.scan(docs_of("a b"), bench.where("false")).first()
    assert (none.n_words, none["items"], none.hit_words) == (2, [], [])
    clash = docs_of("q " * 50_000 + "X-y").withColumnRenamed("source", "items")
    got = decontaminate.scan(clash, bench).first()
    assert (got.n_words, got["items"], got.hit_words) == (50_002, ["1"], [50_000, 50_001])


@pytest.mark.parametrize("block_words", [10**6, 10])
def test_items_without_an_id_hit_like_others(docs_of, spark, block_words):
    item = "one two three four five six seven eight nine ten eleven"
    items = [(None, item), (None, "odd pair"), (7, "seven eight"), (8, "x y")]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(f"a {item} b", "an odd pair", "x y odd pair", "none", "x y")
    scanned = decontaminate.scan(docs, table, block_words=block_words, unnamed=True)
    for r in scanned.collect():
        n, _, hit = brute_force(r.text, items)
        assert (r.n_words, list(r.hit_words)) == (n, hit)
    assert {r.doc_id: list(r["items"]) for r in scanned.collect()} == {
        1: ["7", None], 2: [None], 3: ["8", None], 4: [], 5: ["8"],
    }
    left = {r.doc_id: r.text for r in decontaminate.without_spans(scanned).collect()}
    assert left[1] == "a  b" and left[2] == "an "


def test_query_and_pipeline_take_items_without_an_id(docs_of, spark, tmp_path):
    import corpus_pipeline
    from stallbook.llm import queries

    table = spark.createDataFrame([(None, "odd pair"), (8, "x y")], "item_id long, text string")
    table.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of("an odd pair", "x y odd pair", "none")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op2_decontamination"](spark, str(tmp_path)).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [
        (2, 1, True), (4, 2, True), (0, 0, False),
    ]
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in left} == {1: "an ", 3: "none"}
