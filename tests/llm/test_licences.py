from __future__ import annotations

import time

import pytest

from stallbook.llm import licences
from stallbook.llm.common import word_list


def brute_base(text):
    words = [w.decode() for w in word_list((text or "").encode())]
    places, labels = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = 0
    for r in licences.scan(docs).collect():
        n, places, labels = brute_base(r.text)
        found += bool(places)
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), labels)
        assert r.first_word == (places[0] if places else None)
        assert r.last_word == (places[-1] if places else None)
        assert set(labels.split(",")) <= set(r.labels.split(",")) | {""}
    assert found >= 20


@pytest.mark.parametrize(
    "text, want",
    [
        ("MIT", "mit"),
        ("MIT OR Apache-2.0", "mit apache-2.0 or"),
        ("a OR b AND c", "a b c and or"),
        ("(a OR b) AND c", "a b or c and"),
        ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT */", "gpl-2.0 classpath-exception-2.0 with mit or"),
        ("a OR", None), ("OR a", None), ("(a", None), ("a)", None), ("a b", None), ("", None),
        ("()", None), ("a ? b", None),
    ],
)
def test_shunting_yard(text, want):
    got = licences.to_postfix(text)
    assert (got and " ".join(got)) == want


def brute_reach(text):
    """Python's own parser with min and max in place of or and and."""

    class Reach(int):
        def __or__(self, other):
            return Reach(min(self, other))

        def __and__(self, other):
            return Reach(max(self, other))

    env = {"a": Reach(0), "b": Reach(1), "c": Reach(2), "d": Reach(3)}
    return int(eval(text.replace("OR", "|").replace("AND", "&"), env))


def test_evaluation_equals_another_parser(monkeypatch):
    monkeypatch.setattr(licences, "REACH", {"a": 0, "b": 1, "c": 2})
    for text in ("a OR b AND c", "(a OR d) AND (b OR c)", "d AND (c OR (a AND b))", "a AND b OR c AND d"):
        names, far = licences.evaluate(licences.to_postfix(text))
        assert far == brute_reach(text)
        assert names == {x for x in "abcd" if x in text}


def test_exceptions_and_depth():
    names, far = licences.evaluate(licences.to_postfix("GPL-3.0-only WITH GCC-exception-3.1"))
    assert (names, far) == ({"gpl-3.0-only"}, 1)
    assert licences.to_postfix("(" * 5000 + "mit" + ")" * 5000) == ["mit"]


def test_rows(docs_of):
    docs = docs_of(
        "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\ncode",
        "CC BY cc-by CC BY-NC 4.0", "all rights\nreserved General Public LICENSE", None, "",
        "spdx license identifier none", "x " * 60_000 + "All Rights Reserved.",
    ).withColumnRenamed("source", "labels")
    rows = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert rows[1].labels == "bsd-3-clause,gpl-2.0-only,mit" and rows[1].score == 1.0
    assert rows[1].reach == 0 and rows[1].base_labels == ""
    assert (rows[2].n_base, rows[2].first_word, rows[2].last_word) == (3, 0, 4)
    assert rows[2].labels == "cc-by,cc-by-nc"
    assert (rows[3].base_labels, rows[3].n_base) == ("gpl,reserved", 2)
    assert [(rows[i].n_words, rows[i].labels, rows[i].score) for i in (4, 5)] == [(0, "", 0.0)] * 2
    assert rows[6].expressions == [] and rows[6].score == 0.0
    assert rows[7].first_word == 60_000
    assert licences.scan(docs.where("false")).count() == 0


@pytest.mark.parametrize(
    "line, labels, expressions",
    [
        ("MIT Permission is hereby granted", "mit", ["mit"]),
        ("MIT.", "mit", ["mit"]),
        ("Apache-2.0 OR MIT. See the file", "apache-2.0,mit", ["apache-2.0 mit or"]),
        ("(MIT AND BSD-3-Clause) for details and more", "bsd-3-clause,mit", ["mit bsd-3-clause and"]),
        ("GPL-2.0 or later versions", "gpl-2.0", ["gpl-2.0"]),
        ("GPL-2.0 or later", "gpl-2.0,later", ["gpl-2.0 later or"]),
        ("MIT AND", "mit", ["mit"]),
        ("Custom terms apply", "custom", ["custom"]),
        ("GPL-2.0 WITH Classpath-exception-2.0 */", "gpl-2.0", ["gpl-2.0 classpath-exception-2.0 with"]),
        ("(MIT", "", []),
        ("? MIT", "", []),
        ("", "", []),
    ],
)
def test_tags_in_running_text(line, labels, expressions):
    found = licences.scan_one(f"SPDX-License-Identifier: {line}".encode(), licences.automaton())
    assert (found[5], found[6]) == (labels, expressions)


def test_many_places_take_time_in_proportion():
    find = licences.automaton()

    def seconds(n):
        start = time.perf_counter()
        found = licences.scan_one(b"cc by all rights reserved " * n, find)
        assert (found[1], found[2], found[3]) == (2 * n, 0, 5 * n - 3)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(80_000) < 16 * seconds(20_000)
