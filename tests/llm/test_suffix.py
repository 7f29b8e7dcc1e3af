from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stallbook.llm import suffix_dedup


def brute_force(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[p : p + length] for r in raw for p in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        rest = bytes(b for b, g in zip(r, gone) if not g)
        spans = len(gone.replace(b"\0", b" ").split())
        out.append((len(r), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def digest(r):
    return (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)


def made_texts(length, seed):
    rng = random.Random(seed)

    def some(n, letters="abcdefgh ä"):
        return "".join(rng.choices(letters, k=n))

    shared = [some(n) for n in (length - 1, length, length + 1, 3 * length)]
    texts = [None, "", some(5), some(length), some(2 * length)]
    for _ in range(30):
        parts = []
        for _ in range(rng.randint(1, 4)):
            s = rng.choice(shared)
            cut = rng.randint(0, 20)
            parts += [some(rng.randint(0, 80)), s[cut : len(s) - rng.randint(0, 20)]]
        texts.append("".join(parts))
    texts += [texts[7], texts[7], "x" * (4 * length), "ab" * length, "é" * length, some(30) * 30]
    # Near copies: single characters differ.
    for _ in range(10):
        t = list(texts[8])
        t[rng.randrange(len(t))] = "Z"
        texts.append("".join(t))
    return texts


@pytest.mark.parametrize("length, most_runs", [(64, 512), (64, 2), (400, 512), (400, 1)])
def test_equals_brute_force(docs_of, length, most_runs):
    texts = made_texts(length, length + most_runs)
    want = brute_force(texts, length)
    rows = suffix_dedup.remove_repeats(docs_of(*texts), length=length, most_runs=most_runs).collect()
    got = {r.doc_id: r for r in rows}
    assert [digest(got[i]) for i in range(1, len(texts) + 1)] == want
    assert sum(w[1] for w in want) > 0
    for i, t in enumerate(texts, 1):
        kept = bytearray((t or "").encode())
        for s in reversed(got[i].spans):
            del kept[s.first : s.end]
        assert hashlib.sha256(bytes(kept)).hexdigest() == got[i].kept_sha256
        assert (got[i].text is None) == (t is None)


def test_equals_brute_force_on_given_documents(corpus):
    rows = suffix_dedup.remove_repeats(corpus.select("doc_id", "text")).collect()
    texts = {r.doc_id: r.text for r in corpus.collect()}
    order = sorted(texts)
    got = {r.doc_id: digest(r) for r in rows}
    assert [got[i] for i in order] == brute_force([texts[i] for i in order], 400)


def test_long_texts_are_read_in_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    texts = made_texts(64, 9)
    texts.append("".join(t or "" for t in texts))
    want = brute_force(texts, 64)
    got = {r.doc_id: digest(r) for r in suffix_dedup.remove_repeats(docs_of(*texts), length=64).collect()}
    assert [got[i] for i in range(1, len(texts) + 1)] == want


def test_blind_trie_orders_strings():
    rng = random.Random(3)
    strings = [bytes(rng.choices(b"ab", k=12)) for _ in range(300)]
    trie = suffix_dedup.BlindTrie()
    for i, s in enumerate(strings):
        trie.add(s, i)
    leaves = trie.leaves()
    assert [strings[x[0]] for x in leaves] == sorted(set(strings))
    assert all(len({strings[i] for i in x}) == 1 for x in leaves)
    assert sorted(i for x in leaves for i in x) == list(range(300))


def test_minimum_and_windows():
    x = np.random.default_rng(1).integers(0, 1000, 500).astype(np.uint64)
    got = suffix_dedup.sliding_minimum(x, 37)
    assert got.tolist() == [x[i : i + 37].min() for i in range(500 - 36)]


def test_repeated_rows_null_ids_and_clashing_names(docs_of):
    text = "".join(random.Random(8).choices("abcdef", k=500))
    docs = docs_of((1, text), (1, text), (None, text), (2, "short")).withColumnRenamed("lang", "spans")
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 500), (1, 500), (1, 500), (2, 0)]
    assert suffix_dedup.remove_repeats(docs.where("false")).count() == 0
