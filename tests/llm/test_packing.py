from __future__ import annotations

import random
from collections import defaultdict

from stallbook.llm import packing


def check(rows, capacities):
    """No overlap, nothing beyond the capacity, the smallest capacity that fits."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence].append((r.offset, r.piece_tokens, r.capacity))
    for pieces in by.values():
        at = 0
        for offset, n, _ in sorted(pieces):
            assert offset == at
            at += n
        assert {c for *_, c in pieces} == {min(c for c in capacities if c >= at)}
    return by


def test_pieces_cover_every_text_once_and_fill_sequences(spark):
    rng = random.Random(2)
    lengths = [(i, rng.choice([rng.randint(0, 40), rng.randint(1, 300)])) for i in range(3000)]
    df = spark.createDataFrame(lengths, "doc_id long, n_tokens long")
    capacities = (16, 32, 64)
    rows = packing.pack(df, capacities=capacities, shard_tokens=50_000).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.piece_tokens))
    for i, n in lengths:
        pieces = sorted(by_doc[i])
        assert [p for p, *_ in pieces] == list(range(len(pieces)))
        assert [s for _, s, _ in pieces] == [64 * p for p, *_ in pieces]
        assert sum(k for *_, k in pieces) == n
        assert all(k <= 64 for *_, k in pieces) and len(pieces) == max(1, -(-n // 64))
    by = check(rows, capacities)
    used = sum(n for _, n in lengths)
    room = sum(p[0][2] for p in by.values())
    assert used / room > 0.97
    assert len({s >> 32 for s in by}) > 1


def test_best_fit_takes_the_fullest_sequence_and_shrinks_it():
    # 6 and 5 open sequences of 8; 3 goes where it leaves nothing.
    placed = packing.pack_lengths([6, 5, 3], (4, 8))
    assert placed[2] == (placed[1][0], 8, 5)
    assert packing.pack_lengths([3], (4, 8, 16)) == [(0, 4, 0)]
    assert packing.pack_lengths([], (4,)) == []


def test_round_trip_of_words(docs_of):
    docs = docs_of("a b  c\td", None, "", "x " * 50, "a b  c\td", (None, "z"))
    packed = packing.pack(packing.count_tokens(docs), capacities=(8, 16))
    out = packing.sequences(packed).collect()
    assert all(r.n_tokens == len(r.words) <= r.capacity for r in out)
    words = sorted(w for r in out for w in r.words)
    want = ["a", "b", "c", "d"] * 2 + ["x"] * 50 + ["z"] + ["<end>"] * 6
    assert words == sorted(want)
    first = next(r for r in out if "z" in r.words)
    assert first.words[first.words.index("z") + 1] == "<end>"


def test_odd_lengths_and_names(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (2, -5, "b"), (3, 0, "c"), (3, 0, "c"), (4, 70, "d")],
        "doc_id long, n_tokens long, capacity string",
    )
    rows = packing.pack(df, capacities=(32,)).collect()
    assert sorted((r.doc_id, r.piece_tokens) for r in rows) == [
        (1, 0), (2, 0), (3, 0), (3, 0), (4, 6), (4, 32), (4, 32),
    ]
    assert {r.capacity for r in rows} == {32}
    assert packing.pack(df.where("false")).count() == 0
