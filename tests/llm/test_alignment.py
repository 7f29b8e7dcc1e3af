from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.llm import alignment

ODD = [
    None,
    "",
    " ",
    "  two  spaces  ",
    "x",
    "a\n\nb\tc ",
    "naïve 日本語 🎉🎉 é é ​z",
    "<|endoftext|> <s> <0x41> <unk>",
    "a ᠎ b ⁠ c",
    "not mine: ▁ here",
    "zero\0byte",
    "word " * 3000,
    "z" * 5000,
    "กข ฃ ก ข " * 20,
    " lead and trail ",
    "a b 　c \x1c d",
]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair.load()


def brute(texts: list[str | None], pair):
    """Whole texts, one by one, cut by the decoded bytes alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_buffer(pair.a_json)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=pair.b_model)
    entries = {i: e for e, i in a.get_vocab(with_added_tokens=True).items()}
    alphabet = alignment.byte_alphabet()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        x = a.encode(raw.decode(), add_special_tokens=False).ids
        y = b.encode(text or "")
        x_bytes = [bytes(alphabet[c] for c in entries[i]) for i in x]
        y_bytes = [b_bytes(i) for i in y]
        if not text or b"".join(x_bytes) != raw or b"".join(y_bytes) != raw:
            docs.append(None)
            continue
        owner = [k for k, t in enumerate(x_bytes) for _ in t], [k for k, t in enumerate(y_bytes) for _ in t]
        links = sorted(set(zip(*owner)))
        ends = [set(np.cumsum([len(t) for t in z]).tolist()) for z in (x_bytes, y_bytes)]
        groups, at, i, j, done_a, done_b = [], 0, 0, 0, [], []
        for cut in sorted(ends[0] & ends[1]):
            while at < cut:
                if i == owner[0][at]:
                    done_a.append(x[i])
                    i += 1
                if j == owner[1][at]:
                    done_b.append(y[j])
                    j += 1
                at += 1
            groups.append(f"{','.join(map(str, done_a))}|{','.join(map(str, done_b))}")
            done_a, done_b = [], []
        pairs = [(x[p], y[q]) for p, q in links]
        counts.update(pairs)
        docs.append((len(x), len(y), len(groups), pairs, ";".join(groups)))
    top = Counter()
    for (_, q), n in counts.items():
        top[q] = max(top[q], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, pairs, groups = d
        out.append(
            (
                n_a, n_b, n_groups, len(pairs),
                sum(counts[p] == top[p[1]] for p in pairs),
                sum(counts[p] for p in pairs),
                hashlib.sha256(groups.encode()).hexdigest(),
            )
        )
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("most", [alignment.FREQUENT, 50, 0])
def test_equals_whole_texts_cut_by_their_bytes(spark, corpus, pair, most):
    given = [r.text for r in corpus.orderBy("doc_id").limit(60).collect()]
    texts = given + ODD + given[:5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.align(df, most=most).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, pair)


def test_long_texts_are_cut_into_stretches(monkeypatch, pair):
    monkeypatch.setattr(alignment, "STRETCH", 40)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    texts = [t for t in ODD if t is None or len(t) < 4000]
    aligner = alignment.Aligner(pair)
    total, groups, key, times = aligner.texts([t and t.encode() for t in texts])
    expected = brute(texts, pair)
    for row, e in enumerate(expected):
        assert tuple(total[row]) == e[:4]
        assert (hashlib.sha256(groups[row].encode()).hexdigest() if e[0] else "") == e[6]
    assert times.sum() == sum(e[3] for e in expected)


def test_texts_that_are_no_utf8_have_no_tokens(pair):
    total, groups, key, _ = alignment.Aligner(pair).texts([b"a \xff b", b"ok"])
    assert total[0].tolist() == [0, 0, 0, 0] and groups[0] == ""
    assert total[1][0] > 0


def test_spans_that_overlap_are_cut_by_lengths():
    # three tokens share a character of four bytes; then spans that mislead
    lengths = np.array([1, 2, 1, 1, 1])
    for ends in ([1, 5, 5, 5, 6], [1, 5, 5, 4, 6], [9, 9, 9, 9, 9]):
        assert alignment.token_ends(np.array(ends), lengths).tolist() == [1, 3, 4, 5, 6]
    assert alignment.token_ends(np.array([], int), np.array([], int)).tolist() == []


def test_empty_table_and_clashing_names(spark):
    schema = "doc_id long, text string, n_a string, Pairs int, _at int, _sum int, count_sum int"
    assert alignment.align(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "some text", "mine", 3, 4, 5, 6), (1, "some text", None, None, None, None, None)]
    out = alignment.align(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 2 and {r._at for r in out} == {4, None}
    assert all(r.n_a == 2 and r.count_sum > 0 for r in out)


def test_query_has_the_columns_asked_for(spark):
    from stallbook.llm.queries import QUERIES

    df = QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001")
    assert set(df.columns) == {"doc_id", *COLUMNS}
    assert df.where(F.col("n_links") != F.col("n_a") + F.col("n_b") - F.col("n_groups")).count() == 0
