"""Benchmark decontamination: windows of benchmark words are broadcast as a
hash table, documents are scanned for them and hits are compared word by word."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import annotate, raw_texts, text_slices, word_list
from stallbook.operators.shared import share

WINDOW = 10
#: Words of benchmark text in one broadcast; more items make more blocks.
BLOCK_WORDS = 2_000_000
#: Longer items are cut into overlapping pieces of so many words.
PIECE_WORDS = 100_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

SCHEMA = pa.schema(
    [
        ("n_words", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("hit_words", pa.list_(pa.int64())),
    ]
)


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit code of every window of ``size`` ids."""
    n = len(ids) - size + 1
    code = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        code = code * MULTIPLIER + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    return code


def in_order(items) -> list[str | None]:
    """Sorted ids, what has none at the end."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def window_tables(pieces: list[tuple[str | None, bytes]], window: int) -> tuple[dict, dict]:
    """Word ids, and by window size: sorted codes, the windows in that order, and
    the items of each window. ``pieces``: item id or null, and its words."""
    vocabulary: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], set[str | None]] = {}
    for item, joined in pieces:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in joined.split()]
        size = min(window, len(ids))
        for i in range(len(ids) - size + 1 if size else 0):
            windows.setdefault(tuple(ids[i : i + size]), set()).add(item)
    tables = {}
    for size in sorted({len(w) for w in windows}):
        rows = [w for w in windows if len(w) == size]
        table = np.array(rows, np.int64)
        codes = np.concatenate([rolling(r, size) for r in table])
        order = np.argsort(codes, kind="stable")
        tables[size] = codes[order], table[order], [in_order(windows[rows[i]]) for i in order]
    return vocabulary, tables


def hits(ids: np.ndarray, tables: dict) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(position, row of the window, size) of every window that occurs in
    ``ids``; ids below 0 are words that no window has."""
    found = []
    unknown = np.concatenate([[0], np.cumsum(ids < 0)])
    for size, (codes, table, _) in tables.items():
        if len(ids) < size:
            continue
        at = np.flatnonzero(unknown[size:] == unknown[:-size])
        if not len(at):
            continue
        spans = ids[at[:, None] + np.arange(size)]
        code = np.zeros(len(at), np.uint64)
        for k in range(size):
            code = code * MULTIPLIER + spans[:, k].astype(np.uint64) + np.uint64(1)
        # Several windows may share a code: compare with each of them.
        low, high = np.searchsorted(codes, code), np.searchsorted(codes, code, "right")
        for step in range(int((high - low).max(initial=0))):
            live = np.flatnonzero(low + step < high)
            row = low[live] + step
            same = (table[row] == spans[live]).all(axis=1)
            found.append((at[live[same]], row[same], size))
    return found


def find(texts: list[bytes | None], vocabulary: dict, tables: dict) -> list[list]:
    """Per text: number of words, sorted items, sorted hit words."""
    n_words, items, hit_words = [], [], []
    for first, last in text_slices(texts):
        ids: list[int] = []
        starts = []
        for raw in texts[first:last]:
            words = word_list(raw)
            starts.append(len(ids))
            n_words.append(len(words))
            ids.extend([vocabulary.get(w, -1) for w in words])
            ids.append(-1)
        edges = np.array(starts)
        in_doc: dict[int, set[str | None]] = {}
        hit = np.zeros(len(ids), bool)
        for at, row, size in hits(np.array(ids, np.int64), tables):
            docs = np.searchsorted(edges, at, "right") - 1
            for d, r in {*zip(docs.tolist(), row.tolist())}:
                in_doc.setdefault(d, set()).update(tables[size][2][r])
            for k in range(size):
                hit[at + k] = True
        where = np.flatnonzero(hit)
        docs = np.searchsorted(edges, where, "right") - 1
        parts = np.split(where, np.searchsorted(docs, np.arange(1, len(starts))))
        for d, part in enumerate(parts):
            items.append(in_order(in_doc.get(d, ())))
            hit_words.append(part - starts[d])
    return [n_words, items, hit_words]


def pieces_of(
    benchmark: DataFrame, item_id: str, text: str, window: int, unnamed: bool
) -> DataFrame:
    """(item, piece, words, n): items in pieces that overlap by a window less a
    word, so that every window lies in a piece."""

    def cut(batches):
        for batch in batches:
            rows = []
            texts = raw_texts(batch.column(1))
            for item, raw in zip(batch.column(0).to_pylist(), texts):
                words = word_list(raw)
                for k, i in enumerate(range(0, max(len(words) - window + 1, 1), PIECE_WORDS)):
                    part = words[i : i + PIECE_WORDS + window - 1]
                    if part and (unnamed or item is not None):
                        rows.append((item, k, b" ".join(part), len(part)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[i] for r in rows], t)
                    for i, t in enumerate((pa.string(), pa.int64(), pa.binary(), pa.int64()))
                ],
                names=["item", "piece", "words", "n"],
            )

    return benchmark.select(F.col(item_id).cast("string"), text).mapInArrow(
        cut, "item string, piece long, words binary, n long"
    )


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    unnamed: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``items`` (sorted ids of the items
    that have a window in it) and ``hit_words`` (positions of the words inside
    such a window).

    An item of fewer words than ``window`` is one window. A broadcast holds
    about ``block_words`` words (in pieces of at most ``PIECE_WORDS`` and a
    window); a larger benchmark is worked off in blocks, each against all
    documents, so no item is left out. Null or empty texts have no words and no
    hits. With ``unnamed``, as the query and the pipeline have it, items without
    an id hit like all others and are together one null at the end of ``items``;
    else they are skipped. Repeated item ids count once. Texts are read whole; rows with equal ids are scanned one by one.
    Empty tables give no hits. Input columns with these names are replaced.
    """
    spark = docs.sparkSession
    pieces = share(pieces_of(benchmark, item_id, item_text, window, unnamed))
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    out = docs
    for block in range(blocks):
        mine = pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == block)
        rows = [(r.item, bytes(r.words)) for r in mine.select("item", "words").toLocalIterator()]
        tables = spark.sparkContext.broadcast(window_tables(rows, window))

        def run(column: pa.Array, tables=tables) -> list:
            return find(raw_texts(column), *tables.value)

        if block == 0:
            out = annotate(out, [text], run, SCHEMA)
        else:
            old = {c: f"__{c}" for c in ("items", "hit_words")}
            out = annotate(out.withColumnsRenamed(old), [text], run, SCHEMA)
            for c, before in old.items():
                out = out.withColumn(c, F.array_sort(F.array_union(c, before))).drop(before)
        if blocks > 1:
            out = share(out)
    return out


def without_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """The scanned rows with the hit words, and what stands between hit words
    that follow each other, taken out of the text."""
    schema = pa.schema([(text, pa.string())])

    def run(column: pa.Array, hit_words: pa.Array) -> list:
        out = []
        for raw, hit in zip(raw_texts(column), hit_words.to_pylist()):
            if raw and hit:
                spans = [m.span() for m in WORDS.finditer(raw)]
                kept, at = [], 0
                runs = np.split(np.array(hit), np.flatnonzero(np.diff(hit) > 1) + 1)
                for r in runs:
                    kept.append(raw[at : spans[r[0]][0]])
                    at = spans[r[-1]][1]
                raw = b"".join([*kept, raw[at:]])
            out.append(None if raw is None else raw.decode("utf-8"))
        return [out]

    order = scanned.columns
    return annotate(scanned, [text, "hit_words"], run, schema).select(*order)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
