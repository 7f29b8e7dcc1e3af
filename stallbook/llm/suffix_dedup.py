"""Repeated passages by sorted suffixes: every byte covered by a string of a
given length that also starts anywhere else is removed.

No machine can sort the suffixes of a whole corpus, so they are dealt out by
content. The anchor of a window of 400 bytes is its 32-byte gram with the
smallest hash: equal windows have the same anchor at the same place. Windows of
a text that share an anchor stand next to each other and form a run; runs meet
by the hash of their anchor. Runs with the same bytes count as one with a number
of copies. Where runs of an anchor differ, their suffixes are sorted deep-shallow:
by multikey sort down to 32 bytes, then by blind tries for those that still agree.
Anchors with more runs than one task sorts are cut into finer pieces first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import annotate, raw_texts, text_slices
from stallbook.operators.shared import share

LENGTH = 400
GRAM = 32
SHALLOW = 32
#: Different runs of an anchor that one task sorts (2 MB); runs of anchors with
#: more are cut up and dealt out.
MOST_RUNS = 2048
#: Windows of a run that are cut off together.
BIN = 16
#: Bytes of text whose runs are found at a time, in about 70 times as much
#: memory; longer texts are read in overlapping pieces. Positions fit in 24 bits.
PIECE = 2**18
#: Runs that are sorted together, but for those of one anchor (about 20 KB each).
SORTED_RUNS = 1024
FACTOR = 0x9E3779B97F4A7C15 | 1


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of every ``GRAM`` bytes, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    step, power = 1, FACTOR
    while step < GRAM:
        h = h[:-step] * np.uint64(power) + h[step:]
        step, power = 2 * step, power * power % 2**64
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, from running minima of blocks."""
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[:n], from_left[width - 1 : width - 1 + n])


def runs_of(texts: list[bytes], length: int):
    """(text, first, last, anchor, hash): runs of window starts with a common
    anchor (positions in the text), and the anchor's hash."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    h = gram_hashes(data)
    low = np.uint64((1 << 24) - 1)
    places = np.arange(len(h), dtype=np.uint64)
    least = sliding_minimum((h & ~low) | places, length - GRAM + 1)
    anchor = (least & low).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    # Windows inside a text; those that cross an end are left out.
    inside = np.repeat(starts, np.maximum(sizes - length + 1, 0))
    first_of = np.cumsum(np.maximum(sizes - length + 1, 0)) - np.maximum(sizes - length + 1, 0)
    at = np.arange(len(inside)) - np.repeat(first_of, np.maximum(sizes - length + 1, 0)) + inside
    text = np.repeat(np.arange(len(texts)), np.maximum(sizes - length + 1, 0))
    own = anchor[at]
    change = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    ends = np.append(change[1:], len(at)) - 1
    base = starts[text[change]]
    return text[change], at[change] - base, at[ends] - base, own[change] - base, h[own[change]]


class BlindTrie:
    """Strings of one length, ordered by branching positions alone. A search
    follows branches without looking at the bytes between and compares once, with
    the leaf that it reaches; equal strings share a leaf."""

    def __init__(self) -> None:
        # A leaf is (None, string, rows), a node (position, branches by byte).
        self.root: tuple | None = None

    @staticmethod
    def common(a: bytes, b: bytes) -> int:
        differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
        return len(a) - (differ.bit_length() + 7) // 8

    def add(self, string: bytes, row: int) -> None:
        if self.root is None:
            self.root = (None, string, [row])
            return
        node = self.root
        while node[0] is not None:
            branches = node[1]
            node = branches.get(string[node[0]]) or next(iter(branches.values()))
        if node[1] == string:
            node[2].append(row)
            return
        depth = self.common(node[1], string)
        other, leaf = node[1][depth], (None, string, [row])
        above, node = None, self.root
        while node[0] is not None and node[0] < depth:
            above, node = node, node[1][string[node[0]]]
        if node[0] == depth:
            node[1][string[depth]] = leaf
            return
        split = (depth, {other: node, string[depth]: leaf})
        if above is None:
            self.root = split
        else:
            above[1][string[above[0]]] = split

    def leaves(self) -> list[list[int]]:
        """Rows with equal strings, in the strings' order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                out.append(node[2])
            else:
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
        return out


def repeated(regions: list[bytes], units: list[int], length: int) -> list[np.ndarray]:
    """Per region, the places of windows that occur more than once among the
    regions of the same unit."""
    raw = b"".join(regions) + bytes(8)
    data = np.frombuffer(raw, np.uint8)
    sizes = np.array([len(r) for r in regions])
    starts = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - length + 1, 0)
    region = np.repeat(np.arange(len(regions)), windows)
    at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    at += starts[region]
    group = np.array(units)[region]
    live = np.arange(len(at))
    for depth in range(0, SHALLOW, 8):
        if not len(live):
            break
        key = np.zeros(len(live), np.uint64)
        for k in range(8):
            key = (key << np.uint64(8)) | data[at[live] + depth + k]
        order = np.lexsort((key, group[live]))
        live, key = live[order], key[order]
        g = group[live]
        new = np.ones(len(live), bool)
        new[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1])
        number = np.cumsum(new) - 1
        group[live] = number
        live = live[np.bincount(number)[number] > 1]
    again = np.zeros(len(at), bool)
    if len(live):
        edges = np.flatnonzero(np.diff(group[live], prepend=-1, append=-1))
        places = at[live].tolist()
        rows = live.tolist()
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            trie = BlindTrie()
            for i in range(a, b):
                p = places[i]
                trie.add(raw[p + SHALLOW : p + length], rows[i])
            for leaf in trie.leaves():
                if len(leaf) > 1:
                    again[leaf] = True
    return [
        np.flatnonzero(a) for a in np.split(again, np.cumsum(windows)[:-1])
    ] if len(regions) else []


def spans_of(places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged byte spans of sorted window places: overlapping or touching ones
    are one span."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > length)
    first = places[np.concatenate([[0], cut + 1])]
    last = places[np.concatenate([cut, [len(places) - 1]])] + length
    return list(zip(first.tolist(), last.tolist()))


RUN = "anchor long, region long, key binary, first long, last long, times_last long, times long"


def all_runs(keyed: DataFrame, length: int) -> DataFrame:
    """The runs of all texts. Runs of one text that follow each other with the
    same bytes (a repeated sign or line) are one row with their number."""

    def read(batches):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            pieces, owner, base = [], [], []
            for d, raw in enumerate(raw_texts(batch.column(1))):
                for a in range(0, max(len(raw or b"") - length + 1, 0), PIECE):
                    pieces.append(raw[a : a + PIECE + length - 1])
                    owner.append(d)
                    base.append(a)
            for i, j in text_slices(pieces, PIECE):
                part = pieces[i:j]
                rows: list[list] = []
                text, first, last, anchor, h = runs_of(part, length)
                signed = h.view(np.int64).tolist()
                digest = hashlib.blake2b
                before = None
                for t, p, q, a, x in zip(
                    text.tolist(), first.tolist(), last.tolist(), anchor.tolist(), signed
                ):
                    region = int.from_bytes(
                        digest(part[t][p : q + length], digest_size=8).digest(), "big", signed=True
                    )
                    same = (t, x, region)
                    if same == before:
                        rows[-1][5] = q + base[i + t]
                        rows[-1][6] += 1
                        continue
                    before = same
                    shift = base[i + t]
                    rows.append([x, region, keys[owner[i + t]], p + shift, q + shift, q + shift, 1])
                kinds = [pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * 4
                columns = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=[c.split()[0] for c in RUN.split(", ")],
                )

    return keyed.select("key", "text").mapInArrow(read, RUN)


def bins_of(raw: bytes, length: int) -> list[tuple[int, int, int, int]]:
    """(first and last window, start of the core, its distance to the anchor) of
    the bins of a run. Bins are laid by the windows' distance to the anchor, so
    equal windows of two runs are in equal bins; a bin's core are the
    ``length - BIN + 1`` bytes that all its windows hold."""
    h = gram_hashes(np.frombuffer(raw[:length], np.uint8))
    places = np.arange(len(h), dtype=np.uint64)
    anchor = int(((h & ~np.uint64((1 << 24) - 1)) | places).argmin())
    windows = len(raw) - length + 1
    out = []
    for k in range((anchor - windows + 1) // BIN, anchor // BIN + 1):
        first = max(anchor - BIN * k - BIN + 1, 0)
        last = min(anchor - BIN * k, windows - 1)
        out.append((first, last, anchor - BIN * k, BIN * k))
    return out


def repeated_in_bins(hot: DataFrame, length: int) -> DataFrame:
    """(anchor, region, from, to): repeated windows of runs whose anchor is too
    frequent for one task. Runs are cut into bins. Bins without another of the
    same core repeat nothing, bins with the same bytes repeat as a whole and count
    as one; only where bins differ around a common core, at the ends of a
    passage, are windows dealt out one by one, by their bytes."""

    def digest(data: bytes) -> bytes:
        return hashlib.blake2b(data, digest_size=16).digest()

    def batch_of(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(kinds)
        arrays = [pa.array(c, k) for c, (_, k) in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in kinds])

    run = [("anchor", pa.int64()), ("region", pa.int64())]
    spans = [*run, ("from", pa.int64()), ("to", pa.int64())]

    def cut(batches):
        kinds = [*spans, ("core", pa.binary()), ("piece", pa.binary())]
        for batch in batches:
            rows = []
            for anchor, region, raw in zip(*(c.to_pylist() for c in batch.columns)):
                for first, last, start, away in bins_of(raw, length):
                    core = digest(raw[start : start + length - BIN + 1] + b"%d" % away)
                    piece = digest(raw[first : last + length] + b"%d %d" % (start - first, start - last))
                    rows.append((anchor, region, first, last, core, piece))
            yield batch_of(rows, kinds)

    bins = share(
        hot.mapInArrow(
            cut, "anchor long, region long, from long, to long, core binary, piece binary"
        )
    )
    by_piece = share(
        bins.groupBy("core", "piece").agg(
            F.count("*").alias("n"), F.min(F.struct("anchor", "region", "from", "to")).alias("at")
        )
    )
    whole = bins.join(by_piece.where("n > 1").select("core", "piece"), ["core", "piece"])
    differing = by_piece.groupBy("core").count().where("count > 1").select("core")
    cuts = by_piece.join(differing, "core").select("core", "piece", "n", "at.*")

    def windows(batches):
        kinds = [*run, ("core", pa.binary()), ("single", pa.bool_()), ("from", pa.int64()), ("code", pa.binary())]
        for batch in batches:
            rows = []
            for anchor, region, raw, core, n, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [
                    (anchor, region, core, n == 1, i, digest(raw[i : i + length]))
                    for i in range(first, last + 1)
                ]
            yield batch_of(rows, kinds)

    single = (
        cuts.join(hot, ["anchor", "region"])
        .select("anchor", "region", "bytes", "core", "n", "from", "to")
        .mapInArrow(
            windows,
            "anchor long, region long, core binary, single boolean, from long, code binary",
        )
    )
    single = share(single)
    twice = single.groupBy("core", "code").count().where("count > 1").select("core", "code")
    alone = single.where("single").join(twice, ["core", "code"])
    return whole.select("anchor", "region", "from", "to").union(
        alone.select("anchor", "region", "from", F.col("from").alias("to"))
    )


def repeated_windows(keyed: DataFrame, length: int, most_runs: int) -> DataFrame:
    """(key, first, last): window starts of the text with that key that occur
    elsewhere, as ranges. Equal texts have equal keys and are read once each."""
    runs = share(all_runs(keyed, length))
    by_region = runs.groupBy("anchor", "region").agg(
        F.sum("times").alias("n"), F.min(F.struct("key", "first", "last")).alias("at")
    )
    by_region = share(by_region)
    by_anchor = by_region.groupBy("anchor").agg(F.count("*").alias("regions"))
    differing = by_region.join(by_anchor.where("regions > 1"), "anchor")
    wanted = differing.groupBy("at.key").agg(
        F.collect_list(F.struct("anchor", "region", "regions", "at.first", "at.last")).alias("cuts")
    )

    def cut(batches):
        for batch in batches:
            rows = []
            texts = raw_texts(batch.column(0))
            for raw, cuts in zip(texts, batch.column(1).to_pylist()):
                rows += [
                    (c["anchor"], c["region"], c["regions"], raw[c["first"] : c["last"] + length])
                    for c in cuts
                ]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["anchor", "region", "regions", "bytes"],
            )

    regions = share(
        keyed.join(wanted, "key")
        .select("text", "cuts")
        .mapInArrow(cut, "anchor long, region long, regions long, bytes binary")
        .dropDuplicates(["anchor", "region"])
    )

    def sort(batches):
        """Rows come sorted by anchor; an anchor may go over several batches."""
        open_rows: list[tuple[int, int, bytes]] = []

        def done(rows):
            units = np.unique([r[0] for r in rows], return_inverse=True)[1].tolist()
            found = repeated([r[2] for r in rows], units, length)
            out = [
                (r[0], r[1], first, end - 1)
                for r, places in zip(rows, found)
                for first, end in spans_of(places, 1)
            ]
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["anchor", "region", "from", "to"],
            )

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                if len(open_rows) >= SORTED_RUNS and row[0] != open_rows[-1][0]:
                    yield done(open_rows)
                    open_rows = []
                open_rows.append(row)
        if open_rows:
            yield done(open_rows)

    found_kind = "anchor long, region long, from long, to long"
    small = regions.where(F.col("regions") <= most_runs).select("anchor", "region", "bytes")
    sorted_out = (
        small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort, found_kind)
    )

    hot = regions.where(F.col("regions") > most_runs).select("anchor", "region", "bytes")
    found = share(sorted_out.union(repeated_in_bins(hot, length)))

    # Runs with copies repeat as a whole, others where the sorting found it.
    known = runs.join(by_region.where("n > 1").select("anchor", "region"), ["anchor", "region"])
    whole = known.select("key", "first", F.col("times_last").alias("last"))
    single_runs = by_region.where("n = 1").select("anchor", "region", "at")
    parts = found.join(single_runs, ["anchor", "region"]).select(
        F.col("at.key").alias("key"),
        (F.col("at.first") + F.col("from")).alias("first"),
        (F.col("at.first") + F.col("to")).alias("last"),
    )
    return whole.union(parts)


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = LENGTH, most_runs: int = MOST_RUNS
) -> DataFrame:
    """Every row with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (of
    removed bytes, merged), ``kept_sha256`` (of the bytes that remain) and
    ``text`` without them; bytes left over from a cut character go as well.

    A byte is removed if some string of ``length`` bytes of its text covers it
    and starts at another place too, in this or another text, overlapping or
    not. So texts that occur twice lose all such bytes. Null is read as empty and
    stays null; shorter texts lose nothing. Repeated rows repeat each other. Texts
    are read whole, in overlapping pieces if long. An empty table stays empty.
    Input columns with the names of the results are replaced.
    """
    made = ["n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"]
    kept = [c for c in docs.columns if c not in [*made, text]]
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(f"__{c}") for c in kept],
        F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("key"),
        F.col(text).alias("text"),
    )
    found = repeated_windows(keyed.select("key", "text"), length, most_runs)
    per_text = found.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    schema = pa.schema(
        [
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
            ("kept_sha256", pa.string()),
            ("text", pa.string()),
        ]
    )

    def clear(texts: pa.Array, found: pa.Array) -> list:
        rows = []
        for raw, ranges in zip(raw_texts(texts), found.to_pylist()):
            spans: list[list[int]] = []
            for r in sorted(ranges or (), key=lambda r: r["first"]):
                if spans and r["first"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r["last"] + length)
                else:
                    spans.append([r["first"], r["last"] + length])
            data, at, left = raw or b"", 0, []
            for a, b in spans:
                left.append(data[at:a])
                at = b
            rest = b"".join([*left, data[at:]])
            rows.append(
                (
                    len(data),
                    len(data) - len(rest),
                    len(spans),
                    [{"first": a, "end": b} for a, b in spans],
                    hashlib.sha256(rest).hexdigest(),
                    # A cut can leave part of a character on either side: parts
                    # are decoded one by one, so they cannot make up a new one.
                    None
                    if raw is None
                    else "".join(p.decode("utf-8", "ignore") for p in [*left, data[at:]]),
                )
            )
        return [list(x) for x in zip(*rows)] if rows else [[] for _ in schema]

    out = annotate(keyed.join(per_text, "key", "left"), ["text", "found"], clear, schema)
    return out.select(
        *[F.col(f"`__{c}`").alias(c) for c in kept], *made, F.col("text").alias(text)
    )
