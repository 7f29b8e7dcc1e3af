"""Alignment of two tokenizers over the same bytes.

Tokenizer A is a byte-level BPE (``tokenizers`` JSON), B a BPE with byte fallback
(``sentencepiece`` model, which puts a space before a text). Each text, with that
space, is a range of bytes that both cut into tokens. Where both cut, a group of
tokens of A and B ends; a token of A and one of B are linked if their bytes
overlap. Cuts come from the libraries' spans: A tells characters, B's proto tells
bytes. Spans that overlap (a character of several tokens, byte fallback) are cut
anew by the tokens' decoded bytes.

A text is encoded in segments: neither tokenizer has a token across a single space
between two visible characters (checked on load), so a cut before such a space is
a cut of both, and the text's groups are those of its segments, one after the
other. Segments that return (most words do) are encoded once per task. The counts
of linked ids over all texts are added up by Spark; they come back to the
texts as a table of the most frequent pairs, sent to tasks, and by a join for all
others.
"""

from __future__ import annotations

import dataclasses
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stallbook.llm.common import annotate, raw_texts
from stallbook.operators.shared import share

TOKENIZERS = "/opt/tokenizers"
#: Pairs whose counts are sent to every task (17 bytes each); others are joined.
FREQUENT = 2**18
#: A task forgets its segments beyond so many, or so many links of them.
REMEMBERED, LINKS_HELD = 300_000, 2**22
#: Characters of parts that are encoded by one call.
RUN = 4096
#: Characters of a text that are encoded at a time, at the next safe cut.
STRETCH = 2**18
#: Distinct pairs that a task adds up before it hands them on.
PAIRS_HELD = 2**21

# Some libraries take these for white space too, so no safe neighbours of a cut.
_VISIBLE = r"[^\s\u180e\u200b\u2060\ufeff]"
SPACES = {c for c in map(chr, range(0x10000)) if not re.match(_VISIBLE, c)}
SAFE_CUT = re.compile(f"(?<={_VISIBLE}) (?={_VISIBLE})")


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself where
    it is a visible character of Latin-1, the next free one from 256 on elsewhere."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def decoded_entry(entry: str, alphabet: dict[str, int]) -> bytes:
    return b"".join(
        bytes([alphabet[c]]) if c in alphabet else c.encode() for c in entry
    )


@dataclasses.dataclass(frozen=True)
class Pair:
    """The two tokenizers' files, as read on the driver: a few MB, sent to tasks."""

    a_json: bytes
    b_model: bytes

    @staticmethod
    def load(folder: str = TOKENIZERS, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> Pair:
        return Pair(Path(folder, a).read_bytes(), Path(folder, b).read_bytes())


def token_ends(ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes, from the ends of the libraries' spans and
    the lengths of the decoded tokens. A span's end is a cut if all tokens up to
    it hold as many bytes. Others (several tokens of one character have the same
    span) lie behind the cut before them by their own lengths."""
    by_length = np.cumsum(lengths)
    firm = ends == by_length
    if firm.all():
        return ends
    at = np.flatnonzero(firm)
    run = np.searchsorted(at, np.arange(len(ends)))  # how many cuts lie before a token
    before = np.concatenate([[0], ends[at]])[run]
    first = np.concatenate([[0], by_length[at]])[run]
    return np.where(firm, ends, before + by_length - first)


def _flattened(lists: list[list[int]], count: np.ndarray) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, count.sum())


def expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All indices of ranges that start at ``starts`` and have ``sizes`` entries."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@dataclasses.dataclass
class Tokens:
    """What the libraries say of some runs of parts."""

    runs: list[list[str]]
    raws: list[bytes]
    a_ids: list[list[int]]
    #: in characters
    a_ends: list[list[int]]
    b_ids: list[list[int]]
    #: in bytes, without the space before the text
    b_ends: list[list[int]]


@dataclasses.dataclass
class Encoded:
    """Parts with their sizes (n_a, n_b, n_groups, n_links), all links, the text of
    their groups; and, for parts that their tokens do not give back, what B's
    tokens hold: these have no tokens."""

    parts: list[str]
    sizes: np.ndarray
    links: np.ndarray
    groups: list[str]
    other: dict[str, bytes]

    def __add__(self, more: Encoded) -> Encoded:
        return Encoded(
            self.parts + more.parts,
            np.concatenate([self.sizes, more.sizes]),
            np.concatenate([self.links, more.links]),
            self.groups + more.groups,
            self.other | more.other,
        )


class Segments:
    """What is known of the segments met so far, by number."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        #: n_a, n_b, n_groups, n_links
        self.sizes = np.empty((0, 4), np.int64)
        #: a * size of B + b of every link; where each segment's start
        self.links, self.starts = np.empty(0, np.int64), np.empty(0, np.int64)
        #: segments that their tokens do not give back
        self.odd: set[int] = set()
        #: how often each was met since some were last forgotten
        self.uses = np.empty(0, np.int64)

    def add(self, made: Encoded) -> None:
        first = len(self.groups)
        self.known.update(zip(made.parts, range(first, first + len(made.parts))))
        starts = len(self.links) + np.cumsum(made.sizes[:, 3]) - made.sizes[:, 3]
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, made.sizes])
        self.links = np.concatenate([self.links, made.links])
        self.groups.extend(made.groups)
        self.odd.update(self.known[p] for p in made.other)
        self.uses = np.concatenate([self.uses, np.zeros(len(made.parts), np.int64)])

    def forget(self) -> None:
        """Keep what was met more than once, at most half of the room."""
        if len(self.groups) <= REMEMBERED and len(self.links) <= LINKS_HELD:
            return
        order = np.argsort(-self.uses, kind="stable")
        order = order[self.uses[order] > 1][: REMEMBERED // 2]
        room = np.cumsum(self.sizes[order, 3]) <= LINKS_HELD // 2
        kept = np.sort(order[room])
        names = list(self.known)  # in the order of their numbers
        self.known = {names[i]: k for k, i in enumerate(kept.tolist())}
        self.groups = [self.groups[i] for i in kept.tolist()]
        self.odd = {k for k, i in enumerate(kept.tolist()) if i in self.odd}
        self.sizes = self.sizes[kept]
        size = self.sizes[:, 3]
        self.links = self.links[expanded(self.starts[kept], size)]
        self.starts = np.cumsum(size) - size
        self.uses = np.zeros(len(kept), np.int64)


class Aligner:
    """Both tokenizers and the segments met so far."""

    def __init__(self, pair: Pair):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(pair.a_json)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = decoded_entry(entry, alphabet)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pair.b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_lengths = np.array([len(x) for x in self.a_bytes])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])
        self.size_b = len(pieces)
        rules = json.loads(pair.a_json)
        words = rules.get("pre_tokenizer") or {}
        self.can_cut = (
            rules.get("normalizer") is None
            and words.get("type") == "ByteLevel"
            and words.get("use_regex", True)
            and not words.get("add_prefix_space", True)
            and not any(re.search("[^\u2581]\u2581", p) for p in pieces)
        )
        # an id with what follows it in the text of the groups
        self.a_text = _id_texts(len(self.a_bytes), ",|")
        self.b_text = _id_texts(len(self.b_bytes), ",;\n")
        self.segments = Segments()

    def cut(self, text: str) -> list[str]:
        """The parts of a text, without the space that stands before each."""
        return SAFE_CUT.split(text) if self.can_cut else [text]

    def stretches(self, text: str) -> Iterator[str]:
        """A long text in pieces of about ``STRETCH`` characters, cut like parts."""
        start = 0
        while self.can_cut and len(text) - start > STRETCH:
            found = SAFE_CUT.search(text, start + STRETCH)
            if not found:
                break
            yield text[start : found.start()]
            start = found.end()
        yield text[start:]

    def _runs(self, parts: list[str]) -> list[list[str]]:
        """Parts that are encoded as one text, since a cut between them is safe:
        fewer and longer calls. Parts with white space at an end stand alone."""
        runs, size = [], RUN
        for p in parts:
            plain = self.can_cut and not (p[0] in SPACES or p[-1] in SPACES)
            if plain and size < RUN:
                runs[-1].append(p)
            else:
                runs.append([p])
                size = 0
            size = size + len(p) if plain else RUN
        return runs

    def encode(self, parts: list[str], together: bool = True) -> Encoded:
        """Sizes, links and groups of some parts, in an order of its own."""
        runs = self._runs(parts) if together else [[p] for p in parts]
        texts = [" ".join(r) for r in runs]
        a = self.a.encode_batch([f" {t}" for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, return_type="proto", num_threads=1)
        good = Tokens([], [], [], [], [], [])
        alone: list[str] = []
        other: list[tuple[str, bytes]] = []
        for run, text, x, y in zip(runs, texts, a, b):
            raw, a_ids = b" " + text.encode(), x.ids
            pieces = list(y.pieces)  # each of its items is made anew when read
            b_ids = [p.id for p in pieces]
            held = b"".join(map(self.b_bytes.__getitem__, b_ids))
            fits = b"".join(map(self.a_bytes.__getitem__, a_ids)) == raw
            if fits and held == raw:
                good.runs.append(run)
                good.raws.append(raw)
                good.a_ids.append(a_ids)
                good.a_ends.append([e for _, e in x.offsets])
                good.b_ids.append(b_ids)
                good.b_ends.append([p.end for p in pieces])
            elif len(run) > 1:
                alone.extend(run)
            else:
                # A gives every byte back, unless its vocabulary lacks some: then nothing fits
                other.append((text, held if fits else b""))
        done = self._aligned(good)
        if alone:
            done = done + self.encode(alone, together=False)
        return done + Encoded(
            [t for t, _ in other],
            np.zeros((len(other), 4), np.int64),
            np.empty(0, np.int64),
            [""] * len(other),
            dict(other),
        )

    def _aligned(self, tokens: Tokens) -> Encoded:
        """Several runs at once, as one range of bytes: every part's end is a cut."""
        if not tokens.runs:
            return Encoded([], np.zeros((0, 4), np.int64), np.empty(0, np.int64), [], {})
        parts = list(chain.from_iterable(tokens.runs))
        whole = np.frombuffer(b"".join(tokens.raws), np.uint8)
        lengths = np.array([len(r) for r in tokens.raws])
        starts = np.cumsum(lengths) - lengths
        heads = (whole & 0xC0) != 0x80  # first bytes of characters
        place = np.append(np.flatnonzero(heads), len(whole))
        characters = np.cumsum(heads)[starts] - 1  # characters before each run

        count = np.array([len(x) for x in tokens.a_ids])
        a_ids = _flattened(tokens.a_ids, count)
        a_ends = place[_flattened(tokens.a_ends, count) + np.repeat(characters, count)]
        a_ends = token_ends(a_ends, self.a_lengths[a_ids])
        count = np.array([len(x) for x in tokens.b_ids])
        b_ids = _flattened(tokens.b_ids, count)
        b_ends = _flattened(tokens.b_ends, count) + 1 + np.repeat(starts, count)
        b_ends = token_ends(b_ends, self.b_lengths[b_ids])

        cuts = np.union1d(a_ends, b_ends)
        of_a, of_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        links = a_ids[of_a] * self.size_b + b_ids[of_b]
        both = cuts[(a_ends[of_a] == cuts) & (b_ends[of_b] == cuts)]
        part_ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        if not np.isin(part_ends, both).all():
            raise ValueError("a token reaches over a safe cut: these tokenizers need whole texts")
        ends = (a_ends, b_ends, both, cuts)
        sizes = np.stack(
            [np.diff(np.searchsorted(e, part_ends, "right"), prepend=0) for e in ends], axis=1
        )
        # ids in the order of the text: a group's tokens of A, then those of B
        group_a, group_b = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        b_before = np.concatenate([[0], np.searchsorted(b_ends, both, "right")])
        a_upto = np.searchsorted(a_ends, both, "right")
        follows_a = (both[group_a] == a_ends).astype(np.int64)
        follows_b = (both[group_b] == b_ends).astype(np.int64)
        follows_b[np.searchsorted(b_ends, part_ends)] = 2
        out = np.empty(len(a_ids) + len(b_ids), object)
        out[np.arange(len(a_ids)) + b_before[group_a]] = self.a_text[a_ids, follows_a]
        out[np.arange(len(b_ids)) + a_upto[group_b]] = self.b_text[b_ids, follows_b]
        return Encoded(parts, sizes, links, "".join(out.tolist()).split("\n")[:-1], {})

    def _numbers(self, parts: list[str]) -> np.ndarray:
        """The segment of each part; those not met yet are encoded."""
        s = self.segments
        at = np.fromiter(map(s.known.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [parts[i] for i in missing.tolist()]
            s.add(self.encode(list(dict.fromkeys(new))))
            at[missing] = np.fromiter(map(s.known.__getitem__, new), np.int64, len(new))
        return at

    def _batches(self, texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
        """Parts of all texts with the text's number, about ``STRETCH`` characters
        at a time."""
        rows, parts, size = [], [], 0
        for row, text in enumerate(texts):
            for stretch in self.stretches(text) if text else ():
                cut = self.cut(stretch)
                rows.extend([row] * len(cut))
                parts.extend(cut)
                size += len(stretch)
                if size >= STRETCH:
                    yield rows, parts
                    rows, parts, size = [], [], 0
        if parts:
            yield rows, parts

    def texts(self, raws: list[bytes | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For all texts: sizes and groups; then row * all pairs + pair, and how
        often the pair is linked in that row."""
        texts = [r.decode("utf-8", "replace") if r else "" for r in raws]
        texts = [
            "" if "\ufffd" in t and t.encode() != r else t for t, r in zip(texts, raws)
        ]
        n, space = len(texts), len(self.a_bytes) * self.size_b
        total = np.zeros((n, 4), np.int64)
        groups: list[list[str]] = [[] for _ in texts]
        keys, times, odd = [], [], set()
        for row_list, parts in self._batches(texts):
            rows, at = np.array(row_list), self._numbers(parts)
            s, uses_at = self.segments, at
            if s.odd:
                odd.update(rows[np.isin(at, list(s.odd))].tolist())
            np.add.at(total, rows, s.sizes[at])
            numbers, edges = at.tolist(), np.flatnonzero(np.diff(rows, prepend=-1)).tolist()
            for a, b in zip(edges, [*edges[1:], len(numbers)]):
                groups[row_list[a]].append(";".join([s.groups[i] for i in numbers[a:b]]))
            used, count = np.unique(rows * len(s.groups) + at, return_counts=True)
            row, at = used // len(s.groups), used % len(s.groups)
            size = s.sizes[at, 3]
            pairs = s.links[expanded(s.starts[at], size)]
            found = merged([np.repeat(row, size) * space + pairs], [np.repeat(count, size)])
            keys.append(found[0])
            times.append(found[1])
            s.uses += np.bincount(uses_at, minlength=len(s.groups))
            s.forget()
        key, time = merged(keys, times)
        joined = [";".join(g) for g in groups]
        for row in odd:
            keep = key // space != row
            key, time, total[row], joined[row] = key[keep], time[keep], 0, ""
            if self._same_bytes(texts[row]):
                whole = self.encode([texts[row]])
                total[row], joined[row] = whole.sizes[0], whole.groups[0]
                links = row * space + whole.links
                key, time = merged([key, links], [time, np.ones_like(links)])
        return total, joined, key, time

    def _same_bytes(self, text: str) -> bool:
        """Whether all of B's tokens hold the text, though some segment's do not."""
        raw, at = b" " + text.encode(), 0
        for stretch in self.stretches(text):
            for part in self.cut(stretch):
                held = self.encode([part]).other.get(part, b" " + part.encode())
                if not raw.startswith(held, at):
                    return False
                at += len(held)
        return at == len(raw)


def _id_texts(size: int, follow: str) -> np.ndarray:
    out = np.empty((size, len(follow)), object)
    for j, c in enumerate(follow):
        out[:, j] = [f"{i}{c}" for i in range(size)]
    return out


def merged(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, and the sum of their times."""
    if not pairs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found, place = np.unique(np.concatenate(pairs), return_inverse=True)
    # sums of whole numbers below 2^53: exact
    return found, np.bincount(place, np.concatenate(times), len(found)).astype(np.int64)


_ready: dict[str, Aligner] = {}


def _aligner(pair) -> Aligner:
    """The tokenizers of this Python worker; loading them takes some time."""
    if "aligner" not in _ready or _ready["aligner"][0] != pair.value:
        _ready["aligner"] = (pair.value, Aligner(pair.value))
    return _ready["aligner"][1]


TOKENS = pa.schema(
    [
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int64())),
    ]
)


def encode(df: DataFrame, text: str = "text", pair: Pair | None = None) -> DataFrame:
    """Tokens and their alignment for each row: ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``; ``groups`` as ids of A and B (``a1,a2|b1;a3|b2,b3``); the distinct
    linked ``pairs`` (a * size of B + b) and how many ``times`` each is linked.

    Null and empty texts, texts that are no UTF-8, and texts that a tokenizer's
    tokens do not give back byte by byte (B reads U+2581 as a space) have no
    tokens. A long text is encoded in stretches, unless it has no place to cut.
    """
    shared = df.sparkSession.sparkContext.broadcast(pair or Pair.load())
    names = TOKENS.names

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        aligner = _aligner(shared)
        space = len(aligner.a_bytes) * aligner.size_b
        for column in columns:
            total, groups, key, time = aligner.texts(raw_texts(column))
            starts = pa.array(np.searchsorted(key, np.arange(len(groups) + 1) * space), pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(x)) for x in (key % space, time)]
            arrays = [*[pa.array(c) for c in total.T], pa.array(groups, pa.string()), *lists]
            yield pa.StructArray.from_arrays(arrays, names=names)

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    replaced = {n.lower() for n in names}
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c.lower() not in replaced]
    made = F.arrow_udf(run, returnType=from_arrow_schema(TOKENS))
    out = df.select(*kept, made(F.col(f"`{text}`")).alias("__made"))
    return out.select(*kept, *[f"__made.{n}" for n in names])


def _size_b(pair: Pair) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=pair.b_model).get_piece_size()


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Entries of a list column and where each row's start."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return values, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def link_counts(encoded: DataFrame) -> DataFrame:
    """(pair, n): links of each id pair over all rows. Tasks add up what they
    read, at most ``PAIRS_HELD`` pairs at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times, held = [], [], 0

        def out() -> pa.RecordBatch:
            found = merged(pairs, times)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["pair", "n"])

        for batch in batches:
            # a batch may hold many long rows: add up in between
            values, count = _flat(batch.column(0))[0], _flat(batch.column(1))[0]
            found = merged([values], [count])
            pairs.append(found[0])
            times.append(found[1])
            held += len(found[0])
            if held > PAIRS_HELD:
                first = merged(pairs, times)
                pairs, times, held = [first[0]], [first[1]], len(first[0])
                if held > PAIRS_HELD // 2:
                    yield out()
                    pairs, times, held = [], [], 0
        if held:
            yield out()

    partial = encoded.select("pairs", "times").mapInArrow(run, "pair long, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


@dataclasses.dataclass(frozen=True)
class Frequent:
    """The most frequent pairs, sorted, with their counts; a pair is ``best`` if no
    pair with the same id of B has a higher count."""

    pairs: np.ndarray
    n: np.ndarray
    best: np.ndarray


def _least_count(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs reach it."""
    sizes = counts.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()
    left = most
    for r in sorted(sizes, key=lambda r: -r.bits):
        left -= r["count"]
        if left < 0:
            return 2**r.bits
    return 1


def link_totals(encoded: DataFrame, size_b: int, most: int = FREQUENT) -> DataFrame:
    """Rows of ``encoded`` (stored: it is read three times), without ``pairs`` and
    ``times``, with ``count_sum``, the sum of all links' counts, and ``n_best``, the
    number of links that are the most frequent of their id of B (ties too).

    The highest count of each id of B is one number for each piece of its
    vocabulary. Pairs that are not among the ``most`` frequent ones have low
    counts, so none of them is a hot key of the join.
    """
    spark: SparkSession = encoded.sparkSession
    counts = share(link_counts(encoded))
    tops = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("n")).toArrow()
    top = np.zeros(size_b, np.int64)
    top[tops["b"].to_numpy()] = tops["n"].to_numpy()
    least = _least_count(counts, most)
    high = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(high["pair"].to_numpy())
    pairs, n = high["pair"].to_numpy()[order], high["n"].to_numpy()[order]
    sent = spark.sparkContext.broadcast(Frequent(pairs, n, n == top[pairs % size_b]))
    tops_sent = spark.sparkContext.broadcast(top)

    def look_up(pair_lists: pa.Array, time_lists: pa.Array) -> list[pa.Array]:
        table = sent.value
        values, starts = _flat(pair_lists)
        count, _ = _flat(time_lists)
        if len(table.pairs):
            at = np.minimum(np.searchsorted(table.pairs, values), len(table.pairs) - 1)
            known = table.pairs[at] == values
            n, best = table.n[at] * known, table.best[at] & known
        else:
            known = best = np.zeros(len(values), bool)
            n = np.zeros(len(values), np.int64)

        def by_row(x: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(x)])
            return total[starts[1:]] - total[starts[:-1]]

        rare = ~known
        places = np.concatenate([[0], np.cumsum(by_row(rare.astype(np.int64)))]).astype(np.int32)
        return [
            pa.array(by_row(n * count)),
            pa.array(by_row(best * count)),
            pa.ListArray.from_arrays(pa.array(places), pa.array(values[rare])),
            pa.ListArray.from_arrays(pa.array(places), pa.array(count[rare])),
        ]

    def is_best(pair: pa.Array, n: pa.Array) -> list[np.ndarray]:
        return [pa.array(n.to_numpy() == tops_sent.value[pair.to_numpy() % size_b])]

    rare_lists = pa.list_(pa.int64())
    found = pa.schema(
        [("_sum", pa.int64()), ("_best", pa.int64()), ("_pairs", rare_lists), ("_times", rare_lists)]
    )
    at = "_at"
    while at.lower() in {c.lower() for c in encoded.columns}:
        at = f"_{at}"
    looked_up = annotate(encoded, ["pairs", "times"], look_up, found).drop("pairs", "times")
    # a row's number in the stored table changes with the reading, so give one and store it
    numbered = share(looked_up.withColumn(at, F.monotonically_increasing_id()))
    low = annotate(
        counts.where(F.col("n") < least), ["pair", "n"], is_best, pa.schema([("best", pa.bool_())])
    )
    links = numbered.select(
        F.col(at), F.explode(F.arrays_zip("_pairs", "_times")).alias("link")
    ).select(at, F.col("link._pairs").alias("pair"), F.col("link._times").alias("times"))
    more = (
        links.join(low, "pair")
        .groupBy(at)
        .agg(
            F.sum(F.col("n") * F.col("times")).alias("_more"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_more_best"),
        )
    )
    kept = [c for c in numbered.columns if c not in (at, *found.names)]
    return numbered.join(more, at, "left").select(
        *[F.col("`" + c.replace("`", "``") + "`") for c in kept],
        (F.col("_sum") + F.coalesce("_more", F.lit(0))).alias("count_sum"),
        (F.col("_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
    )


def align(
    df: DataFrame, text: str = "text", pair: Pair | None = None, most: int = FREQUENT
) -> DataFrame:
    """Rows of ``df`` without the text, with ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups_sha256`` (empty without tokens), ``count_sum`` and
    ``n_best``; see :func:`encode` and :func:`link_totals`. Columns of ``df`` with
    these names, or with those that :func:`encode` adds, are replaced. Nulls in
    other columns, equal rows and equal ids are kept as they are; an empty table
    gives an empty one.
    """
    pair = pair or Pair.load()
    taken = ("groups_sha256", "count_sum", "n_best", "_sum", "_best", "_pairs", "_times")
    df = df.drop(*[c for c in df.columns if c.lower() in taken])
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    encoded = encode(df, text, pair).withColumn("groups_sha256", digest).drop("groups", text)
    return link_totals(share(encoded), _size_b(pair), most)
