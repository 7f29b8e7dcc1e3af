"""Quality classifier by compression: zstandard dictionaries are built from good
and from bad labelled text; how much better the one or the other shortens a
piece of text becomes a calibrated score."""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import annotate, raw_texts

#: Text is compressed in pieces of so many bytes.
PIECE = 1024
LEVEL = 3
DICTIONARY_BYTES = 65_536
#: Labelled documents of each label that are learned from, at most.
SAMPLE_ROWS = 3000
#: Pieces of a sampled document that are learned from, at most, evenly spread.
SAMPLE_PIECES = 16
#: Share of its bytes that an empty text is taken to shrink to.
EMPTY_SIZE = 0.6
FEATURES = 6


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]
    middle: list[float]
    spread: list[float]


def pieces(raw: bytes) -> list[bytes]:
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


class Sizes:
    """Normalised differences of compressed sizes of a text's pieces."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = [self.compressor(good), self.compressor(bad)]

    @staticmethod
    def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=data, write_content_size=False, write_dict_id=False
        )

    def features(self, raw: bytes | None) -> tuple[float, ...]:
        """Over all pieces: mean, smallest and largest difference of the two
        sizes, each divided by the piece's bytes (above 0: the bad dictionary
        shortens it more); mean and smallest size by bytes, since text that
        repeats itself shrinks under either; and how short the text is, since
        the sizes of a short one say little."""
        if not raw:
            return 0.0, 0.0, 0.0, EMPTY_SIZE, EMPTY_SIZE, 1.0
        total = whole = 0
        low, high, least = 1e9, -1e9, 1e9
        good, bad = (c.compress for c in self.by)
        for p in pieces(raw):
            size = len(good(p))
            d = size - len(bad(p))
            total += d
            whole += size
            # A short last piece says little: it counts as if it were longer.
            d /= max(len(p), PIECE // 4)
            low, high = min(low, d), max(high, d)
            least = min(least, size / len(p))
        n = len(raw)
        return total / n, low, high, whole / n, least, 1 / (1 + n / 100)


def fitted(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w
        )
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(rows: list[tuple[int, list[bytes]]]) -> Model:
    """A model from (label, pieces) rows. Half of the rows give the
    dictionaries, the other half the calibration, since a dictionary shortens
    the text that it was built from more than any other. For the same reason the
    words of a piece are shuffled first: a passage that a bad and a good text
    share should not make the good one bad."""
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    order = random.Random(5)
    for label, parts in rows[::2]:
        for p in parts:
            words = p.split(b" ")
            order.shuffle(words)
            samples[label].append(b" ".join(words))
    books = {}
    for label in (0, 1):
        parts = samples[label] or [b"\n"]
        try:
            books[label] = zstandard.train_dictionary(
                min(DICTIONARY_BYTES, max(1024, sum(map(len, parts)) // 8)), parts
            ).as_bytes()
        except zstandard.ZstdError:  # too little text for the trainer
            books[label] = b"".join(parts)[-DICTIONARY_BYTES:].ljust(8, b"\n")
    sizes = Sizes(books[1], books[0])
    rest = rows[1::2] or rows
    x = np.array([sizes.features(b"".join(p)) for _, p in rest]).reshape(-1, FEATURES)
    y = np.array([label for label, _ in rest], float)
    if not len(y):
        return Model(books[1], books[0], [0.0] * (FEATURES + 1), [0.0] * FEATURES, [1.0] * FEATURES)
    middle, spread = x.mean(0), x.std(0) + 1e-9
    w = fitted((x - middle) / spread, y)
    return Model(books[1], books[0], w.tolist(), middle.tolist(), spread.tolist())


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> Model:
    """Learn from at most ``SAMPLE_ROWS`` rows of each label (0 or 1; others and
    null are left out) whose document has a text, those with the smallest hash
    of ``key``, and from at most ``SAMPLE_PIECES`` pieces of each, evenly spread
    over its text. The sample is drawn from keys alone and its size is fixed, so
    it is broadcast, no text is shuffled and at most 100 MB reach the driver.
    Without any labelled row the model scores every text 0.5."""
    there = docs.where(f"`{key}` is not null and `{text}` is not null and `{text}` != ''")
    value = F.col(label).cast("int")
    marked = labels.where(value.isin(0, 1)).select(key, value.alias("label"))
    marked = marked.join(there.select(key), key, "left_semi")
    order = (F.xxhash64(F.col(key).cast("string")), F.col(key))
    by_label = [
        marked.where(F.col("label") == v).distinct().orderBy(*order).limit(SAMPLE_ROWS)
        for v in (0, 1)
    ]
    sample = by_label[0].unionByName(by_label[1])

    def cut(batches):
        for batch in batches:
            out = []
            for raw in raw_texts(batch.column(0)):
                p = pieces(raw)
                out.append(p[:: max(1, -(-len(p) // SAMPLE_PIECES))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.binary()))],
                names=["label", "key", "parts"],
            )

    rows = (
        there.join(F.broadcast(sample), key)
        .select(text, "label", F.col(key).cast("string"))
        .mapInArrow(cut, "label int, key string, parts array<binary>")
        .collect()
    )
    rows.sort(key=lambda r: (r.label, r.key, r.parts))
    return learn([(r.label, [bytes(p) for p in r.parts]) for r in rows])


SCHEMA = pa.schema([("score", pa.float64())])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row with ``score`` from 0 to 1; higher: label 1 is likelier.

    The whole text is compressed, piece by piece. Null and empty texts have no
    difference in size and get the score of the shortest texts. Repeated rows get
    equal scores, an empty table stays empty, an input column ``score`` is
    replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    ready: list[Sizes] = []

    def run(column: pa.Array) -> list:
        m = shared.value
        if not ready:
            ready.append(Sizes(m.good, m.bad))
        x = np.array([ready[0].features(t) for t in raw_texts(column)]).reshape(-1, FEATURES)
        z = m.weights[0] + ((x - m.middle) / m.spread) @ np.array(m.weights[1:])
        return [1 / (1 + np.exp(-np.clip(z, -500, 500)))]

    return annotate(df, [text], run, SCHEMA)
