"""Language identification with hyperdimensional profiles: letters get random
vectors of +1 and -1, a trigram is the product (binding) of its letters' vectors
permuted by their place, a text the sum (bundle) of its trigrams, a language the
sum of its training texts; the nearest language by cosine wins."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import annotate, raw_texts, text_slices

DIMENSIONS = 1024
#: Letters of all scripts share so many vectors; number 0 is the word border.
LETTERS = 256
SEED = 20_231
UNDETERMINED = "und"
#: Languages a model can have: what training brings to the driver is at most so
#: many times LETTERS^3 counts, in practice the trigrams that occur.
MOST_LANGUAGES = 1000


def letter_table() -> np.ndarray:
    """Number of the vector for each code point; 0 for what is no letter. Case
    is folded; ASCII letters and the letters of Latin-1 and Latin Extended-A
    have vectors of their own, others share the rest by their code point."""
    table = np.zeros(0x110000, np.int32)
    own: dict[int, int] = {}
    for point in range(0x110000):
        c = chr(point)
        if not c.isalpha():
            continue
        low = c.lower()
        p = ord(low[0])
        if p < 0x180:
            own.setdefault(p, len(own) + 1)
            table[point] = own[p]
        else:
            table[point] = 160 + p * 31 % (LETTERS - 160)
    return table


class Trigrams:
    """Counts of letter trigrams, with a border at each end of a word."""

    def __init__(self):
        self.table = letter_table()

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, trigram, count), and whether each text has a letter."""
        codes = [
            np.frombuffer((t or b"").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            for t in texts
        ]
        lengths = np.array([len(c) + 2 for c in codes])
        text = np.repeat(np.arange(len(texts)), lengths)
        letters = np.zeros(int(lengths.sum()), np.int64)
        ends = np.cumsum(lengths)
        for c, e, n in zip(codes, ends, lengths):
            letters[e - n + 1 : e - 1] = self.table[c]
        # Several non-letters in a row are one border.
        keep = letters > 0
        has = np.bincount(text[keep], minlength=len(texts)) > 0
        keep[1:] |= letters[:-1] > 0
        letters, text = letters[keep], text[keep]
        letters = np.concatenate([[0], letters])
        text = np.concatenate([text[:1], text])
        if len(letters) < 3:
            empty = np.zeros(0, np.int64)
            return np.stack([empty, empty]), empty, has
        gram = (letters[:-2] * LETTERS + letters[1:-1]) * LETTERS + letters[2:]
        # A trigram belongs to the text of its middle letter.
        middle = (letters[1:-1] > 0) & ((letters[:-2] > 0) | (letters[2:] > 0))
        pair, n = np.unique(text[1:-1][middle] * LETTERS**3 + gram[middle], return_counts=True)
        return np.stack([pair // LETTERS**3, pair % LETTERS**3]), n, has


def letter_vectors() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (LETTERS, DIMENSIONS))


def bound(grams: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The vectors of trigrams: letters permuted by place (rolled by 2, 1 and 0)
    and multiplied."""
    a, rest = grams // LETTERS**2, grams % LETTERS**2
    out = np.roll(vectors, 2, axis=1)[a] * np.roll(vectors, 1, axis=1)[rest // LETTERS]
    return (out * vectors[rest % LETTERS]).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    prototypes: np.ndarray
    spread: float = 0.05
    cache: dict = field(default_factory=dict)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Bundle all training texts of each language; rows without text or language
    are left out. Trigrams are counted on the executors, each text with equal
    weight in all; the driver gets their sums by language."""

    def count(batches):
        trigrams = Trigrams()
        sums: dict[str, dict[int, float]] = {}
        for batch in batches:
            texts, langs = raw_texts(batch.column(0)), batch.column(1).to_pylist()
            for first, last in text_slices(texts):
                pair, n, _ = trigrams.of(texts[first:last])
                norm = np.sqrt(np.bincount(pair[0], n.astype(float) ** 2, last - first))
                share = n / np.maximum(norm[pair[0]], 1e-9)
                number = {x: i for i, x in enumerate(dict.fromkeys(langs[first:last]))}
                of = np.array([number[x] for x in langs[first:last]])
                key, at = np.unique(of[pair[0]] * LETTERS**3 + pair[1], return_inverse=True)
                for i, x in enumerate(number):
                    mine = key // LETTERS**3 == i
                    total = np.bincount(at, share, len(key))[mine]
                    into = sums.setdefault(x, {})
                    for k, v in zip((key[mine] % LETTERS**3).tolist(), total.tolist()):
                        into[k] = into.get(k, 0.0) + v
        for x, by in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x] * len(by), pa.string()),
                    pa.array(list(by), pa.int64()),
                    pa.array(list(by.values()), pa.float64()),
                ],
                names=["lang", "gram", "n"],
            )

    rows = labelled.select(text, lang).where(
        F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.col(lang) != UNDETERMINED)
    )
    counted = rows.mapInArrow(count, "lang string, gram long, n double")
    # Sums of doubles depend on their order in the last places: round them off.
    sums = counted.groupBy("lang", "gram").agg(F.round(F.sum("n"), 6).alias("n"))
    profile: dict[str, list[tuple[int, float]]] = {}
    for r in sums.orderBy("lang", "gram").toLocalIterator():
        profile.setdefault(r.lang, []).append((r.gram, r.n))
        if len(profile) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
    vectors = letter_vectors()
    prototypes = np.zeros((len(profile), DIMENSIONS), np.float32)
    for i, x in enumerate(profile):
        grams = np.array([g for g, _ in profile[x]])
        n = np.array([n for _, n in profile[x]], np.float32)
        for k in range(0, len(grams), 4096):
            prototypes[i] += n[k : k + 4096] @ bound(grams[k : k + 4096], vectors)
    # What all languages have in common does not tell them apart.
    if len(prototypes) > 1:
        unit = prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
        prototypes = unit - unit.mean(axis=0)
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    return Model(list(profile), prototypes)


SCHEMA = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row with ``lang_pred`` and ``score`` (0 to 1: how clearly that
    language is nearer than the others).

    The whole text counts. Null, or a text without letters: ``und``, score 0;
    so is every text if the model has no language. Equal cosines: the language
    that sorts first. Repeated rows get equal results, an empty table stays
    empty, input columns with these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    ready: list = []

    def some(texts: list[bytes | None]) -> tuple[list, list]:
        m, (trigrams, vectors) = shared.value, ready
        pair, n, has = trigrams.of(texts)
        grams, at = np.unique(pair[1], return_inverse=True)
        bundles = np.zeros((len(texts), DIMENSIONS), np.float32)
        for k in range(0, len(grams), 2048):
            mine = (at >= k) & (at < k + 2048)
            counts = np.zeros((len(texts), min(2048, len(grams) - k)), np.float32)
            counts[pair[0][mine], at[mine] - k] = n[mine]
            bundles += counts @ bound(grams[k : k + 2048], vectors)
        bundles /= np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-9)
        cosine = (bundles @ m.prototypes.T).astype(float)
        best = cosine.argmax(axis=1)
        odds = np.exp((cosine - cosine.max(axis=1, keepdims=True)) / m.spread)
        clear = 1 / odds.sum(axis=1)
        return (
            [m.languages[b] if h else UNDETERMINED for b, h in zip(best, has)],
            np.where(has, clear, 0.0).tolist(),
        )

    def run(column: pa.Array) -> list:
        texts = raw_texts(column)
        if not shared.value.languages:
            return [[UNDETERMINED] * len(texts), [0.0] * len(texts)]
        if not ready:
            ready.extend([Trigrams(), letter_vectors()])
        langs, scores = [], []
        for first, last in text_slices(texts, 2_000_000):
            a, b = some(texts[first:last])
            langs += a
            scores += b
        return [langs, scores]

    return annotate(df, [text], run, SCHEMA)
