from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from stallbook.llm import whitening
from stallbook.llm.whitening import product, refine


def exact(pair):
    return [[Fraction(h) + Fraction(lo) for h, lo in zip(a, b)] for a, b in zip(*pair)]


def test_product_has_about_twice_double_precision():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(9, 7)) * 10.0 ** rng.integers(-6, 6, (9, 1))
    b = rng.normal(size=(7, 5))
    low = (a * 2.0**-54, b * -(2.0**-55))
    got = exact(product((a, low[0]), (b, low[1])))
    x, y = exact((a, low[0])), exact((b, low[1]))
    for i in range(9):
        for j in range(5):
            true = sum(x[i][k] * y[k][j] for k in range(7))
            size = sum(abs(x[i][k] * y[k][j]) for k in range(7))
            assert abs(got[i][j] - true) < size * Fraction(2) ** -96


def basis(d, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]


def residuals(matrix, value, x):
    """Exactly: how far A x - x l and x' x - 1 are from 0."""
    ax, l = exact(product(matrix, x)), [Fraction(v) + Fraction(r) for v, r in zip(*value)]
    xs = exact(x)
    d = len(xs)
    first = max(abs(ax[i][j] - xs[i][j] * l[j]) for i in range(d) for j in range(d))
    gram = exact(product((x[0].T, x[1].T), x))
    second = max(abs(gram[i][j] - (i == j)) for i in range(d) for j in range(d))
    return float(first), float(second)


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1, 0.5],
        [1, 1 - 1e-7, 1 - 2e-7, 0.4, 0.4 - 1e-9, 0.1],
        [1, 1, 1, 0.5, 0.5, 0],
        [1, 1 - 1e-13, 1 - 3e-13, 1e-8, 1e-9, 0],
        [0, 0, 0, 0, 0, 0],
    ],
)
def test_refinement_reaches_more_than_double_precision(values):
    x = basis(6, 3)
    a = (x * np.array(values)) @ x.T
    a = (a + a.T) / 2
    matrix = (a, np.zeros_like(a))
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    value, vectors = refine(matrix, start)
    first, second = residuals(matrix, value, vectors)
    assert first < 1e-19 and second < 1e-19
    assert np.allclose(np.sort(value[0])[::-1], values, atol=1e-14)


def brute(vectors, components=4):
    good = [(i, v) for i, v in vectors if v and all(e is not None and math.isfinite(e) for e in v)]
    x = np.array([np.floor(np.array(v, np.float64) * 256) for _, v in good])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for (i, _), row in zip(good, x):
        dev = sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))
        out[i] = (n, dev, (row - s / n) @ u[:, :components] / np.sqrt(e[:components]), e[:components] / e.sum())
    return out


def test_equals_numpy_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").repartition(5)
    more = spark.createDataFrame(
        [(90001, None), (90002, [float("nan")] * 64), (90003, [None] * 64), (90004, [0.5] * 3), (90005, [])],
        "vec_id long, embedding array<float>",
    )
    both = df.select("vec_id", "embedding").union(more)
    got = whitening.whiten(both.union(both.limit(20))).collect()
    expected = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert len(got) == len(expected) + 20
    for r in got:
        n, dev, white, share = expected[r.vec_id]
        assert (r.fit_rows, int(r.deviation)) == (n, dev)
        assert np.allclose(np.abs(r.whitened), np.abs(white), atol=1e-10)
        assert np.allclose(r.explained, share, rtol=1e-10)
        assert r.identity_error < 1e-10


def frame(spark, *vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")


def test_copies_count_once_in_the_fit(spark):
    rng = np.random.default_rng(2)
    points = [v.tolist() for v in rng.normal(size=(30, 3))]
    one = {r.vec_id: r for r in whitening.whiten(frame(spark, *points)).collect()}
    more = whitening.whiten(frame(spark, *points, *[points[0]] * 50)).collect()
    for r in more:
        same = one[r.vec_id if r.vec_id < 30 else 0]
        assert (r.whitened, r.fit_rows, r.deviation) == (same.whitened, 30, same.deviation)


def test_no_variance_gives_null(spark):
    rows = whitening.whiten(frame(spark, [1.0, 2.0, 3.0])).collect()
    assert rows[0].whitened == [None] * 3 and rows[0].explained == [0.0] * 3
    assert rows[0].identity_error is None and rows[0].deviation == 0
    rows = whitening.whiten(frame(spark, [1.0, 2.0, 3.0], [2.0, 4.0, 6.0])).collect()
    assert [abs(round(v, 9)) for v in (r.whitened[0] for r in rows)] == [1, 1]
    assert rows[0].whitened[1:] == [None, None] and rows[0].explained[0] == 1.0


def test_large_entries_stay_exact(spark):
    points = [[1e12, 3.0], [-1e12, 5.5], [7e11, -2.25], [1e300, 1.0], [1e15, 0.0]]
    rows = {r.vec_id: r for r in whitening.whiten(frame(spark, *points)).collect()}
    assert sorted(rows) == [0, 1, 2, 4]  # 1e300 in units of 1/256 is no long
    x = [[math.floor(v * 256) for v in points[i]] for i in (0, 1, 2, 4)]
    s = [sum(c) for c in zip(*x)]
    for i, v in zip((0, 1, 2, 4), x):
        assert int(rows[i].deviation) == sum((4 * a - b) ** 2 for a, b in zip(v, s))
    assert rows[0].identity_error < 1e-9


def test_empty_and_clashing_names(spark):
    schema = "vec_id long, embedding array<double>, whitened string, x int, Deviation int, `a b` int"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [float(i), float(i * i)], "old", i, 0, i) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.x for r in got) == list(range(5)) and all(len(r.whitened) == 2 for r in got)
    assert sorted(r["a b"] for r in got) == list(range(5))


def test_wide_vectors(spark):
    rng = np.random.default_rng(8)
    points = [v.tolist() for v in rng.normal(size=(40, 300))]
    got = whitening.whiten(frame(spark, *points)).collect()
    expected = brute(list(enumerate(points)))
    for r in got:
        assert np.allclose(np.abs(r.whitened), np.abs(expected[r.vec_id][2]), atol=1e-8)
