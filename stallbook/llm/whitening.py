"""Whitening of embeddings by refined eigenvectors.

Vector entries become whole numbers, so counts, sums and the covariance of all
distinct vectors are added up exactly, whatever the order of tasks. The driver
gets one matrix of dimension x dimension. Its eigenvectors are first taken in
single precision, then corrected by the iteration of Ogita and Aishima: matrix
products in about twice double precision show how far the vectors are from being
orthonormal and from making the matrix diagonal, and one product corrects both.
Eigenvalues too close for that form a cluster, whose small projected matrix is
solved on its own.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import annotate
from stallbook.operators.shared import share

#: Entries are taken in units of 1/SCALE.
SCALE = 256
#: Slices of a number in a product: at least five times 20 bits.
PARTS = 5
MOST_ITERATIONS = 20
#: Rounds of sub-solves: each one doubles the digits that separate a cluster, as
#: far as there are any; equal eigenvalues stay a cluster.
MOST_SOLVES = 3
LIMB = 62


# --- products in about twice double precision: a number is a pair high + low ---

Pair = tuple[np.ndarray, np.ndarray]


def two_sum(a: np.ndarray, b: np.ndarray) -> Pair:
    """The rounded sum and exactly what rounding took away."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def add(a: Pair, b: Pair) -> Pair:
    high, low = two_sum(a[0], b[0])
    return two_sum(high, low + a[1] + b[1])


def _slices(a: Pair, axis: int, bits: int) -> list[np.ndarray]:
    """``a`` as a sum of matrices whose entries are whole multiples, of at most
    ``bits`` bits, of one unit for each row (axis 1) or column (axis 0)."""
    high, low = a
    top = np.max(np.abs(high), axis=axis, keepdims=True)
    exponent = np.frexp(top)[1].astype(np.int64)
    out = []
    for _ in range(PARTS):
        exponent = exponent - bits
        unit = np.ldexp(1.0, exponent)
        part = np.rint(high / unit) * unit
        out.append(part)
        high, low = two_sum(high - part, low)
    return out


def product(a: Pair, b: Pair) -> Pair:
    """Matrix product. Products of slices fit into 53 bits, so each of them is
    exact; they are added from the smallest up."""
    bits = (52 - max(1, a[0].shape[1]).bit_length()) // 2
    left, right = _slices(a, 1, bits), _slices(b, 0, bits)
    zero = np.zeros((a[0].shape[0], b[0].shape[1]))
    out: Pair = (zero, zero)
    for order in reversed(range(PARTS)):
        for i in range(order + 1):
            out = add(out, (left[i] @ right[order - i], zero))
    return out


def _turned(a: Pair) -> Pair:
    return a[0].T, a[1].T


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Indices of values that follow each other by at most ``gap``, two and more."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refine(matrix: Pair, start: np.ndarray) -> tuple[Pair, Pair]:
    """Eigenvalues and eigenvectors (columns) of a symmetric matrix, from
    approximate ones. Stops when a correction is below what doubles show, or no
    longer gets smaller; equal eigenvalues get any basis of their space."""
    d = len(start)
    one = np.eye(d)
    x: Pair = (start, np.zeros_like(start))
    norm = float(np.linalg.norm(matrix[0], 2)) or 1.0
    solved, solves, best = False, 0, math.inf
    for _ in range(MOST_ITERATIONS):
        turned = _turned(x)
        gram = product(turned, x)
        sized = product(turned, product(matrix, x))
        r = (one - gram[0]) - gram[1]
        s = sized[0] + sized[1]
        # exactly symmetric, so what turns the vectors cannot stretch them
        r, s = (r + r.T) / 2, (s + s.T) / 2
        inner = np.diag(r)
        value = np.diag(sized[0]).copy()
        rest = np.diag(sized[1]) + value * inner / (1.0 - inner)
        off = s - np.diag(np.diag(s))
        gap = 2 * (float(np.linalg.norm(off, 2)) + norm * float(np.linalg.norm(r, 2)))
        # equal to double precision: no iteration can tell them apart, or has to
        gap = max(gap, norm * 2.0**-70)
        away = (value[None, :] - value[:, None]) + (rest[None, :] - rest[:, None])
        far = np.abs(away) > gap
        # r / 2 makes the vectors orthonormal, the rest turns them: kept apart, so
        # eigenvalues that differ in the last digits do not spoil the first
        turn = (off + (value[None, :] + value[:, None]) / 2 * r) / np.where(far, away, 1.0)
        change = np.where(far, turn, 0.0) + r / 2
        np.fill_diagonal(change, inner / 2)
        close = _clusters(value + rest, gap)
        if close and not solved and solves < MOST_SOLVES:
            # make the vectors orthonormal first, then turn each cluster's basis
            x = add(x, product(x, (change, np.zeros_like(change))))
            for c in close:
                x = _sub_solve(matrix, x, c)
            solved, solves = True, solves + 1
            continue
        solved = False
        size = float(np.abs(change).max())
        x = add(x, product(x, (change, np.zeros_like(change))))
        if size < 2.0**-62 or (size >= best and size < 2.0**-50):
            break
        best = min(best, size)
    # eigenvalues by the corrected vectors
    gram = product(_turned(x), x)
    sized = product(_turned(x), product(matrix, x))
    inner = (1.0 - np.diag(gram[0])) - np.diag(gram[1])
    value = np.diag(sized[0]).copy()
    return (value, np.diag(sized[1]) + value * inner / (1.0 - inner)), x


def _sub_solve(matrix: Pair, x: Pair, cluster: np.ndarray) -> Pair:
    """Eigenvectors inside the space of some columns. The middle of their
    eigenvalues is taken off first, so the small matrix shows their differences
    with all digits."""
    part: Pair = (x[0][:, cluster], x[1][:, cluster])
    turned = _turned(part)
    sized, gram = product(turned, product(matrix, part)), product(turned, part)
    middle = float(np.mean(np.diag(sized[0])))
    shifted = add(sized, product(gram, (-middle * np.eye(len(cluster)), np.zeros((len(cluster),) * 2))))
    small = shifted[0] + shifted[1]
    basis = np.linalg.eigh((small + small.T) / 2)[1]
    new = product(part, (basis, np.zeros_like(basis)))
    high, low = x[0].copy(), x[1].copy()
    high[:, cluster], low[:, cluster] = new
    return high, low


def eigen(whole: list[list[int]], divisor: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling) and unit eigenvectors (columns, largest entry
    positive) of the matrix ``whole / divisor``, and its trace, in doubles."""
    d = len(whole)
    top = max((abs(v) for row in whole for v in row), default=0)
    if top == 0:
        return np.zeros(d), np.eye(d), 0.0
    # between 1/2 and 1, a power of two away from the true matrix
    shift = top.bit_length() - divisor.bit_length()
    scale = Fraction(2) ** -shift / divisor
    high, low = np.empty((d, d)), np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            exact = whole[i][j] * scale
            high[i, j] = high[j, i] = float(exact)
            low[i, j] = low[j, i] = float(exact - Fraction(high[i, j]))
    start = np.linalg.eigh(high.astype(np.float32))[1].astype(np.float64)
    (value, rest), x = refine((high, low), start)
    order = np.argsort(-(value + rest), kind="stable")
    vectors = (x[0] + x[1])[:, order]
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0) < 0, -1.0, 1.0)
    trace = sum(whole[i][i] for i in range(d))
    return np.ldexp((value + rest)[order], shift), vectors, float(Fraction(trace, divisor))


# --- sums over all distinct vectors ---


@dataclasses.dataclass(frozen=True)
class Model:
    """What whitening needs of the fit list: ``n`` distinct vectors, their sums by
    dimension, the leading eigenvalues and eigenvectors, the trace, and how far
    the whitened vectors' covariance is from the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def usable(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding noise."""
        if not len(self.values):
            return np.zeros(0, bool)
        return self.values > max(self.values[0], 0.0) * len(self.sums) * 2.0**-52

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of whole-number vectors; nan for those that the
        data do not vary in."""
        centred = self._from_mean(x)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = centred @ self.vectors / np.sqrt(np.maximum(self.values, 0.0))
        out[:, ~self.usable()] = np.nan
        return out

    def _from_mean(self, x: np.ndarray) -> np.ndarray:
        exact = _whole_deviations(x, self.n, self.sums)
        if exact.dtype == object:
            return np.array([[float(Fraction(v, self.n)) for v in row] for row in exact])
        return exact / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Squared length of n * x - sums, exact."""
        exact = _whole_deviations(x, self.n, self.sums)
        most = int(np.abs(exact).max()) if exact.size else 0
        if exact.dtype != object and most * most * max(1, exact.shape[1]) >= 2**63:
            exact = exact.astype(object)
        return [int(v) for v in (exact * exact).sum(axis=1)]


def _whole_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    most = int(np.abs(x).max()) if x.size else 0
    if n * most + max((abs(s) for s in sums), default=0) < 2**53:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def whole_vectors(vector: Column) -> Column:
    """floor(256 * entry) of each entry, as long."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * SCALE))


def _fits(vector: Column) -> Column:
    """Not null, and every entry a number whose units fit into a long."""

    def good(v: Column) -> Column:
        units = F.abs(v.cast("double") * SCALE)
        return F.coalesce(~F.isnan(units) & (units < 2.0**62), F.lit(False))

    return F.coalesce(vector.isNotNull() & F.forall(vector, good), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _limbs(value: int) -> tuple[int, int, int]:
    """A whole number in three longs, of which the upper one carries the sign."""
    mask = (1 << LIMB) - 1
    return value >> (2 * LIMB), (value >> LIMB) & mask, value & mask


PARTIAL = "i int, j int, top long, middle long, low long"


def _partial(cells: Iterator[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    names = ["i", "j", "top", "middle", "low"]
    rows = [(i, j, *_limbs(v)) for i, j, v in cells]
    if rows:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
        )


def _added(partial: DataFrame) -> dict[tuple[int, int], int]:
    """Exact totals of the tasks' partial sums, on the driver: one number for each
    cell, so their count depends on the dimension alone."""
    total = partial.groupBy("i", "j").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("top", "middle", "low")]
    )
    return {
        (r.i, r.j): (int(r.top) << (2 * LIMB)) + (int(r.middle) << LIMB) + int(r.low)
        for r in total.collect()
    }


def sums(fit: DataFrame, column: str) -> tuple[int, list[int]]:
    """How many vectors there are, and their exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            n += len(x)
            exact = int(np.abs(x).max()) * len(x) < 2**62
            # by Python's whole numbers over batches, so no total is too large
            added = (x if exact else x.astype(object)).sum(axis=0).astype(object)
            total = added if total is None else total + added
        if total is not None:
            yield from _partial([(-1, -1, n), *((i, i, int(v)) for i, v in enumerate(total))])

    found = _added(fit.select(column).mapInArrow(run, PARTIAL))
    n = found.pop((-1, -1), 0)
    return n, [found[i, i] for i in range(len(found))]


def covariance(fit: DataFrame, column: str, n: int, totals: list[int]) -> list[list[int]]:
    """n^2 times the covariance (divisor n), exact. Vectors are centred on the
    whole numbers next to the mean before they are multiplied; what is left of
    the mean is taken off exactly afterwards."""
    d = len(totals)
    middle = [(2 * s + n) // (2 * n) for s in totals]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        centre = np.array(middle, np.int64)
        open_sum, room = np.zeros((d, d)), 2**53
        for batch in batches:
            z = _matrix(batch.column(0))
            if not len(z):
                continue
            z = z - centre
            most = int(np.abs(z).max())
            cost = most * most * len(z)
            if cost >= 2**53:
                wide = z.astype(object)
                total = total + wide.T @ wide
                continue
            if cost > room:
                total = total + open_sum.astype(np.int64)
                open_sum, room = np.zeros((d, d)), 2**53
            # whole numbers below 2^53: each product and sum is exact
            whole = z.astype(np.float64)
            open_sum, room = open_sum + whole.T @ whole, room - cost
        total = total + open_sum.astype(np.int64)
        yield from _partial((i, j, int(total[i, j])) for i in range(d) for j in range(i, d))

    found = _added(fit.select(column).mapInArrow(run, PARTIAL))
    left = [s - n * m for s, m in zip(totals, middle)]
    out = [[0] * d for _ in range(d)]
    for i in range(d):
        for j in range(i, d):
            out[i][j] = out[j][i] = n * found.get((i, j), 0) - left[i] * left[j]
    return out


def identity_error(fit: DataFrame, column: str, model: Model) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, over
    the components that vary; null if there is none."""
    keep = np.flatnonzero(model.usable())
    k = len(keep)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                w = model.project(x)[:, keep]
                first += w.sum(axis=0)
                second += w.T @ w
        cells = [(-1, i, first[i]) for i in range(k)]
        cells += [(i, j, second[i, j]) for i in range(k) for j in range(k)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*cells), (pa.int32(), pa.int32(), pa.float64()))],
            names=["i", "j", "v"],
        )

    rows = fit.select(column).mapInArrow(run, "i int, j int, v double")
    found = {(r.i, r.j): r.v for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    mean = np.array([found[-1, i] for i in range(k)]) / model.n
    cov = np.array([[found[i, j] for j in range(k)] for i in range(k)]) / model.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def fit_model(fit: DataFrame, column: str = "x", components: int = 4) -> Model:
    """The model of a table of distinct whole-number vectors of one length.
    Memory: a task and the driver hold matrices of dimension x dimension."""
    n, totals = sums(fit, column)
    whole = covariance(fit, column, n, totals)
    values, vectors, trace = eigen(whole, n * n)
    k = min(components, len(values))
    model = Model(n, totals, values[:k].copy(), vectors[:, :k].copy(), trace)
    return dataclasses.replace(model, identity_error=identity_error(fit, column, model))


RESULTS = pa.schema(
    [
        ("deviation", pa.decimal128(38, 0)),
        ("whitened", pa.list_(pa.float64())),
        ("explained", pa.list_(pa.float64())),
        ("fit_rows", pa.int64()),
        ("identity_error", pa.float64()),
    ]
)


def whiten(df: DataFrame, vector: str = "embedding", components: int = 4) -> DataFrame:
    """Rows with a usable vector, with ``whitened`` and ``explained`` (one entry
    for each leading component, by falling eigenvalue), ``deviation`` (exact, null
    from 10^38 on), ``fit_rows`` (distinct vectors that the model is fitted on)
    and ``identity_error``. Columns of ``df`` with these names are replaced.

    Dropped are vectors that are null or empty, hold null or non-finite entries or
    entries beyond 2^62 units, and vectors of another length than most have (the
    longer length in a tie). Equal vectors count once in the fit, and each row is
    returned. A component in which the data do not vary (fewer distinct vectors
    than dimensions, or constant ones) has a null ``whitened`` and counts in no
    ``identity_error``. An empty table, or one without usable vectors, gives an
    empty one.
    """
    names = [n.lower() for n in RESULTS.names]
    if vector.lower() in names:
        raise ValueError(f"the vector column must not be called {vector}")
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c.lower() not in names]
    taken = {c.lower() for c in df.columns}
    x = "x"
    while x in taken:
        x = f"_{x}"
    v = F.col(f"`{vector}`")
    rows = df.select(*kept).where(_fits(v) & (F.size(v) > 0))
    most = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size(v) == F.lit(most["d"] if most else 0)).withColumn(x, whole_vectors(v))
    model = Model(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    if most:
        model = fit_model(share(rows.select(x).distinct()), x, components)
    explained = (model.values / model.trace if model.trace else model.values).tolist()

    def run(column: pa.Array) -> list:
        if not len(column):
            return [[] for _ in RESULTS.names]
        at = _matrix(column)
        white = [[None if math.isnan(e) else e for e in row] for row in model.project(at).tolist()]
        length = len(at)
        whole = [e if abs(e) < 10**38 else None for e in model.deviations(at)]
        return [
            pa.array(whole, pa.decimal128(38, 0)),
            white,
            [explained] * length,
            [model.n] * length,
            [model.identity_error] * length,
        ]

    return annotate(rows, [x], run, RESULTS).drop(x)
