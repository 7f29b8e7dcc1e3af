from __future__ import annotations

import numpy as np
import pytest

from stallbook.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.93):
    usable = {}
    for i, x, label in rows:
        if label is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x):
            v = np.array(x, np.float32).astype(float)
            usable[i] = (v / np.linalg.norm(v), label)
    near = {i: set() for i, *_ in rows}
    for i, (x, a) in usable.items():
        for j, (y, b) in usable.items():
            if i != j and a == b and len(x) == len(y) and x @ y >= threshold:
                near[i].add(j)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        out[i] = (len(near[i]), min(seen), min(seen) == i)
    return out


def made(seed, n=160, d=8):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rng.normal(size=d)
        for _ in range(rng.integers(1, 12)):
            noise = rng.normal(size=d) * rng.choice([0, 0.05, 0.2, 0.35])
            rows.append([float(v) for v in (base + noise) * rng.choice([1, 3])])
    out = [(i, x, int(rng.integers(0, 2))) for i, x in enumerate(rows)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * d, [nan] * d, [inf] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0, 0.0]]
    out += [(1000 + k, x, 0) for k, x in enumerate(odd * 2)]
    return out + [(2000, rows[0], None), (2001, rows[0], None)]


@pytest.mark.parametrize("per_cell, block", [(5000, 2048), (10, 7)])
def test_equals_brute_force(spark, per_cell, block):
    rows = made(per_cell)
    df = spark.createDataFrame(rows, SCHEMA)
    got = embed_dedup.near_duplicates(df, per_cell=per_cell, block=block).collect()
    want = brute_force(rows)
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want
    assert sum(n for n, *_ in want.values()) > 100


def test_every_partner_of_a_vector_shares_a_cell():
    rng = np.random.default_rng(4)
    x = embed_dedup.unit(rng.normal(size=(400, 6)))
    centres = embed_dedup.spherical_kmeans(x, 12)
    assert np.linalg.norm(centres, axis=1) == pytest.approx(1)
    row, cell = embed_dedup.cells_of(x, centres, float(np.sqrt(2 - 2 * 0.93)))
    cells = [set(cell[row == i].tolist()) for i in range(400)]
    near = np.argwhere(np.triu(x @ x.T >= 0.93, 1))
    assert len(near) and all(cells[i] & cells[j] for i, j in near)
    assert np.mean([len(c) for c in cells]) < 10


def test_repeated_rows_and_missing_ids(spark):
    x = [1.0, 2.0]
    df = spark.createDataFrame([(1, x, 1), (1, x, 1), (None, x, 1), (4, x, 1)], SCHEMA)
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in
                 embed_dedup.near_duplicates(df).collect())
    assert got == [(0, 3, 1, None), (1, 3, 1, True), (1, 3, 1, True), (4, 3, 1, False)]
    alone = spark.createDataFrame([(None, x, 1), (None, [1.0, 2.1], 1), (2, [2.0, -1.0], 1)], SCHEMA)
    got = {r.vec_id: tuple(r)[1:] for r in embed_dedup.near_duplicates(alone).collect()}
    assert got == {None: (1, None, None), 2: (0, 2, True)}
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0


def test_one_id_on_two_vectors(spark):
    rows = [(7, [1.0, 0.0], 1), (7, [0.0, 1.0], 1), (3, [1.0, 0.01], 1), (9, [0.01, 1.0], 1)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == [(3, 1, 3, True), (7, 1, 3, False), (7, 1, 7, True), (9, 1, 7, False)]


def test_a_chain_is_one_component(spark):
    turn = np.arccos(0.95)
    rows = [(i, [float(np.cos(i * turn)), float(np.sin(i * turn))], 1) for i in range(12)]
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {r.component_id for r in got.values()} == {0}
    assert [got[i].n_links for i in range(12)] == [1] + [2] * 10 + [1]
