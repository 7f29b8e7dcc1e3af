"""Near-duplicate vectors: spherical k-means deals vectors to cells, cosines are
taken in blocks inside a cell, and of each group of linked vectors one is kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import components
from stallbook.operators.shared import share

THRESHOLD = 0.93
#: Vectors of a cell that a block product takes from either side.
BLOCK = 2048
#: Different vectors per cell that are aimed at, and cells at most (the centres
#: are broadcast).
PER_CELL, MOST_CELLS = 5000, 4096
#: Numbers in the sample that the centres are fitted on.
SAMPLE_NUMBERS = 4_000_000
ROUNDS = 8


def unit(x: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares from running over.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of ``k`` cells (or of as many as there are rows)."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        cell = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        # An empty cell keeps its centre.
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def cells_of(x: np.ndarray, centres: np.ndarray, chord: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every cell a vector takes part in: first its own cell, then
    the later cells that a vector within ``chord`` may lie in. If y is nearer to
    centre c than to x's centre a, then (a - c).x <= |a - c| |x - y|."""
    near = x @ centres.T
    own = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    lead = near[np.arange(len(x)), own][:, None] - near
    may = (lead <= apart[own] * chord + 1e-9) & (np.arange(len(centres)) > own[:, None])
    row, cell = np.nonzero(may)
    return np.concatenate([np.arange(len(x)), row]), np.concatenate([own, cell])


def linked(a: np.ndarray, b: np.ndarray, threshold: float, same: bool):
    """Pairs (i, j) of rows of a and b with a cosine at or above the threshold,
    in slices; only i < j if both are the same rows."""
    for i in range(0, len(a), 256):
        hit = a[i : i + 256] @ b.T >= threshold
        if same:
            hit &= np.arange(len(b)) > np.arange(i, i + len(hit))[:, None]
        x, y = np.nonzero(hit)
        yield x + i, y


def forest(pairs, size: int) -> list[tuple[int, int]]:
    """Links that join the same rows into the same groups as all ``pairs`` do,
    fewer than there are rows."""
    root = np.arange(size)

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    kept = []
    for x, y in pairs:
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((x, y))
    return kept


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    per_cell: int = PER_CELL,
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id``, ``kept``.

    Vectors with equal, non-null labels and equal length are linked if their
    cosine is at or above ``threshold``. Every such pair is found: besides its
    own cell, a vector is compared in each later cell that a vector so near to
    it can lie in. Equal vectors are one vector with a count until the end.
    Cells are worked off in blocks, so no task holds more than two blocks; it
    returns counts and at most a tree of links, not pairs.

    Null, empty or zero vectors, vectors with null or non-finite components,
    and rows with a null label link with nothing: n_links 0, a component of
    their own, kept. A row without an id is linked like any other and counts for
    its partners; it is no one's component and not kept, and where no vector of a
    component has an id, both are null. Different vectors may have the same id.
    Repeated rows are copies of each other. An empty table stays empty; further
    columns are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("id"),
        F.col(f"`{embedding}`").cast("array<double>").alias("x"),
        F.col(f"`{label}`").alias("label"),
    )
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = (
        F.col("label").isNotNull()
        & F.coalesce(F.size("x") > 0, F.lit(False))
        & F.coalesce(finite & F.exists("x", lambda v: v != 0), F.lit(False))
    )
    group = F.concat_ws("|", F.size("x"), F.col("label").cast("string"))
    key = F.md5(F.concat_ws("|", group, F.col("x").cast("string")).cast("binary"))
    keyed = rows.select("id", "x", group.alias("g"), F.when(usable, key).alias("key"))
    distinct = share(
        keyed.where("key is not null")
        .groupBy("key")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("g").alias("g"),
             F.first("x").alias("x"))
        .withColumn("rep", F.unhex("key"))
    )

    # Centres for each length of vector (one, in a sound table).
    sizes = distinct.groupBy(F.size("x").alias("d")).count().collect()
    centres: dict[int, np.ndarray] = {}
    for d, n in sorted((r.d, r["count"]) for r in sizes):
        sample = (
            distinct.where(F.size("x") == d)
            .orderBy(F.xxhash64("key"), "key")
            .limit(max(1, SAMPLE_NUMBERS // d))
            .select("x")
        )
        most = max(1, min(MOST_CELLS, SAMPLE_NUMBERS // d))
        centres[d] = spherical_kmeans(
            unit(matrix(sample.toArrow().column(0))), min(most, -(-n // per_cell))
        )
    shared = spark.sparkContext.broadcast(centres)
    chord = float(np.sqrt(2 - 2 * threshold))

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            width = np.diff(batch.column("x").offsets.to_numpy())
            for d in np.unique(width):
                mine = pa.array(np.flatnonzero(width == d))
                part = batch.take(mine)
                x = unit(matrix(part.column("x")))
                row, cell = cells_of(x, shared.value[int(d)], chord)
                out = part.drop_columns(["x"]).take(pa.array(row))
                flat = pa.array(x[row].ravel())
                offsets = pa.array(np.arange(0, len(flat) + 1, d), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *out.columns,
                        pa.ListArray.from_arrays(offsets, flat),
                        pa.array(cell, pa.int32()),
                        pa.array(np.arange(len(row)) >= len(x)),
                    ],
                    names=[*out.schema.names, "x", "cell", "guest"],
                )

    # vectors are told apart by their digest: ids may be missing or come twice
    id_type = "binary"
    assigned = share(
        distinct.select("rep", "copies", "g", "x").mapInArrow(
            assign,
            f"rep {id_type}, copies long, g string, x array<double>, cell int, guest boolean",
        )
    )
    # A cell's members and guests are cut into blocks by a hash of their id; a
    # unit of work compares a block of members with a block of members or guests.
    counts = assigned.groupBy("g", "cell").agg(
        F.ceil(F.sum(F.when(~F.col("guest"), 1).otherwise(0)) / block).alias("members"),
        F.ceil(F.sum(F.when(F.col("guest"), 1).otherwise(0)) / block).alias("guests"),
    )
    hashed = F.xxhash64("rep", "x")
    placed = assigned.join(counts, ["g", "cell"]).where("members > 0").withColumn(
        "b", F.pmod(hashed, F.when(F.col("guest"), F.col("guests")).otherwise(F.col("members")))
    )
    # Guests' blocks are numbered after the members'.
    own = F.when(F.col("guest"), F.col("members") + F.col("b")).otherwise(F.col("b"))
    as_left = F.when(
        ~F.col("guest"),
        F.transform(
            F.sequence(F.col("b"), F.col("members") + F.col("guests") - 1),
            lambda other: F.struct(F.col("b").alias("l"), other.alias("r"), F.lit(0).alias("side")),
        ),
    )
    low = F.when(F.col("guest"), F.col("members")).otherwise(F.col("b"))
    as_right = F.when(
        low > 0,
        F.transform(
            F.sequence(F.lit(0).cast("long"), low - 1),
            lambda other: F.struct(other.alias("l"), own.alias("r"), F.lit(1).alias("side")),
        ),
    )
    no_units = F.array().cast("array<struct<l:bigint,r:bigint,side:int>>")
    units = placed.withColumn(
        "u", F.explode(F.concat(F.coalesce(as_left, no_units), F.coalesce(as_right, no_units)))
    ).select("g", "cell", "u.l", "u.r", "u.side", "rep", "copies", "x")

    def compare(work: pa.Table) -> pa.Table:
        side = work.column("side").to_numpy()
        same = work.column("l")[0] == work.column("r")[0]
        x = matrix(work.column("x"))
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        copies = work.column("copies").to_numpy()
        links = np.zeros(len(side), np.int64)
        tree: list[tuple[int, int]] = []
        for i, j in linked(x[left], x[right], threshold, same):
            i, j = left[i], right[j]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            tree += forest(zip(i.tolist(), j.tolist()), len(side))
        tree = forest(tree, len(side))
        reps = work.column("rep").combine_chunks()
        has = np.flatnonzero(links)
        a = pa.array([i for i, _ in tree], pa.int64())
        b = pa.array([j for _, j in tree], pa.int64())
        nothing = pa.nulls(len(has), reps.type)
        return pa.table(
            {
                "a": pa.concat_arrays([reps.take(pa.array(has, pa.int64())), reps.take(a)]),
                "b": pa.concat_arrays([nothing, reps.take(b)]),
                "n": np.concatenate([links[has], np.zeros(len(tree), np.int64)]),
            }
        )

    found = share(
        units.groupBy("g", "cell", "l", "r").applyInArrow(
            compare, f"a {id_type}, b {id_type}, n long"
        )
    )
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    groups = components(found.where("b is not null").select("a", "b"))
    by_key = (
        distinct.select("key", "rep", "copies", "least")
        .join(links, "rep", "left")
        .join(groups.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "key",
            "least",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("root"),
        )
    )
    smallest = by_key.groupBy("root").agg(F.min("least").alias("component"))
    by_key = by_key.join(smallest, "root").select("key", "n_links", "component")
    out = keyed.select("id", "key").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
