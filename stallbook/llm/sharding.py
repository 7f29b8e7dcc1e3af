"""Uniform shuffle into shards of exact sizes.

Every row gets a shard and a place in it such that each order of all rows is
equally likely, and shards differ by at most one row. The steps are those of a
parallel shuffle: an exact communication matrix says how many rows of each input
partition go to each shard (hypergeometric: what drawing without replacement
gives), every partition deals its rows out in a random order by these counts, and
each shard puts what it received into a random order again.

A shard may be a sixteenth of everything, so its second shuffle is spread: rows
fall into random cells of a few thousand rows, each cell is ordered on its own,
and cells follow each other. No task needs more than an input partition's labels
(two bytes a row) or one cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.operators.shared import share

#: Rows of one cell of a shard, on average.
CELL_ROWS = 4096
#: Input partitions whose part of the matrix one task draws.
RACK = 1024
#: Bits of a row's number that count inside its input partition.
INNER_BITS = 33


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` balls are good, out of ``good`` and ``bad`` ones.

    Any size: numpy's own sampler ends at a thousand million balls. The weights
    round the mode follow from exact ratios of neighbours, so no gamma function
    loses digits; what lies beyond fourteen standard deviations and more never shows."""
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    spread = math.sqrt(drawn * (good / total) * (bad / total) * ((total - drawn) / max(total - 1, 1)))
    reach = int(14 * spread) + 60
    first, last = max(low, mode - reach), min(high, mode + reach)
    x = np.arange(first, last, dtype=np.float64)
    # weight(x + 1) / weight(x)
    ratio = np.log(good - x) + np.log(drawn - x) - np.log(x + 1) - np.log(bad - drawn + x + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    weight = np.exp(weight - weight.max())
    return first + int(np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), "right"))


def deal(rng: np.random.Generator, left: list[int], drawn: int) -> list[int]:
    """Draw ``drawn`` balls of an urn with ``left`` balls of each colour: how many
    there are of each. The balls drawn are taken out of ``left``."""
    rest, out = sum(left), []
    for i, n in enumerate(left):
        rest -= n
        got = hypergeometric(rng, n, rest, drawn)
        out.append(got)
        left[i] -= got
        drawn -= got
    return out


def shard_sizes(n_rows: int, shards: int) -> list[int]:
    return [n_rows // shards + (j < n_rows % shards) for j in range(shards)]


def _random(seed: int, *stream: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, *stream])))


def communication_matrix(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows of each input partition (``block``, ``n_rows``) that go to each shard:
    (block, to). Rows of the matrix sum to ``n_rows``, its columns to the shard
    sizes. The driver draws one row for each thousand partitions, tasks divide
    these among their partitions; a repeated task draws the same."""
    racked = blocks.withColumn("rack", F.expr(f"block div {RACK}"))
    racks = racked.groupBy("rack").agg(F.sum("n_rows").alias("n")).orderBy("rack").collect()
    left = shard_sizes(sum(r.n for r in racks), shards)
    rng = _random(seed, 0)
    parts = {r.rack: deal(rng, left, r.n) for r in racks}

    def divide(key: tuple, table: pa.Table) -> pa.Table:
        rack = key[0].as_py()
        table = table.sort_by("block")
        left, rng = list(parts[rack]), _random(seed, 1, rack)
        to = [deal(rng, left, n) for n in table["n_rows"].to_pylist()]
        return pa.table([table["block"], pa.array(to, pa.list_(pa.int64()))], names=["block", "to"])

    return racked.groupBy("rack").applyInArrow(divide, "block long, to array<long>")


def _labels(seed: int, block: int, to: list[int]) -> np.ndarray:
    """The shard of each row of an input partition, in stored order: the counts
    of the matrix in random order."""
    labels = np.repeat(np.arange(len(to), dtype=np.int16), to)
    _random(seed, 2, block).shuffle(labels)
    return labels


def _fresh(taken: list[str], *names: str) -> list[str]:
    """Column names that ``taken`` does not hold."""
    out = []
    for n in names:
        while n.lower() in {t.lower() for t in taken}:
            n = f"_{n}"
        out.append(n)
    return out


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def shuffle_into_shards(df: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """All rows of ``df`` with ``shard`` (int) and ``slot`` (long, from 0 without
    gaps in each shard). Shards hold the same number of rows or one more; with
    fewer rows than shards the last ones are empty. Columns of ``df`` with the two
    names are replaced.

    Rows are told apart by their place alone: nulls, equal rows, empty and very
    long texts are dealt out like any other, copies independently of each other.
    An empty table gives an empty one. The rows are stored first, with the input
    partition and the place in it; from there on the result is a function of the
    seed, so a lost task makes the same rows. Another layout of the input gives
    another, equally likely, order.
    """
    if not 1 <= shards <= 2**15 - 1:
        raise ValueError(f"shards must be between 1 and {2**15 - 1}, not {shards}")
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    at, to, block, cell, before, made = _fresh(kept, "at", "to", "block", "cell", "before", "made")
    stored = share(
        df.select(*[_quoted(c) for c in kept], F.monotonically_increasing_id().alias(at))
    )
    number = F.expr(f"shiftright(`{at}`, {INNER_BITS})")
    blocks = stored.groupBy(number.alias("block")).agg(F.count(F.lit(1)).alias("n_rows"))
    blocks = share(blocks)
    n_rows = blocks.agg(F.sum("n_rows")).first()[0] or 0
    matrix = share(communication_matrix(blocks, shards, seed))
    matrix = matrix.withColumnsRenamed({"block": block, "to": to})

    shard_of = F.arrow_udf(_dealt(seed), returnType=T.ShortType())
    dealt = (
        stored.withColumn(block, number)
        .join(matrix, block)
        .withColumn("shard", shard_of(_quoted(at), _quoted(to)).cast("int"))
        .drop(to, block)
    )
    # the second shuffle: a random cell of the shard, a random order inside it
    cells = max(1, math.ceil(n_rows / shards / CELL_ROWS))
    draw = F.xxhash64(F.lit(seed), _quoted(at))
    dealt = dealt.withColumn(cell, F.pmod(draw, F.lit(cells)))
    # which cell a row falls in is no random order inside it, so draw again
    order = [F.xxhash64(_quoted(at), F.lit(seed + 1)), _quoted(at)]
    inside = F.row_number().over(Window.partitionBy("shard", cell).orderBy(*order)) - 1
    sizes = dealt.groupBy("shard", cell).agg(F.count(F.lit(1)).alias(made))
    earlier = Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "shard", cell, F.coalesce(F.sum(made).over(earlier), F.lit(0)).alias(before)
    )
    placed = dealt.withColumn(made, inside).join(starts, ["shard", cell])
    return placed.select(
        *[_quoted(c) for c in kept],
        "shard",
        (_quoted(before) + _quoted(made)).cast("long").alias("slot"),
    )


def _dealt(seed: int):
    mask = (1 << INNER_BITS) - 1

    def shard_of(at: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        held: tuple[int, np.ndarray] = (-1, np.empty(0, np.int16))
        for numbers, counts in at:
            numbers = numbers.to_numpy(zero_copy_only=False)
            out = np.empty(len(numbers), np.int16)
            blocks = numbers >> INNER_BITS
            edges = np.flatnonzero(np.diff(blocks)) + 1
            for a, b in zip([0, *edges], [*edges, len(numbers)]):
                if a == b:
                    continue
                if held[0] != blocks[a]:
                    held = (int(blocks[a]), _labels(seed, int(blocks[a]), counts[int(a)].as_py()))
                out[a:b] = held[1][numbers[a:b] & mask]
            yield pa.array(out, pa.int16())

    shard_of.__annotations__ = {
        "at": Iterator[tuple[pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    return shard_of
