"""CSV records that may hold line breaks, from files that are split over tasks.

A line break ends a record unless an odd number of quotes stands before it in the
file. Lines are read as Spark splits the files. One pass counts the quotes of each
split, a running sum over a file's splits says which of them begin inside a quoted
cell, and a second pass joins the lines between two record ends. A record that
crosses splits arrives in pieces, which are put together by file and position.

Quotes are as RFC 4180 has them: they enclose whole cells and are doubled inside.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.operators.shared import share
from stallbook.sources import files

#: First guess at the bytes that hold a file's header.
HEAD_BYTES = 2**16
WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str | list[str], split_bytes: int | None) -> DataFrame:
    """Lines with their file and where the split begins that they are in.

    Both passes must cut the files at the same places, but Spark also cuts by the
    number of cores it finds. So the scan belongs to a session of its own, in
    which that number and the size of a split stay what they are now."""
    own = spark.newSession()
    size = split_bytes or spark.conf.get("spark.sql.files.maxPartitionBytes")
    own.conf.set("spark.sql.files.maxPartitionBytes", size)
    own.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    if split_bytes:
        own.conf.set("spark.sql.files.openCostInBytes", 0)
    lines = (
        own.read.option("lineSep", "\n")
        .text(path)
        .select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("start"))
    )
    # what is made from the lines runs in the caller's session
    return spark.createDataFrame([], lines.schema).union(lines)


def quotes(name: str) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit('"')))


def _in_tasks(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Several splits to a task where they are small: tasks of about the session's
    size of a split, and no fewer than there are cores. Splits stay what they are,
    so records are cut at the same places."""
    paths = lines.inputFiles()
    size = files.size(spark, paths)
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // files.split_size(spark)))
    return lines.coalesce(tasks)


def begin_inside(lines: DataFrame) -> tuple[dict[str, set[int]], bool]:
    """Where the splits begin, by file, that begin inside a quoted cell, on the
    driver: at most a number for each split, of 128 MB as a rule, and most files
    have none. And whether some file ends inside a cell."""
    splits = lines.groupBy("file_path", "start").agg(F.sum(quotes("value")).alias("quotes"))
    upto = Window.partitionBy("file_path").orderBy("start")
    after = splits.withColumn("after", F.sum("quotes").over(upto) % 2)
    begun = F.lead("start").over(upto)
    rows = after.withColumn("next", begun).where("after = 1").select("file_path", "next").collect()
    found: dict[str, set[int]] = {}
    for r in rows:
        if r.next is not None:
            found.setdefault(r.file_path, set()).add(r.next)
    return found, any(r.next is None for r in rows)


def _cutter(inside: dict[str, set[int]], skip: int):
    whole, head, tail, middle = WHOLE, HEAD, TAIL, MIDDLE

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        key, parity, pending, left, held = None, 0, False, 0, []
        names = ["value", "file_path", "start", "kind"]

        def made(values: pa.Array, kinds: list | np.ndarray) -> pa.RecordBatch:
            n = len(values)
            columns = [
                values.cast(pa.string()),
                pa.array([key[0]] * n, pa.string()),
                pa.array([key[1]] * n, pa.int64()),
                pa.array(kinds, pa.int32()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def closed() -> Iterator[pa.RecordBatch]:
            """What a split leaves open: its last record goes on in the next one."""
            if left:
                raise ValueError(f"{key[0]}: its first {skip} records end beyond the first split")
            if held:
                text = "\n".join(x for part in held for x in part.to_pylist())
                yield made(pa.array([text]), [middle if pending else tail])

        for batch in batches:
            paths, starts = batch.column(1), batch.column(2).to_numpy()
            ends = pc.run_end_encode(paths).run_ends.to_numpy()
            edges = np.union1d(ends, np.flatnonzero(np.diff(starts)) + 1).tolist()
            for a, b in zip([0, *edges], edges):
                now = (paths[a].as_py(), int(starts[a]))
                if now != key:
                    if key is not None:
                        yield from closed()
                    key, held = now, []
                    parity = int(now[1] in inside.get(now[0], ()))
                    pending = bool(parity)
                    left = skip if now[1] == 0 else 0
                values = batch.column(0).slice(a, b - a)
                quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
                after = (parity + np.cumsum(quotes)) & 1
                parity = int(after[-1])
                ends_at = np.flatnonzero(after == 0) + 1
                if not len(ends_at):
                    held.append(values)
                    continue
                before = sum(len(x) for x in held)
                joined = pa.concat_arrays([*held, values]) if held else values
                ends_at = ends_at + before
                rest = joined.slice(int(ends_at[-1]))
                held = [rest] if len(rest) else []
                records = joined.slice(0, int(ends_at[-1]))
                if len(ends_at) < len(records):
                    offsets = pa.array(np.concatenate([[0], ends_at]), pa.int32())
                    records = pc.binary_join(pa.ListArray.from_arrays(offsets, records), "\n")
                kinds = np.zeros(len(records), np.int32) + whole
                if pending:
                    kinds[0], pending = head, False
                if left:
                    filled = np.flatnonzero(pc.not_equal(pc.utf8_trim_whitespace(records), ""))
                    dropped = int(filled[:left][-1]) + 1 if len(filled) else 0
                    left -= len(filled[:left])
                    records, kinds = records.slice(dropped), kinds[dropped:]
                if len(records):
                    yield made(records, kinds)
        if key is not None:
            yield from closed()

    return cut


def records(
    spark: SparkSession, path: str | list[str], skip: int = 1, split_bytes: int | None = None
) -> DataFrame:
    """(value, file_path): the text of every record that is not blank, without the
    first ``skip`` of each file. Line breaks inside cells stay as they are; a
    carriage return before the end of a record is dropped. A last record whose
    quote is never closed is returned with all lines to the end of the file.
    ``split_bytes`` is the size of a task's piece of a file, by default the
    session's; the skipped records must lie in the first one."""
    lines = _in_tasks(spark, _lines(spark, path, split_bytes))
    inside, unclosed = begin_inside(lines)
    cut = lines.mapInArrow(
        _cutter(inside, skip), "value string, file_path string, start long, kind int"
    )
    out = cut.where(F.col("kind") == WHOLE).select("value", "file_path")
    if not inside and not unclosed:
        return _filled(out)
    # pieces: of records over several splits, or of one that is never closed; a few
    # for each split, stored since they are numbered and joined
    pieces = share(cut.where(F.col("kind") != WHOLE))
    keys = ["file_path", "start", "kind"]
    order = Window.partitionBy("file_path").orderBy("start", "kind")
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    numbered = pieces.select(keys).withColumn("record", number)
    joined = (
        pieces.join(numbered, keys)
        .groupBy("file_path", "record")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "value"))).alias("parts"))
        .select(F.array_join("parts.value", "\n").alias("value"), "file_path")
    )
    return _filled(out.unionByName(joined))


def _filled(texts: DataFrame) -> DataFrame:
    return texts.withColumn("value", F.regexp_replace("value", r"\r$", "")).where(
        F.trim("value") != ""
    )


def headers(spark: SparkSession, path: str | list[str], row: int = 1) -> dict[str, list[str]]:
    """The cells of the ``row``-th record (blank lines do not count) of every file,
    by the file's address. Only the first bytes of each file are read."""
    paths = spark.read.text(path).inputFiles()

    def cells(uri: str) -> tuple[str, list[str]]:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        # as the rows' metadata have it
        name, size = at.toString(), HEAD_BYTES
        address = spark._jvm.org.apache.hadoop.fs.Path(name).toUri().toString()
        while True:
            raw = files.head(spark, name, size)
            text = raw.decode("utf-8-sig", "replace")
            found = [r for r in csv.reader(io.StringIO(text, newline="")) if "".join(r).strip() or len(r) > 1]
            # the last record read may go on behind these bytes
            if len(found) > row or len(raw) < size:
                return address, found[row - 1] if len(found) >= row else []
            size *= 8

    with ThreadPoolExecutor(16) as pool:
        return dict(pool.map(cells, paths))


#: Orders of columns that are told apart in the row; more are joined.
LAYOUTS = 16


def by_names(
    spark: SparkSession, df: DataFrame, cells: list[str], places: Mapping[str, list[int]], names: list[str]
) -> DataFrame:
    """Columns ``names`` out of the text columns ``cells``, whose order is told by
    each row's ``file_path``: ``places`` has one short list for each file. Files
    mostly share a few orders, and then no row has to be joined."""
    kept = [c for c in df.columns if c not in cells]
    layouts: dict[tuple[int, ...], list[str]] = {}
    for file, found in places.items():
        layouts.setdefault(tuple(found), []).append(file)
    if layouts and len(layouts) <= LAYOUTS:
        (usual, _), *others = sorted(layouts.items(), key=lambda x: -len(x[1]))

        def cell(i: int) -> Column:
            c = F.col(cells[usual[i] - 1])
            for found, of in others:
                if found[i] != usual[i]:
                    c = F.when(F.col("file_path").isin(of), F.col(cells[found[i] - 1])).otherwise(c)
            return c

        return df.select(*[cell(i).alias(n) for i, n in enumerate(names)], *kept)
    table = spark.createDataFrame(list(places.items()), "file_path string, _places array<int>")
    row = F.array(*[F.col(c) for c in cells])
    taken = [F.element_at(row, F.col("_places")[i]).alias(n) for i, n in enumerate(names)]
    return df.join(table, "file_path").select(*taken, *kept)
