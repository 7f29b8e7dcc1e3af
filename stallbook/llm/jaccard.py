"""Near-duplicate texts by the Jaccard similarity of their word shingles, with a
chosen-path join: at each node of a random tree a set follows one or two of its
own tokens, sampled by a hash that all sets share, so similar sets stay together;
small buckets are compared whole, and runs are repeated until the wanted recall.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import components, raw_texts, text_slices, word_list
from stallbook.llm.embed_dedup import forest
from stallbook.operators.shared import share

SHINGLE = 5
#: Similarity of at least 4/5, as a fraction so that the test is exact.
ABOVE, BELOW = 4, 5
RECALL = 0.9995
#: A set goes on with 1/0.8 = 1.25 tokens on average: one always, a second in a
#: quarter of the nodes.
SECOND = 4
FIRST_DEPTH, LAST_DEPTH = 2, 4
#: Buckets with more sets are split again, or compared in blocks of this size.
BUCKET = 256
BLOCK = 512
#: A bucket of which one child keeps this share holds sets that are all alike.
ALIKE = 0.6
#: Bits that mark the rows to move (8 MB).
MARKS = 2**26
MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """Runs after which two sets of that similarity have met with the wanted
    probability, even if their bucket is split down to ``depth``."""
    meet = 1.0
    for _ in range(depth):
        one = similarity * meet
        meet = 1 - (1 - one) * ((SECOND - 1) / SECOND + (1 - one) / SECOND)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of some texts, and the words per text."""
    words = [word_list(t) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = [w for own in words for w in own]
    if not flat:
        return np.zeros(0, np.uint64), n
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    data = np.frombuffer(b"".join(flat), np.uint8).astype(np.uint64) + np.uint64(1)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), MIX, np.uint64))
    data *= powers[place]
    return mix(np.add.reduceat(data, starts)), n


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``size`` words of each text; fewer
    words are one shingle, no word is none."""
    h, n = word_hashes(texts)
    ends = np.cumsum(n)
    code = np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for k in range(size):
        code = code * MIX + h[k : len(h) - size + 1 + k]
    code = mix(code)
    out = []
    for e, m in zip(ends.tolist(), n.tolist()):
        if m >= size:
            out.append(np.unique(code[e - m : e - size + 1]))
        elif m:
            whole = m
            for x in h[e - m : e].tolist():
                whole = (whole * int(MIX) + x) % 2**64
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def step(tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, paths: np.ndarray):
    """(set, path) after one more token: each set follows the token with the
    smallest hash under a seed of its path, and a second one under another seed
    if the path says so."""
    rows, out = [], []
    every = np.arange(len(paths))
    for salt in (0, 1):
        seed = mix(paths + np.uint64((salt + 1) * int(MIX) % 2**64))
        own = every if salt == 0 else np.flatnonzero(mix(paths ^ MIX) % np.uint64(SECOND) == 0)
        if not len(own):
            continue
        if len(own) == len(every):
            part, part_starts, part_sizes = tokens, starts, sizes
        else:
            part_sizes = sizes[own]
            part_starts = np.cumsum(part_sizes) - part_sizes
            at = np.arange(int(part_sizes.sum())) - np.repeat(part_starts, part_sizes)
            part = tokens[at + np.repeat(starts[own], part_sizes)]
        code = mix(part ^ np.repeat(seed[own], part_sizes))
        rows.append(own)
        out.append(mix(np.minimum.reduceat(code, part_starts) + seed[own]))
    return np.concatenate(rows), np.concatenate(out)


def deeper(sets: list[np.ndarray], paths: np.ndarray, depth: int):
    """(set, path) after ``depth`` steps of non-empty sets from their paths."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets)
    starts = np.cumsum(sizes) - sizes
    rows = np.arange(len(sets))
    for _ in range(depth):
        if len(rows) == len(sets) and (rows == np.arange(len(sets))).all():
            own, paths = step(tokens, starts, sizes, paths)
            rows = rows[own]
            continue
        part_sizes = sizes[rows]
        part_starts = np.cumsum(part_sizes) - part_sizes
        at = np.arange(int(part_sizes.sum())) - np.repeat(part_starts, part_sizes)
        part = tokens[at + np.repeat(starts[rows], part_sizes)]
        own, paths = step(part, part_starts, part_sizes, paths)
        rows = rows[own]
    return rows, paths


def shared_tokens(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``left`` with sets ``right``. Tokens of
    many sets go through a matrix product, the others through their postings."""
    if len(left) == len(right) == 1:
        a, b = sets[left[0]], sets[right[0]]
        return np.array([[len(np.intersect1d(a, b, assume_unique=True))]])
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place_l = np.full(len(sets), -1)
    place_l[left] = np.arange(len(left))
    place_r = np.full(len(sets), -1)
    place_r[right] = np.arange(len(right))
    out = np.zeros((len(left), len(right)), np.float32)
    dense = np.flatnonzero((times > 1) & (times > len(sets) / 8))
    column = np.full(len(times), -1)
    for k in range(0, len(dense), 4096):
        some = dense[k : k + 4096]
        column[:] = -1
        column[some] = np.arange(len(some))
        mine = np.flatnonzero(column[token] >= 0)
        a = np.zeros((len(left), len(some)), np.float32)
        b = a if left is right else np.zeros((len(right), len(some)), np.float32)
        for m, place in ((a, place_l), (b, place_r)):
            there = mine[place[owner[mine]] >= 0]
            m[place[owner[there]], column[token[there]]] = 1
        out += a @ b.T
    out = out.astype(np.int64)
    rare = (times > 1) & (times <= len(sets) / 8)
    keep = np.flatnonzero(rare[token] & (place_r[owner] >= 0))
    order = keep[np.argsort(token[keep], kind="stable")]
    posted = place_r[owner[order]]
    first = np.searchsorted(token[order], np.arange(len(times) + 1))
    offsets = np.cumsum(sizes) - sizes
    for i, s in enumerate(left.tolist()):
        own = token[offsets[s] : offsets[s] + sizes[s]]
        own = own[rare[own]]
        n = first[own + 1] - first[own]
        if n.sum():
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[own], n)
            out[i] += np.bincount(posted[at], minlength=len(right))
    return out


def compare(work: pa.Table) -> pa.Table:
    """The links inside one bucket, or between two of its blocks: a count for
    each set, and a tree that joins what is linked. A pair counts only in the
    first bucket, by path, that both sets share."""
    side = work.column("side").to_numpy()
    same = work.column("l")[0] == work.column("r")[0]
    here = work.column("path")[0].as_py()
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    raw = work.column("tokens").to_pylist()
    sets = [np.frombuffer(x, np.uint64) for x in raw]
    n = np.array([len(s) for s in sets])
    if same and len(left) == 2:
        both = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))], [0, 0]])
    elif len(left) and len(right):
        both = shared_tokens(sets, left, right)
    else:
        both = np.zeros((len(left), len(right)), np.int64)
    hit = (ABOVE + BELOW) * both >= ABOVE * (n[left][:, None] + n[right][None, :])
    if same:
        hit = np.triu(hit, 1)
    if hit.any():
        by_path: dict[int, list[int]] = {}
        for i, paths in enumerate(work.column("paths").to_pylist()):
            for p in paths:
                if p < here:
                    by_path.setdefault(p, []).append(i)
        at_l = {x: k for k, x in enumerate(left.tolist())}
        at_r = {x: k for k, x in enumerate(right.tolist())}
        for rows in by_path.values():
            if len(rows) > 1:
                a = [at_l[x] for x in rows if x in at_l]
                b = [at_r[x] for x in rows if x in at_r]
                hit[np.ix_(a, b)] = False
    x, y = np.nonzero(hit)
    x, y = left[x], right[y]
    copies = work.column("copies").to_numpy()
    links = np.bincount(x, copies[y], len(n)) + np.bincount(y, copies[x], len(n))
    texts = np.bincount(x, minlength=len(n)) + np.bincount(y, minlength=len(n))
    tree = forest(zip(x.tolist(), y.tolist()), len(n))
    names = work.column("set").combine_chunks()
    has = np.flatnonzero(texts)
    a = names.take(pa.array([i for i, _ in tree], pa.int64()))
    b = names.take(pa.array([j for _, j in tree], pa.int64()))
    none = np.zeros(len(tree), np.int64)
    return pa.table(
        {
            "a": pa.concat_arrays([names.take(pa.array(has, pa.int64())), a]),
            "b": pa.concat_arrays([pa.nulls(len(has), names.type), b]),
            "links": np.concatenate([links[has].astype(np.int64), none]),
            "texts": np.concatenate([texts[has], none]),
        }
    )


def read_sets(keyed: DataFrame, id_kind: str, runs: int) -> DataFrame:
    """One row per document: its id, the digests of its text and of its shingle
    set, and the set's paths after the first steps of every run."""

    def read(batches):
        for batch in batches:
            ids, texts = batch.column("id"), raw_texts(batch.column("text"))
            for a, b in text_slices(texts, 1_000_000):
                sets = shingle_sets(texts[a:b])
                full = [i for i, s in enumerate(sets) if len(s)]
                paths: list[list[int]] = [[] for _ in sets]
                for run in range(runs if full else 0):
                    root = np.full(len(full), mix(np.array([run + 1], np.uint64))[0])
                    rows, found = deeper([sets[i] for i in full], root, FIRST_DEPTH)
                    for r, p in zip(rows.tolist(), found.view(np.int64).tolist()):
                        paths[full[r]].append(p)
                digests = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        batch.column("text_key").slice(a, b - a),
                        pa.array(digests, pa.binary()),
                        pa.array([sorted(set(p)) for p in paths], pa.list_(pa.int64())),
                    ],
                    names=["id", "text_key", "set", "paths"],
                )

    return keyed.select("id", "text_key", "text").mapInArrow(
        read, f"id {id_kind}, text_key binary, set binary, paths array<long>"
    )


def may_match(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys may be among the wanted ones, by bits of a hash: texts and
    sets that match nothing are not moved by the join that follows, which drops the
    few rows too many. The bits are a table of ``MARKS`` / 8 bytes at most, whatever
    the input."""
    mark = F.pmod(F.xxhash64(*keys), F.lit(MARKS))
    bits = share(
        wanted.select(mark.alias("mark"))
        .groupBy(F.bitmap_bucket_number("mark").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("bits"))
    )
    bit = F.bitmap_bit_position("mark")
    byte = F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))
    on = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), bit % 8) == 1
    marked = rows.withColumn("mark", mark).withColumn("bucket", F.bitmap_bucket_number("mark"))
    return marked.join(F.broadcast(bits), "bucket").where(on).select(*rows.columns)


def split(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(path, child, set): members of buckets one step further down."""

    def go(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column("tokens").to_pylist()
            for a in range(0, len(raw), 256):
                some = [np.frombuffer(x, np.uint64) for x in raw[a : a + 256]]
                paths = batch.column("path").slice(a, 256).to_numpy().view(np.uint64)
                rows, child = deeper(some, paths, 1)
                at = pa.array(rows + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("path").take(at),
                        pa.array(child.view(np.int64)),
                        batch.column("set").take(at),
                    ],
                    names=["path", "child", "set"],
                )

    return (
        members.join(may_match(sets.select("set", "tokens"), members, "set"), "set")
        .select("path", "set", "tokens")
        .mapInArrow(go, "path long, child long, set binary")
    )


def sized(members: DataFrame) -> DataFrame:
    """Buckets of at least two sets; of buckets with the same sets the first."""
    h = F.xxhash64("set")
    buckets = members.groupBy("path").agg(
        F.count("*").alias("n"),
        F.bit_xor(h).alias("x"),
        F.sum(F.pmod(h, F.lit((1 << 31) - 1))).alias("s"),
    )
    return buckets.where("n > 1").groupBy("n", "x", "s").agg(F.min("path").alias("path"))


def in_buckets(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The buckets to compare, and their members (set, path, n) with the bucket's
    size, so that no later step joins members by path again."""
    buckets = share(sized(members))
    return buckets, share(members.join(buckets.select("path", "n"), "path"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key`` (digest of the text),
    ``class_id`` (smallest id among the documents that links lead to),
    ``n_links`` (other documents with a similarity of 0.8 or more, copies
    included), ``n_texts`` (other shingle sets among these), ``kept`` (one
    document of each class).

    Shingles are five words, lower-case; a text of fewer words is one shingle.
    Links are exact: whole sets are compared. A pair is found with a probability
    of at least ``recall``, more if it is more similar. Equal sets are one set
    with a number of copies. Buckets are cut into blocks, a task holds two of
    them and returns counts and a tree of links, not pairs.

    Null texts and texts without words link with nothing: each is a class of its
    own. Rows without an id are linked like others, the class then has the
    smallest id that there is, or null. Repeated rows are copies, one is kept. An
    empty table stays empty; further columns are left out.
    """
    id_kind = docs.schema[doc_id].dataType.simpleString()
    keyed = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        F.unhex(F.md5(F.coalesce(f"`{text}`", F.lit("")).cast("binary"))).alias("text_key"),
        F.col(f"`{text}`").alias("text"),
    )
    runs = runs_for(recall, ABOVE / BELOW, LAST_DEPTH)
    read = read_sets(keyed, id_kind, runs).withColumn("row", F.monotonically_increasing_id())
    rows = share(read)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "text_key"))
    classes = share(
        rows.where("set is not null")
        .groupBy("set")
        .agg(F.count("*").alias("copies"), first.alias("first"), F.first("paths").alias("paths"))
    )
    members = classes.select("set", F.explode("paths").alias("path"))
    buckets, final = in_buckets(members)

    # Whole sets of those that share a bucket with another.
    candidates = classes.join(final.select("set").distinct(), "set", "left_semi").select(
        "set", "copies", "first.id", "first.text_key"
    )
    texts = may_match(keyed, candidates, "text_key", "id").alias("d").join(
        candidates.alias("c"),
        (F.col("d.text_key") == F.col("c.text_key")) & F.col("d.id").eqNullSafe(F.col("c.id")),
    )

    def whole(batches):
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for a, b in text_slices(texts, 1_000_000):
                sets = [s.tobytes() for s in shingle_sets(texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("set").slice(a, b - a),
                        batch.column("copies").slice(a, b - a),
                        pa.array(sets, pa.binary()),
                    ],
                    names=["set", "copies", "tokens"],
                )

    sets = share(
        texts.select("c.set", "c.copies", "d.text")
        .mapInArrow(whole, "set binary, copies long, tokens binary")
        .dropDuplicates(["set"])
    )

    for _ in range(FIRST_DEPTH, LAST_DEPTH):
        large = buckets.where(F.col("n") > BUCKET).select("path", F.col("n").alias("size"))
        if large.isEmpty():
            break
        children = share(split(final.where(F.col("n") > BUCKET), sets))
        most = children.groupBy("path", "child").count().groupBy("path").agg(
            F.max("count").alias("most")
        )
        parted = share(large.join(most, "path").where(F.col("most") < ALIKE * F.col("size")))
        if parted.isEmpty():
            break
        parted = parted.select("path")
        fresh = children.join(parted, "path", "left_semi").select("set", F.col("child").alias("path"))
        rest = final.join(parted, "path", "left_anti").select("set", "path")
        members = share(rest.unionByName(fresh).distinct())
        buckets, final = in_buckets(members)

    # Blocks of a bucket by a hash of the set; a unit compares two of them.
    own_paths = final.groupBy("set").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    placed = final.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn(
        "b", F.pmod(F.xxhash64("set"), "blocks")
    )
    as_left = F.transform(
        F.sequence("b", F.col("blocks") - 1),
        lambda o: F.struct(F.col("b").alias("l"), o.alias("r"), F.lit(0).alias("side")),
    )
    as_right = F.when(
        F.col("b") > 0,
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("b") - 1),
            lambda o: F.struct(o.alias("l"), F.col("b").alias("r"), F.lit(1).alias("side")),
        ),
    ).otherwise(F.array().cast("array<struct<l:bigint,r:bigint,side:int>>"))
    units = placed.withColumn("u", F.explode(F.concat(as_left, as_right))).select(
        "path", "u.l", "u.r", "u.side", "set"
    )
    found = share(
        units.join(sets.join(own_paths, "set"), "set")
        .groupBy("path", "l", "r")
        .applyInArrow(compare, "a binary, b binary, links long, texts long")
    )

    links = found.where("b is null").groupBy(F.col("a").alias("set")).agg(
        F.sum("links").alias("links"), F.sum("texts").alias("texts")
    )
    groups = components(found.where("b is not null").select("a", "b"))
    labelled = share(
        classes.select("set", "copies", "first")
        .join(links, "set", "left")
        .join(groups.withColumnRenamed("id", "set"), "set", "left")
        .withColumn("component", F.coalesce("component", "set"))
    )
    heads = labelled.groupBy("component").agg(F.min("first").alias("head"))
    by_set = labelled.join(heads, "component").select(
        "set",
        F.col("head.id").alias("class_id"),
        F.col("head.row").alias("head_row"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_texts"),
    )
    out = rows.select("id", "text_key", "row", "set").join(by_set, "set", "left")
    alone = F.col("head_row").isNull()
    return out.select(
        F.col("id").alias(doc_id),
        "text_key",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"),
        (alone | (F.col("row") == F.col("head_row"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all columns; a
    row that is repeated with its id stays once."""
    found = near_duplicates(docs, doc_id, text)
    kept = found.where("kept").select(F.col(doc_id).alias("__id"), "text_key").distinct()
    key = F.unhex(F.md5(F.coalesce(f"`{text}`", F.lit("")).cast("binary")))
    named = docs.withColumn("__key", key).withColumn("__own", F.col(f"`{doc_id}`"))
    same = (F.col("__key") == F.col("text_key")) & F.col("__own").eqNullSafe(F.col("__id"))
    left = named.join(kept, same, "left_semi")
    return left.dropDuplicates(["__key", "__own"]).drop("__key", "__own")
