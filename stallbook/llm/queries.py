"""Registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import (
    alignment,
    decontaminate,
    embed_dedup,
    html_extract,
    jaccard,
    langid,
    licences,
    lm,
    packing,
    quality,
    sharding,
    suffix_dedup,
    whitening,
)
from stallbook.llm.common import held_out, small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.score(docs, docs.where(~held_out("doc_id", 7)))
    return scored.select(
        "doc_id",
        held_out("doc_id", 7).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), unnamed=True)
    n_hit = F.size("hit_words").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


WORDS_SQL = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op2_decontamination"] = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS_SQL.format('text')}, []) AS w
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL.format('text')} AS w FROM benchmark
), bw AS (
    SELECT DISTINCT item, least(len(w), 10) AS k,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
    FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i)
    WHERE len(w) > 0
), sizes AS (SELECT DISTINCT k FROM bw),
dw AS (
    SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
    FROM d, sizes, unnest(range(1, len(w) - k + 2)) AS u(i)
    WHERE len(w) >= k
), m AS (SELECT r, i, k, item FROM dw JOIN bw USING (k, g)),
hit AS (
    SELECT r, count(DISTINCT p) AS n FROM m, unnest(range(i, i + k)) AS u(p) GROUP BY r
), items AS (
    SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
    FROM (SELECT DISTINCT r, item FROM m) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit,
    coalesce(items.n, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
    coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).drop("html")


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs).drop("text_key")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.count_tokens(docs).drop("text"))


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    """Learns from the labelled rows of ``docs`` that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.train(docs.select("doc_id", "text"), labels.where(~held_out("doc_id", 4)))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        held_out("doc_id", 4).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark, 250)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).drop("text", "spans")


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out("doc_id", 4)))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score")


@query
def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op9_embeddings"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
        row_number() OVER () AS r
    FROM embeddings
), ok AS (
    SELECT * FROM v
    WHERE label IS NOT NULL AND len(x) > 0 AND len([e FOR e IN x IF e IS NULL OR NOT isfinite(e)]) = 0
        AND list_dot_product(x, x) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
        ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r
    WHERE list_dot_product(a.x, b.x)
        / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.93
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
    vec_id <= coalesce(low.b, vec_id) AS kept
FROM v LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


@query
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs).drop("text")


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dealt = sharding.shuffle_into_shards(sized, shards=16, seed=11)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark, 250)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    white = whitening.whiten(vectors, "embedding", components=4)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return white.select(
        "vec_id", "deviation", "fit_rows", "identity_error", each
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.col("fit_rows").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )
