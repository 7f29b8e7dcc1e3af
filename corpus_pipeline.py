"""The corpus pipeline: five stages that each work on all that the one before has
kept. Every stage but the last returns the columns of ``documents``; between
stages the rows are written as Parquet and read again, so a lost executor costs a
re-read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import decontaminate, jaccard, packing, quality, queries, suffix_dedup
from stallbook.llm.common import small_batches, table
from stallbook.operators.shared import scratch, shared_results
from stallbook.sources import files

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_SCORE = 0.7


def with_length(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go. It learns from the
    labels of these documents, apart from the held-out quarter."""
    scored = quality.score(docs, queries.quality_model(spark, sf_dir, docs))
    return scored.where(F.col("score") >= KEEP_SCORE).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links join, the one with the smallest id
    stays; documents without words are no group and stay."""
    return jaccard.one_of_each(docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes and more that stand elsewhere too are cut out of the
    texts; every document stays, with what is left of it."""
    return with_length(suffix_dedup.remove_repeats(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out of the texts; a document that
    holds no other words goes."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), unnamed=True)
    kept = found.where((F.size("hit_words") == 0) | (F.size("hit_words") < F.col("n_words")))
    return with_length(decontaminate.without_spans(kept))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: sequence, its length, offset."""
    counted = packing.count_tokens(docs).select("doc_id", "lang", "source", "n_tokens")
    return packing.pack(counted)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # five stages share the Python workers, so each gets by with little
        small_batches(spark, 250)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality", in_small_batches(quality_filter)),
    ("near_duplicates", in_small_batches(near_duplicates)),
    ("repeated_passages", in_small_batches(repeated_passages)),
    ("decontamination", in_small_batches(decontamination)),
    ("packing", in_small_batches(pack)),
]

#: SQL can express neither the classifier nor the packing; the stages are tested
#: against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``. What a stage shares goes when
    its result is written, and that result when the next one's is; the last
    stage's input stays until ``operators.shared.clear_shared``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        with shared_results(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            files.delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
