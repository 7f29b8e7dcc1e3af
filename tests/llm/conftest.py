from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts; ids count from 1 unless pairs are given."""

    def make(*texts, **more):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, 1)]
        full = [(i, t, more.get("lang", "en"), "s", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    """The smallest given documents, for comparisons with brute force."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
