from __future__ import annotations

import pytest

from barlake.llm.common import written

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def scratch(spark):
    return spark


@pytest.fixture
def docs(scratch):
    """Documents as a written table from (doc_id, text[, lang, source]) rows."""
    def make(rows, parts: int = 2):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
        return written(scratch.createDataFrame(full, SCHEMA).repartition(parts), "test-documents")
    return make


@pytest.fixture(scope="session")
def small(scratch):
    """The smallest test documents."""
    return scratch.read.parquet("/root/testdata/sf0.001/documents.parquet")
