"""Shared by the tests of this folder (a second conftest would hide the first)."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """documents from texts (doc_id by place) or from (doc_id, text, source) rows."""
    def make(rows, extra=""):
        full = [(i, r, "en", "s", len(r or "")) if isinstance(r, str) or r is None
                else (r[0], r[1], "en", r[2], len(r[1] or "")) for i, r in enumerate(rows)]
        df = spark.createDataFrame(full, DOCS)
        for name in extra.split():
            df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return make
