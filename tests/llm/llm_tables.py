"""Inputs of the tests in this folder."""

from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """documents((doc_id, text[, lang, source]), ...) -> DataFrame with the columns of documents"""

    def make(*values):
        rows = [(*v, *("en", "s")[len(v) - 2 :]) for v in values]
        rows = [(*r, None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make
