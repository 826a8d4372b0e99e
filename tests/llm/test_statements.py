"""The queries against their DuckDB statements."""

from __future__ import annotations

import pytest
from compare import connect, differences
from llm_tables import SMALL

from tidyledger.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_statement(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    assert differences(got, duck, ORACLE[name]) == [] and not got.isEmpty()


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
