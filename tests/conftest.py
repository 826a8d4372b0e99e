from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidyledger.session import local_session

    session = local_session(8, app="tests", memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows("a string, b int", ("x", 1), ...) -> DataFrame"""

    def make(ddl, *values):
        return spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], ddl)

    return make
