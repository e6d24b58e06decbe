"""Every query against its SQL, at the smallest scale."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_sql import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    if name in oracle_sql():
        assert differences(df, con, oracle_sql()[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).count() == 16
