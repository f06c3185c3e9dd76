"""Registered queries against their check SQL on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tools import check

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in check.TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    mine = check.canonical(frame.toPandas())
    if name in ORACLES:
        theirs = duck.execute(ORACLES[name]).df()
        assert sorted(frame.columns) == sorted(theirs.columns)
        assert mine == check.canonical(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
