"""Every registered query equals its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from loomdex.plans.oracle import ORACLE
from loomdex.plans.queries import QUERIES
from tests.conftest import SF

TABLES = "customer documents pages benchmark labels".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in rel.fetchall())
