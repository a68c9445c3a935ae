"""Every registered query against its SQL, on the smallest given tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from gaugeline.plans import catalogue

TABLES = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES
SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="given tables are absent")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, name):
    found = QUERIES[name](spark, TABLES)
    expected = oracle.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SPARK_TYPES[t] for c, t in found.dtypes} == types
    columns = sorted(found.columns)
    spark_rows = sorted(repr(tuple(r[c] for c in columns)) for r in found.collect())
    places = [expected.columns.index(c) for c in columns]
    oracle_rows = sorted(repr(tuple(r[i] for i in places)) for r in expected.fetchall())
    assert spark_rows == oracle_rows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
