"""Every registered query against its DuckDB oracle (row count, schema, values).

Runs on sf0.001 by default (set JOBFACTS_ORACLE_SF_DIR for another scale); the driver
runs the same comparison at sf0.01.
"""

import os

import pytest

import __spark_entry__ as entry
from jobfacts import oracle, registry
from tools.compare_oracle import compare, duck_connection

SF_DIR = os.environ.get("JOBFACTS_ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.queries()
SQL = oracle.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, QUERIES[name], SQL[name], SF_DIR)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 55
    assert df.count() > 0
