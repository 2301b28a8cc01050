"""Every registered query against its DuckDB oracle on the sf0.001 tables,
plus the driver contract of ``__spark_entry__``."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from oracle_check import compare, duck_connection
from perkspark.oracle.queries import ORACLE_SQL
from perkspark.plans.registry import QUERIES as REGISTERED

QUERIES = {name: fn for name, fn in entry.queries().items() if name in REGISTERED}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in ORACLE_SQL}


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], con)
    assert res["match"], res


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.count() >= 1
    assert df.columns == entry.entry(spark).columns
