"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from meteoframe import oracle, registry
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in E.queries().items() if n in registry.all_queries()}
ORACLE = {n: s for n, s in E.oracle_sql().items() if n in oracle.ORACLE}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["DATE", "STN_ID", "STN_KO", "LON", "LAT", "PM10", "DUST_STATUS"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["ok"], r
