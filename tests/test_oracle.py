"""The correctness gate: every SQL-checkable query against its DuckDB twin
at sf0.01, plus the rows-only queries' smoke run and the entry contract."""

import pytest

import __spark_entry__ as E
from slawatch.plans import catalog
from oracle_harness import compare, duck
from paths import SF_ORACLE, SF_SMALL

ORACLE, QUERIES = catalog.ORACLE, catalog.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql_oracle(spark, con, name):
    res = compare(spark, name, SF_ORACLE, QUERIES[name], ORACLE[name], con)
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["issue_date", "region", "total_issues"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
