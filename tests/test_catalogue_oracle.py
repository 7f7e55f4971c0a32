"""Every catalogue query against its DuckDB oracle on the small driver tables."""
import pytest

import __spark_entry__ as E
from lexcurate.plans import catalogue, oracle
from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck

ORACLE = oracle.queries_sql()
QUERIES = catalogue.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_ORACLE)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["lang", "doc_type", "status", "n_docs", "avg_word_ratio"]
