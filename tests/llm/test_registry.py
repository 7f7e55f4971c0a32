"""Registered queries with SQL give the SQL's rows."""

import pytest

from lexcurate.llm import registry
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, name):
    ok, message, _ = compare(spark, duck(SF), name, registry.QUERIES[name], registry.ORACLE_SQL[name], SF)
    assert ok, message
