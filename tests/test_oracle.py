"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.run_checks import compare

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, sf, name):
    rows, problem = compare(spark, con, sf, QUERIES[name], ORACLE.get(name))
    assert problem is None or problem.startswith("rows only"), problem
    assert rows > 0


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
