"""Every registered query against its SQL, on the smallest driver tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import QUERIES, SQL
from tests.oracle import connect, difference, spark_rows
from tests.test_ranking import explain


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    plan = explain(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("ArrowEvalPython" in plan) == (name == "enrich_replies") and "BatchEvalPython" not in plan
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        columns, rows = spark_rows(df)
        assert columns and rows


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
