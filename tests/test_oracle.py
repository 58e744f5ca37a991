"""Every registered query equals its SQL at the smallest scale, and the contract is consistent."""

import pytest
from oracle import compare

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan
    assert compare(result, SF_DIR, SQL[name]) == ""


def test_entry_has_rows(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["qid", "rank", "doc_id", "text", "distance"]
    assert rows.count() == 40 * 5
