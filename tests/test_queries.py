"""Every registered query against its SQL, on the smallest test data."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from specloom.operators.resolve import CORE_PRODUCT_COLUMNS
from specloom.oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) == []


def test_entry_is_the_core_comparison(spark):
    df = entry(spark)
    assert df.columns[:8] == CORE_PRODUCT_COLUMNS
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_has_no_product_and_no_python_rows(spark, name):
    """No cross or nested-loop join, and no row-at-a-time Python, in any plan."""
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
