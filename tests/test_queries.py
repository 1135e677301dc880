"""Every registered query against its SQL check."""

import pytest

from __spark_entry__ import entry
from oracle import compare, connect
from weirstone.plans.registry import CHECKS, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    assert name in CHECKS
    assert compare(duck, df, CHECKS[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert slow not in plan


def test_entry(spark):
    assert entry(spark).count() > 0
