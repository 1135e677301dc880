"""The queries that SQL can express, and the shape of all."""

import re

import pytest

from oracle import compare, connect
from weirstone.llm.queries import CHECKS, QUERIES

NATIVE = ("op2_", "op3_", "op5_", "op9_")


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, sf, name):
    assert compare(connect(sf), QUERIES[name](spark, sf), CHECKS[name]) == ""


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(NATIVE)))
def test_native_plans(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan
