"""Queries that SQL can express equal DuckDB at sf0.01; native ones have no Python in their plans."""

import os
import sys

import pytest

from tessera.llm.registry import ORACLE_SQL, QUERIES

from .conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(__file__))), "tools"))
NATIVE = ("op7_mix_sources", "op8_secrets", "op10_url_filter")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, name):
    import oracle_check
    con = oracle_check.duck(SF)
    ok, msg = oracle_check.compare(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df())
    assert ok, msg


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin") if n in plan]


def test_query_names():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
