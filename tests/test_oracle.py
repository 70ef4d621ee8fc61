"""Every query with an oracle equals DuckDB at sf0.01 (rows, columns, values)."""

import pytest

from conftest import SF_CHECK
from tessera.plans.catalog import QUERIES
from tessera.plans.oracle import oracle_sql

# the wide grid-search queries (80 pipeline fits each) have no SQL oracle; their exact siblings
# run the same code on tables whose fits are closed-form
EXACT = sorted(oracle_sql())


# plan nodes no registered query may contain: cross joins, Python UDF
# evaluation (row-at-a-time or Arrow)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", EXACT)
def test_matches_duckdb(spark, duck, name):
    import oracle_check
    df = QUERIES[name](spark, SF_CHECK)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN if n in plan], plan
    sdf = df.toPandas()
    ddf = duck.execute(oracle_sql()[name]).df()
    ok, msg = oracle_check.compare(sdf, ddf)
    assert ok, msg


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(oracle_sql())
    assert rows_only <= {"logistic_elastic_net", "selected_logistic_fit", "cv_grid_metrics",
                         "cv_best_params", "tune_logistic", "tree_experiment", "tuned_logistic_experiment",
                         "selected_logistic_experiment",
                         "baseline_comparison"}


@pytest.mark.parametrize("name", ["document_quality", "orders_flags", "orders_binary", "events_nulls",
                                  "events_correlated", "bucketed_select", "lineitem_rule", "lineitem_encode"])
def test_fixture_matches_duckdb(spark, duck, name):
    """The fixtures behind the rows-only queries equal their SQL definitions."""
    import oracle_check
    from tessera.plans import oracle
    from tessera.sources import fixtures as fx
    sql = {"document_quality": oracle.DOCUMENT_QUALITY, "orders_flags": oracle.ORDERS_FLAGS,
           "orders_binary": oracle.ORDERS_BINARY, "events_nulls": oracle.EVENTS_NULLS,
           "events_correlated": oracle.EVENTS_CORRELATED, "bucketed_select": oracle.BUCKETED_SELECT,
           "lineitem_rule": oracle.LINEITEM_RULE, "lineitem_encode": oracle.LINEITEM_ENCODE}[name]
    ok, msg = oracle_check.compare(fx.FIXTURES[name](spark, SF_CHECK).df.toPandas(), duck.execute(sql).df())
    assert ok, msg
