"""Accuracy and weighted F1 from confusion counts equal Spark's evaluator on
arbitrary label/prediction sets (classes never predicted, classes only
predicted, a single class)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from tessera.operators import evaluate

pairs = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs)
def test_metrics_match_evaluator(spark, rows):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rows], "label_indexed double, prediction double")
    mine = evaluate.metrics(df).first()
    for metric, col in (("accuracy", "accuracy"), ("f1", "f1")):
        ev = MulticlassClassificationEvaluator(labelCol="label_indexed", metricName=metric).evaluate(df)
        assert math.isclose(mine[col], ev, rel_tol=1e-12, abs_tol=1e-15), (metric, rows)
    assert mine["n"] == len(rows)
