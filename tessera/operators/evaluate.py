"""Accuracy and weighted F1 from one confusion-count aggregate.

``MulticlassClassificationEvaluator`` runs one job per metric and per frame.
Here the predictions of any number of groups (train/test split, seed, model)
are reduced in one aggregate to confusion counts ``(group..., label,
prediction, n)`` -- at most groups x classes^2 rows -- and both metrics are
computed from that small table:

* accuracy = sum of diagonal counts / N
* weighted F1 = sum over true classes c of  (n_true_c / N) * 2 tp_c / (n_true_c + n_pred_c)

which is Spark's ``weightedFMeasure`` (F1 of a class is 0 when it is never
predicted correctly; classes that are only predicted carry no weight).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(pred: DataFrame, label_col: str = "label_indexed", prediction_col: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """``(by..., label, prediction, n)`` counts (partial aggregation map-side)."""
    return (pred.groupBy(*by, F.col(label_col).alias("label"), F.col(prediction_col).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def metrics(pred: DataFrame, label_col: str = "label_indexed", prediction_col: str = "prediction",
            by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, accuracy, f1)`` for every group in one pass over ``pred``."""
    cm = confusion(pred, label_col, prediction_col, by)
    return metrics_from_confusion(cm, by)


def metrics_from_confusion(cm: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    keys = [F.col(b) for b in by] or [F.lit(0)]
    w_group = Window.partitionBy(*keys)
    w_true = Window.partitionBy(*keys, F.col("label"))
    w_pred = Window.partitionBy(*keys, F.col("prediction"))
    enriched = cm.select(
        *by, "label", "prediction", "n",
        F.sum("n").over(w_group).alias("total"),
        F.sum("n").over(w_true).alias("n_true"),
        F.sum("n").over(w_pred).alias("n_pred"),
    )
    hit = F.col("label") == F.col("prediction")
    return enriched.groupBy(*by).agg(
        F.first("total").cast("bigint").alias("n"),
        (F.sum(F.when(hit, F.col("n")).otherwise(0)) / F.first("total")).alias("accuracy"),
        F.sum(F.when(hit, 2.0 * F.col("n") * F.col("n_true")
                     / ((F.col("n_true") + F.col("n_pred")) * F.col("total"))).otherwise(0.0)).alias("f1"),
    )

