"""Classifiers: decision tree and (elastic-net) logistic regression.

Fitting is pyspark.ml's distributed training (tree-aggregated sufficient
statistics per tree level / per optimiser iteration); prediction is a
projection. The helpers here only fix defaults and expose fitted models as
small tables (one row per split or coefficient, bounded by the model size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier,
                                       LogisticRegression, LogisticRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.operators.encode import chi2_selector, unit_std_scaler


def tree_classifier(seed: int | None = None, features_col: str = "features", label_col: str = "label_indexed",
                    **params) -> DecisionTreeClassifier:
    """Gini tree; Spark defaults: maxDepth 5, maxBins 32, minInstancesPerNode 1."""
    kw = dict(featuresCol=features_col, labelCol=label_col, **params)
    if seed is not None:
        kw["seed"] = seed
    return DecisionTreeClassifier(**kw)


def fit_tree(train: DataFrame, seed: int | None = None, features_col: str = "features",
             label_col: str = "label_indexed", **params) -> DecisionTreeClassificationModel:
    return tree_classifier(seed, features_col, label_col, **params).fit(train)


NODE_SCHEMA = StructType([
    StructField("node", LongType()), StructField("depth", LongType()), StructField("left", LongType()),
    StructField("right", LongType()), StructField("feature_index", LongType()), StructField("feature", StringType()),
    StructField("threshold", DoubleType()), StructField("categories", StringType()),
    StructField("prediction", DoubleType()), StructField("impurity", DoubleType()),
])


def tree_nodes(spark: SparkSession, model: DecisionTreeClassificationModel,
               names: Sequence[str] | None = None) -> DataFrame:
    """All nodes of a fitted tree in pre-order: the root is node 0 at depth 0; inner nodes have
    children and a split (``left`` holds values <= threshold, or the categories), leaves have
    neither. At most 2^(maxDepth + 1) - 1 rows."""
    rows: list[list] = []

    def walk(node, depth: int) -> int:
        number = len(rows)
        rows.append([number, depth, None, None, None, None, None, None, float(node.prediction()), float(node.impurity())])
        if node.subtreeDepth() > 0:
            split = node.split()
            index = split.featureIndex()
            row = rows[number]
            row[4], row[5] = index, None if names is None else names[index]
            if split.getClass().getSimpleName() == "ContinuousSplit":
                row[6] = float(split.threshold())
            else:
                row[7] = ",".join(f"{c:g}" for c in split.leftCategories())
            row[2] = walk(node.leftChild(), depth + 1)
            row[3] = walk(node.rightChild(), depth + 1)
        return number

    walk(model._call_java("rootNode"), 0)
    return spark.createDataFrame([tuple(r) for r in rows], NODE_SCHEMA)


def logistic(features_col: str = "features", label_col: str = "label_indexed", reg_param: float = 0.0,
             elastic_net: float = 0.0, **params) -> LogisticRegression:
    """Spark defaults otherwise: maxIter 100, tol 1e-6, intercept, standardization, family auto."""
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, regParam=reg_param,
                              elasticNetParam=elastic_net, **params)


def fit_logistic(train: DataFrame, features_col: str = "features", label_col: str = "label_indexed",
                 reg_param: float = 0.0, elastic_net: float = 0.0, **params) -> LogisticRegressionModel:
    return logistic(features_col, label_col, reg_param, elastic_net, **params).fit(train)


COEF_SCHEMA = StructType([
    StructField("class_index", LongType()), StructField("term", StringType()),
    StructField("value", DoubleType()),
])


def logistic_coefficients(spark: SparkSession, model: LogisticRegressionModel,
                          names: Sequence[str]) -> DataFrame:
    """``(class_index, term, value)``; binomial models report class 1 only.

    Size: (number of classes) x (number of features + 1).
    """
    rows = []
    if model.numClasses <= 2 and not _is_multinomial(model):
        rows.append((1, "intercept", float(model.intercept)))
        rows += [(1, n, float(v)) for n, v in zip(names, model.coefficients.toArray())]
    else:
        mat = model.coefficientMatrix.toArray()
        for k in range(mat.shape[0]):
            rows.append((k, "intercept", float(model.interceptVector[k])))
            rows += [(k, n, float(v)) for n, v in zip(names, mat[k])]
    return spark.createDataFrame(rows, COEF_SCHEMA)


def _is_multinomial(model: LogisticRegressionModel) -> bool:
    try:
        model.coefficients  # raises for multinomial models
        return False
    except Exception:
        return True


def scaled_logistic(features_col: str = "features", label_col: str = "label_indexed", reg_param: float = 0.0,
                    elastic_net: float = 0.0, select_k: int | None = None, select_bins: int | None = None,
                    **params) -> Pipeline:
    """Pipeline: unit-std scaler [-> chi-square top-k selector] -> logistic regression."""
    stages = [unit_std_scaler(features_col, "scaled_features")]
    lr_input = "scaled_features"
    if select_k is not None:
        stages.append(chi2_selector(select_k, "scaled_features", "selected_features", label_col, select_bins))
        lr_input = "selected_features"
    stages.append(logistic(lr_input, label_col, reg_param, elastic_net, **params))
    return Pipeline(stages=stages)

