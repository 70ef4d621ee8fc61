"""Grid search with k-fold cross-validation.

``CrossValidator`` gets a hash ``fold`` column (``foldCol``) instead of its
``rand(seed)`` assignment, so the folds do not depend on partitioning and can
be reproduced in SQL; ``parallelism`` fits several grid points at once (each
fit is itself a distributed job, so this fills the cluster between the small
per-iteration aggregations of logistic regression).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tessera.operators import evaluate
from tessera.operators.layout import cache_counted, fit_budget, fit_concurrency, partitions_for, vector_width
from tessera.operators.split import add_folds
from tessera.session import remove_dir, shared_dir
from tessera.sources.csv import land_as_parquet

# The two regularisation grids of the tuned programs.
GRID_SMALL = {"reg_param": [0.0001, 0.01, 0.2, 0.4], "elastic_net": [0.0, 0.2, 0.4, 0.6]}
GRID_LARGE = {"reg_param": [1e-5, 1e-4, 0.001, 0.01, 0.1, 1.0, 10.0], "elastic_net": [0.0, 0.25, 0.5, 0.75, 1.0]}


def logistic_grid(lr, reg_params: Sequence[float], elastic_nets: Sequence[float]) -> list:
    """Cross product regParam x elasticNetParam (regParam varies slowest)."""
    return (ParamGridBuilder().addGrid(lr.regParam, list(reg_params))
            .addGrid(lr.elasticNetParam, list(elastic_nets)).build())


def f1_evaluator(label_col: str = "label_indexed", metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction", metricName=metric)


def cross_validate(df: DataFrame, pipeline: Pipeline, grid: list, keys: Sequence[str], seed: int,
                   num_folds: int = 5, parallelism: int = 4, label_col: str = "label_indexed",
                   metric: str = "f1") -> CrossValidatorModel:
    folded = add_folds(df, keys, seed, num_folds, "fold")
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=f1_evaluator(label_col, metric),
                        numFolds=num_folds, foldCol="fold", parallelism=parallelism, seed=seed)
    return cv.fit(folded)


GRID_SCHEMA = StructType([
    StructField("grid_index", LongType()), StructField("reg_param", DoubleType()),
    StructField("elastic_net", DoubleType()), StructField("mean_metric", DoubleType()),
    StructField("sd_metric", DoubleType()),
])


def grid_metrics(spark: SparkSession, cv_model: CrossValidatorModel | GridSearchModel, lr) -> DataFrame:
    """One row per grid point: parameters, mean and SD of the fold metric
    (size = grid size)."""
    rows = []
    sds = getattr(cv_model, "stdMetrics", None) or [None] * len(cv_model.avgMetrics)
    for i, (pm, m, s) in enumerate(zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics, sds)):
        rows.append((i, float(pm[lr.regParam]), float(pm[lr.elasticNetParam]), float(m),
                     None if s is None else float(s)))
    return spark.createDataFrame(rows, GRID_SCHEMA)


@dataclass
class GridSearchModel:
    """Result of :func:`grid_search_cv`, shaped like ``CrossValidatorModel``."""
    bestModel: PipelineModel
    avgMetrics: list[float]
    stdMetrics: list[float]
    paramMaps: list
    foldMetrics: list[list[float]]

    def getEstimatorParamMaps(self) -> list:
        return self.paramMaps


def _chained(models: list, df: DataFrame) -> DataFrame:
    """``df`` with the predictions p0, p1, ... of all models: one scan, one projection chain."""
    for j, m in enumerate(models):
        m = m.copy()
        m.setPredictionCol(f"p{j}").setProbabilityCol("").setRawPredictionCol("")
        df = m.transform(df)
    return df


def fold_scoring(models: list, valid: DataFrame, label_col: str) -> DataFrame:
    """(grid, n, accuracy, f1) of every model on one validation fold, from one scan of it."""
    preds = _chained(models, valid).select(F.col(label_col), F.inline(F.array(*[
        F.struct(F.lit(j).alias("grid"), F.col(f"p{j}").alias("prediction")) for j in range(len(models))])))
    return evaluate.metrics(preds, label_col, "prediction", by=["grid"])


def grid_search_cv(df: DataFrame, pipeline: Pipeline, grid: list, keys: Sequence[str], seed: int,
                   num_folds: int = 5, parallelism: int = 8, label_col: str = "label_indexed",
                   metric: str = "f1", fit_bytes: int | None = None) -> GridSearchModel:
    """k-fold grid search with the same metrics as ``CrossValidator``.

    The folds keep only the label, the fold number and one vector: the input's vector cached once, and per fold the
    vector that the last stage reads, as Parquet in the shared folder. From there any executor reads the rows of a fit,
    so fits run wherever cores are free; a cached fold would draw all its fits to the executor that holds it. A fit caches the
    blocks it iterates over. The stages before the last one (scaler, selector -- their parameters
    are not in the grid) are fitted once per fold instead of once per grid point. All fits
    share one pool, whose size is ``parallelism`` bounded by ``fit_bytes``
    (see :func:`~tessera.operators.layout.fit_concurrency`). The models of all grid points are chained over a
    validation fold, so it is scanned once. The best grid point (first one on ties) is
    refitted on all rows, as ``CrossValidator`` does. A fold without rows, or without
    training rows, is an error.
    """
    stages = pipeline.getStages()
    prefix, last = stages[:-1], stages[-1]
    if metric not in ("f1", "accuracy"):
        raise ValueError("grid_search_cv scores 'f1' (weighted) or 'accuracy'")
    source = prefix[0].getOrDefault("inputCol") if prefix else last.getFeaturesCol()
    reads = last.getFeaturesCol()
    folded, n = cache_counted(add_folds(df, keys, seed, num_folds, "__fold").select("__fold", label_col, source))
    landed: list[str] = []
    try:
        sizes = {r["__fold"]: r["count"] for r in folded.groupBy("__fold").count().collect()}
        bare = [i for i in range(num_folds) if not sizes.get(i) or sizes[i] == n]
        if bare:
            raise ValueError(f"cross-validation needs rows in and outside every fold; of {n} rows, fold sizes are "
                             f"{[sizes.get(i, 0) for i in range(num_folds)]}")
        workers = fit_concurrency(n, vector_width(folded, source), parallelism, fit_budget(df.sparkSession, fit_bytes))

        def prepare(i: int):
            rows = folded
            if prefix:
                rows = Pipeline(stages=prefix).fit(folded.where(F.col("__fold") != i)).transform(folded)
            landed.append(path := shared_dir(df.sparkSession, "fold"))
            rows = land_as_parquet(rows.select("__fold", label_col, reads), path).coalesce(partitions_for(n))
            return [rows.where(c).select(label_col, reads) for c in (F.col("__fold") != i, F.col("__fold") == i)]

        with ThreadPoolExecutor(max_workers=workers) as pool:
            views = list(pool.map(inheritable_thread_target(df.sparkSession)(prepare), range(num_folds)))
            tasks = [(i, j) for i in range(num_folds) for j in range(len(grid))]

            def fit(task):
                return last.fit(views[task[0]][0], grid[task[1]])

            def score(i: int) -> dict[int, float]:
                models = [fitted[i, j] for j in range(len(grid))]
                return {r["grid"]: r[metric] for r in fold_scoring(models, views[i][1], label_col).collect()}

            fitted = dict(zip(tasks, pool.map(inheritable_thread_target(df.sparkSession)(fit), tasks)))
            per_fold = list(pool.map(inheritable_thread_target(df.sparkSession)(score), range(num_folds)))
    finally:
        for path in landed:
            remove_dir(df.sparkSession, path)
        folded.unpersist()
    per_point = [[per_fold[i][j] for i in range(num_folds)] for j in range(len(grid))]
    avg = [sum(v) / num_folds for v in per_point]
    std = [math.sqrt(sum((x - a) ** 2 for x in v) / num_folds) for v, a in zip(per_point, avg)]
    best = max(range(len(grid)), key=lambda j: (avg[j], -j))
    best_model = pipeline.fit(df, grid[best])
    return GridSearchModel(best_model, avg, std, list(grid), per_point)


@dataclass
class BestParams:
    reg_param: float
    elastic_net: float
    metric: float


def best_params(cv_model: CrossValidatorModel | GridSearchModel) -> BestParams:
    """Parameters of the best grid point (first one on ties) via public getters."""
    lr_model = cv_model.bestModel.stages[-1]
    return BestParams(float(lr_model.getRegParam()), float(lr_model.getElasticNetParam()),
                      float(max(cv_model.avgMetrics)))
