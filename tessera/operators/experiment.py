"""Repeated experiments and their result tables.

A run = (model, seed): take the split of the seed, which was hashed from the key once when the input was cached, fit on
the training rows, predict all rows once and reduce train and test metrics in
one aggregate. Runs are independent Spark jobs, submitted from a small thread
pool so several fits share the cluster. Every run yields a few metric rows
(bounded by runs x splits); they form the long result table
``(model, run, seed, split, n, accuracy, f1, elapsed_s)`` from which the wide results
table, the min/max/mean/SD summary and the CSV sink are ordinary queries.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.functions.hashing import key_text, split_label
from tessera.operators.evaluate import metrics
from tessera.operators.layout import cache_counted, fit_budget, fit_concurrency, vector_width
from tessera.sources.csv import write_csv

# The split seeds of the repeated runs in the tree program and
# the first tuned program, and those of the baseline and second tuned program.
SEEDS_A = [42, 123, 456, 789, 795, 810, 850, 880, 950, 1000]
SEEDS_B = [42, 123, 456, 789, 101112, 131415, 161718, 192021, 222324, 252627]

RESULT_SCHEMA = StructType([
    StructField("model", StringType()), StructField("run", LongType()), StructField("seed", LongType()),
    StructField("split", StringType()), StructField("n", LongType()),
    StructField("accuracy", DoubleType()), StructField("f1", DoubleType()), StructField("elapsed_s", DoubleType()),
])

Factory = Callable[[int], object]  # seed -> pyspark.ml Estimator


def _run_once(df: DataFrame, split_seed: int, model_seed: int, factory: Factory, label_col: str) -> list[tuple]:
    began = time.perf_counter()
    tagged = df.withColumn("split", F.when(F.col(f"__train_{split_seed}"), "train").otherwise("test"))
    model = factory(model_seed).fit(tagged.where(F.col("split") == "train"))
    rows = metrics(model.transform(tagged), label_col, "prediction", by=["split"]).collect()
    took = time.perf_counter() - began
    return [(r["split"], r["n"], r["accuracy"], r["f1"], took) for r in rows]


def _collect_runs(df: DataFrame, jobs: list[tuple], keys: Sequence[str], label_col: str, train_fraction: float,
                  parallelism: int, features_col: str, fit_bytes: int | None) -> list[tuple]:
    # every run reads the label, the vector and the side of its split, one boolean per split seed: a fit scans its rows
    # several times, and the hash of a key costs more than the rest of a scan.
    # A lone key keeps its own value, several become one string
    key = F.col(keys[0]) if len(keys) == 1 else key_text(keys)
    sides = [(split_label(s, [key], train_fraction) == "train").alias(f"__train_{s}") for s in dict.fromkeys(j[2] for j in jobs)]
    held, n = cache_counted(df.select(label_col, features_col, *sides))
    parallelism = fit_concurrency(int(n * train_fraction), vector_width(df, features_col), parallelism,
                                  fit_budget(df.sparkSession, fit_bytes))
    try:
        def go(job):
            name, run, split_seed, model_seed, factory = job
            return [(name, run, model_seed, *m) for m in
                    _run_once(held, split_seed, model_seed, factory, label_col)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            results = list(pool.map(inheritable_thread_target(df.sparkSession)(go), jobs))
    finally:
        held.unpersist()
    return [r for rs in results for r in rs]


def repeated_holdout(spark: SparkSession, df: DataFrame, keys: Sequence[str], seeds: Sequence[int],
                     factory: Factory, model: str = "model", label_col: str = "label_indexed",
                     train_fraction: float = 0.7, parallelism: int = 8, features_col: str = "features",
                     fit_bytes: int | None = None) -> DataFrame:
    """One run per seed; the seed drives both the split and the model. ``elapsed_s`` is the
    run's wall time (runs share the cluster)."""
    jobs = [(model, i + 1, s, s, factory) for i, s in enumerate(seeds)]
    rows = _collect_runs(df, jobs, keys, label_col, train_fraction, parallelism, features_col, fit_bytes)
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def repeated_model_seed(spark: SparkSession, df: DataFrame, keys: Sequence[str], split_seed: int,
                        seeds: Sequence[int], factories: dict[str, tuple[Factory, bool]],
                        label_col: str = "label_indexed", train_fraction: float = 0.7,
                        parallelism: int = 8, features_col: str = "features",
                        fit_bytes: int | None = None) -> DataFrame:
    """Fixed split, one run per (model, seed). A model flagged unseeded
    ignores the seed, so it is fitted once and that fit's metrics are
    reported for every seed."""
    jobs, unseeded = [], []
    for name, (factory, seeded) in factories.items():
        if seeded:
            jobs += [(name, i + 1, split_seed, s, factory) for i, s in enumerate(seeds)]
        else:
            jobs.append((name, 0, split_seed, seeds[0], factory))
            unseeded.append(name)
    rows = _collect_runs(df, jobs, keys, label_col, train_fraction, parallelism, features_col, fit_bytes)
    out = [r for r in rows if r[0] not in unseeded]
    for r in rows:
        if r[0] in unseeded:
            out += [(r[0], i + 1, s, *r[3:]) for i, s in enumerate(seeds)]
    return spark.createDataFrame(out, RESULT_SCHEMA)


def results_table(long: DataFrame, metric: str = "f1", decimals: int | None = 4) -> DataFrame:
    """Wide table ``model, run, seed, train_<metric>, test_<metric>`` (one row per run)."""
    v = F.col(metric) if decimals is None else F.round(F.col(metric), decimals)
    return long.groupBy("model", "run", "seed").agg(
        F.max(F.when(F.col("split") == "train", v)).alias(f"train_{metric}"),
        F.max(F.when(F.col("split") == "test", v)).alias(f"test_{metric}"),
    )


def run_summary(long: DataFrame, metrics_cols: Sequence[str] = ("accuracy", "f1")) -> DataFrame:
    """min, max, mean and population SD of every metric per (model, split)."""
    stacked = long.select("model", "split", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics_cols])))
    return stacked.groupBy("model", "split", "metric").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"),
    )


def write_results_csv(table: DataFrame, path: str) -> str:
    """Result tables are tens of rows: one file with a header, overwrite."""
    return write_csv(table, path, header=True, mode="overwrite", single_file=True)
