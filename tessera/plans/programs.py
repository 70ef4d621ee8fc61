"""The three end-to-end programs, composed from the operators.

* :func:`tree_experiment` -- prepare, clean (mean imputation + sequential
  3-sigma filter), assemble, then a decision tree over ten split seeds with
  train/test weighted F1 (and accuracy).
* :func:`tuned_logistic_experiment` -- prepare, clean, tune scaler ->
  [chi-square top-k ->] logistic regression by 5-fold grid search on one
  training split, then refit the best pipeline over ten split seeds. Two
  configurations: the 7 x 5 grid without selection
  (:func:`tuned_logistic_experiment`) and the 4 x 4 grid with the top 20
  chi-square features of the 64-feature table
  (:func:`selected_logistic_experiment`).
* :func:`baseline_comparison` -- prepare (no cleaning), one fixed split,
  decision tree for ten model seeds and logistic regression (which takes no
  seed, so it is fitted once) side by side.

Each returns the long result table ``(model, run, seed, split, n, accuracy,
f1, elapsed_s)``; :func:`tessera.operators.experiment.results_table` and
:func:`~tessera.operators.experiment.run_summary` turn it into the per-run
table and the min/max/mean/SD summary.
"""

from __future__ import annotations

import functools
from contextlib import contextmanager
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import split_label
from tessera.operators import clean, encode, experiment, models, split, tune
from tessera.operators.layout import cache_sized
from tessera.sources import fixtures as fx
from tessera.session import shared_dir
from tessera.sources.csv import labelled_schema, land_as_parquet, numbered, read_typed_csv

TUNING_SEED = 42


def csv_source(spark: SparkSession, path: str, columns: int) -> fx.Fixture:
    """The programs' input format, a headerless CSV of ``columns`` fields of which the last is the
    label. The text is parsed once: it is landed as Parquet on the shared storage, where every
    row also gets a number, the key of its splits and folds (equal rows are split one by one)."""
    names = numbered(columns - 1)
    raw = read_typed_csv(spark, path, labelled_schema(names))
    return fx.Fixture(land_as_parquet(raw, shared_dir(spark, "landed"), row_id="row_id"), list(names), key="row_id")


def _keys(fix: fx.Fixture) -> list[str]:
    """Split/fold key: the key column, or for keyless tables the row content
    (every feature and the label), by which equal rows fall on the same side."""
    return [fix.key] if fix.key else [*fix.features, fix.label]


def _source(spark: SparkSession, sf_dir: str | None, fixture: str, source: fx.Fixture | None) -> fx.Fixture:
    return source if source is not None else fx.FIXTURES[fixture](spark, sf_dir)


@contextmanager
def _read_once(fix: fx.Fixture):
    """The fixture over a cached copy of its key, features and label. Cleaning scans the rows many times, and a fixture may
    be a join or measure whole texts, which is then done once."""
    held = fix.df.select(*dict.fromkeys([*_keys(fix), *fix.features, fix.label])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield replace(fix, df=held)
    finally:
        held.unpersist()


def _prepared(fix: fx.Fixture, cleaned: bool, fit_where=None) -> DataFrame:
    df = encode.index_label(fix.df)
    if cleaned:
        df = clean.clean(df, fix.features, fit_where=fit_where)
    return encode.assemble(df, fix.features)


def _train_rows(fix: fx.Fixture, seed: int):
    """Condition that holds for the training rows of a seed's split."""
    return split_label(seed, _keys(fix)) == "train"


def tree_experiment(spark: SparkSession, sf_dir: str | None, seeds=experiment.SEEDS_A, parallelism: int = 8,
                    fixture: str = "embedding_wide", source: fx.Fixture | None = None,
                    fit_on: str = "all") -> DataFrame:
    """``fit_on='all'`` takes means and bounds from all rows, ``'train'`` per seed from its training rows
    only, so no test row informs them (the label index is a mere renaming and stays global)."""
    with _read_once(_source(spark, sf_dir, fixture, source)) as fix:
        if fit_on == "train":
            runs = [experiment.repeated_holdout(
                spark, _prepared(fix, True, _train_rows(fix, s)), _keys(fix), [s],
                lambda s: models.tree_classifier(seed=s), model="decision_tree", parallelism=parallelism).withColumn(
                    "run", F.lit(i + 1).cast("long")) for i, s in enumerate(seeds)]
            return functools.reduce(DataFrame.unionByName, runs)
        ds = _prepared(fix, cleaned=True)
        return experiment.repeated_holdout(spark, ds, _keys(fix), seeds, lambda s: models.tree_classifier(seed=s),
                                           model="decision_tree", parallelism=parallelism)


def tuned_logistic_experiment(spark: SparkSession, sf_dir: str, seeds=experiment.SEEDS_B,
                              grid: dict = tune.GRID_LARGE, select_k: int | None = None, num_folds: int = 5,
                              parallelism: int = 8, cv_parallelism: int = 32,
                              fixture: str = "document_quality", source: fx.Fixture | None = None,
                              select_bins: int | None = None, fit_on: str = "all") -> DataFrame:
    """With ``fit_on='train'`` means and bounds come from the training rows of the tuning split."""
    with _read_once(_source(spark, sf_dir, fixture, source)) as fix:
        keys = _keys(fix)
        where = _train_rows(fix, TUNING_SEED) if fit_on == "train" else None
        ds = cache_sized(_prepared(fix, True, where).select(*keys, "label_indexed", "features"))
    try:
        tuning = split.add_split(ds, keys, TUNING_SEED).where(F.col("split") == "train").drop("split")
        pipe = models.scaled_logistic(select_k=select_k, select_bins=select_bins)
        lr = pipe.getStages()[-1]
        cvm = tune.grid_search_cv(tuning, pipe, tune.logistic_grid(lr, grid["reg_param"], grid["elastic_net"]),
                                  keys, seed=TUNING_SEED, num_folds=num_folds, parallelism=cv_parallelism)
        best = tune.best_params(cvm)
        return experiment.repeated_holdout(
            spark, ds, keys, seeds,
            lambda s: models.scaled_logistic(reg_param=best.reg_param, elastic_net=best.elastic_net,
                                             select_k=select_k, select_bins=select_bins),
            model="logistic_regression", parallelism=parallelism)
    finally:
        ds.unpersist()


def selected_logistic_experiment(spark: SparkSession, sf_dir: str, seeds=experiment.SEEDS_A,
                                 grid: dict = tune.GRID_SMALL, select_k: int = 20,
                                 fixture: str = "embedding_wide", select_bins: int | None = 32, **kw) -> DataFrame:
    """The features are continuous, so they are binned for the chi-square test."""
    return tuned_logistic_experiment(spark, sf_dir, seeds=seeds, grid=grid, select_k=select_k, fixture=fixture,
                                     select_bins=select_bins, **kw)


def baseline_comparison(spark: SparkSession, sf_dir: str | None, seeds=experiment.SEEDS_B, parallelism: int = 8,
                        fixture: str = "embedding_wide", source: fx.Fixture | None = None) -> DataFrame:
    fix = _source(spark, sf_dir, fixture, source)
    ds = _prepared(fix, cleaned=False)
    return experiment.repeated_model_seed(
        spark, ds, _keys(fix), 42, seeds,
        {"decision_tree": (lambda s: models.tree_classifier(seed=s), True),
         "logistic_regression": (lambda s: models.logistic(), False)},
        parallelism=parallelism)
