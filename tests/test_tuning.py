"""Grid search and the end-to-end programs on small inputs (reduced grids)."""

import pytest
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F

from tessera.operators import encode, models, tune
from tessera.plans import programs
from tessera.sources import fixtures as fx


def test_grid_is_cross_product(spark):
    lr = models.logistic()
    grid = tune.logistic_grid(lr, tune.GRID_SMALL["reg_param"], tune.GRID_SMALL["elastic_net"])
    assert len(grid) == 16
    big = tune.logistic_grid(lr, tune.GRID_LARGE["reg_param"], tune.GRID_LARGE["elastic_net"])
    assert len(big) == 35
    assert {(g[lr.regParam], g[lr.elasticNetParam]) for g in grid} == {
        (r, e) for r in tune.GRID_SMALL["reg_param"] for e in tune.GRID_SMALL["elastic_net"]}


def test_cross_validation_rows_and_best(spark):
    f = fx.document_quality(spark, SF_CHECK)
    ds = encode.assemble(encode.index_label(f.df), f.features).cache()
    pipe = models.scaled_logistic(maxIter=20)
    lr = pipe.getStages()[-1]
    grid = tune.logistic_grid(lr, [0.01, 0.4], [0.0, 1.0])
    cvm = tune.cross_validate(ds, pipe, grid, [f.key], seed=42, num_folds=3, parallelism=4)
    table = tune.grid_metrics(spark, cvm, lr).collect()
    assert len(table) == 4 and all(0.0 <= r["mean_metric"] <= 1.0 for r in table)
    best = tune.best_params(cvm)
    top = max(table, key=lambda r: r["mean_metric"])
    assert (best.reg_param, best.elastic_net) == (top["reg_param"], top["elastic_net"])


def test_tree_experiment_runs(spark):
    long = programs.tree_experiment(spark, SF_SMALL, seeds=[42, 123])
    rows = long.collect()
    assert len(rows) == 4 and {r["split"] for r in rows} == {"train", "test"}
    assert all(0.0 <= r["f1"] <= 1.0 for r in rows)


def test_baseline_comparison_fits_lr_once(spark):
    long = programs.baseline_comparison(spark, SF_SMALL, seeds=[1, 2, 3])
    lr = long.where((F.col("model") == "logistic_regression") & (F.col("split") == "test")).collect()
    assert len(lr) == 3 and len({r["f1"] for r in lr}) == 1


def test_tuned_logistic_small_grid(spark):
    long = programs.tuned_logistic_experiment(spark, SF_CHECK, seeds=[42, 7],
                                              grid={"reg_param": [0.01, 0.4], "elastic_net": [0.0]}, num_folds=3)
    assert long.count() == 4


def test_programs_run_on_headerless_csv(spark):
    from tessera.session import shared_dir
    from tessera.sources.csv import write_csv
    f = fx.embedding_wide(spark, SF_SMALL, width=12)
    path = shared_dir(spark, "t_csv_program")
    write_csv(f.df.select(*f.features, "label"), path, header=False)
    src = programs.csv_source(spark, path, 13)
    long = programs.tree_experiment(spark, None, seeds=[42, 7], source=src)
    rows = long.collect()
    assert len(rows) == 4 and sum(r["n"] for r in rows if r["seed"] == 42) == sum(
        r["n"] for r in rows if r["seed"] == 7)
    base = programs.baseline_comparison(spark, None, seeds=[1, 2], source=src)
    assert base.count() == 8


def test_grid_search_equals_cross_validator(spark):
    """Same folds, same grid: the same metrics to rounding and the same best point."""
    f = fx.document_quality(spark, SF_CHECK)
    ds = encode.assemble(encode.index_label(f.df), f.features).cache()
    pipe = models.scaled_logistic(maxIter=30)
    lr = pipe.getStages()[-1]
    grid = tune.logistic_grid(lr, [0.001, 0.3], [0.0, 0.5])
    ref = tune.cross_validate(ds, pipe, grid, [f.key], seed=42, num_folds=3, parallelism=4)
    got = tune.grid_search_cv(ds, pipe, grid, [f.key], seed=42, num_folds=3)
    assert all(abs(a - b) < 1e-12 for a, b in zip(ref.avgMetrics, got.avgMetrics))
    assert tune.best_params(ref).reg_param == tune.best_params(got).reg_param
    assert tune.best_params(ref).elastic_net == tune.best_params(got).elastic_net


def test_fold_scoring_scans_the_fold_once(spark):
    f = fx.orders_binary(spark, SF_SMALL)
    ds = encode.assemble(encode.index_label(f.df), f.features)
    fitted = [models.fit_logistic(ds, reg_param=r) for r in (0.0, 0.1, 1.0, 10.0)]
    scored = tune.fold_scoring(fitted, ds, "label_indexed")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert scored.count() == 4


def test_empty_fold_is_a_clear_error(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 2)) for i in range(4)], "k long, x double, label_indexed double")
    pipe = models.scaled_logistic()
    grid = tune.logistic_grid(pipe.getStages()[-1], [0.1], [0.0])
    with pytest.raises(ValueError, match="every fold"):
        tune.grid_search_cv(encode.assemble(df, ["x"]), pipe, grid, ["k"], seed=1, num_folds=5)


def test_tree_experiment_fitted_on_train_rows(spark):
    all_rows = programs.tree_experiment(spark, SF_SMALL, seeds=[42, 7], fit_on="all").collect()
    train = programs.tree_experiment(spark, SF_SMALL, seeds=[42, 7], fit_on="train").collect()
    assert {(r["run"], r["seed"], r["split"]) for r in train} == {(r["run"], r["seed"], r["split"]) for r in all_rows}
    assert all(r["elapsed_s"] > 0 for r in train)


def _counted_source(spark, n=400):
    """A fixture whose feature x counts how often a row of it is computed."""
    seen = spark.sparkContext.accumulator(0)

    def x(k):
        seen.add(1)
        return float(k % 7)

    df = spark.range(n).select(F.col("id").alias("k"), F.udf(x, "double")("id").alias("x"),
                               F.when(F.col("id") % 7 > 3, "a").otherwise("b").alias("label"))
    return fx.Fixture(df, ["x"], key="k"), seen


def test_programs_compute_their_source_once(spark):
    fix, seen = _counted_source(spark)
    programs.tuned_logistic_experiment(spark, None, seeds=[42], grid={"reg_param": [0.1], "elastic_net": [0.0]},
                                       num_folds=2, source=fix)
    assert seen.value == 400
    fix, seen = _counted_source(spark)
    programs.tree_experiment(spark, None, seeds=[42, 7], source=fix, fit_on="train")
    assert seen.value == 400


def test_fits_of_a_fold_read_its_landed_rows(spark, monkeypatch):
    """A cached fold would draw its fits to one executor; the landed rows are removed afterwards."""
    import os
    from pyspark.ml.classification import LogisticRegression
    given = []
    fit = LogisticRegression.fit

    def seen(self, dataset, params=None):
        given.append((dataset.storageLevel.useMemory, dataset.inputFiles(), dataset.rdd.getNumPartitions()))
        return fit(self, dataset, params)

    monkeypatch.setattr(LogisticRegression, "fit", seen)
    df = encode.assemble(spark.range(0, 200, 1, 1).selectExpr("id k", "cast(id % 5 AS double) x", "cast(id % 2 AS double) label_indexed"), ["x"])
    pipe = models.scaled_logistic(maxIter=3)
    tune.grid_search_cv(df, pipe, tune.logistic_grid(pipe.getStages()[-1], [0.1, 0.2], [0.0]), ["k"], seed=1, num_folds=2)
    folds = given[:4]
    assert all(not held and files and parts == 1 for held, files, parts in folds)
    assert not any(os.path.exists(f.removeprefix("file://")) for _, files, _ in folds for f in files)
