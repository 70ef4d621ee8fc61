"""Registered queries: one per operator of the inventory, each paired with
its DuckDB oracle SQL where SQL can express it.

Every query reads the test tables of ``sf_dir`` (whole tables, whole texts)
through a fixture of :mod:`tessera.sources.fixtures` and returns a
DataFrame without vector columns (vectors are exploded to long form) and with
computed doubles rounded, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.vectors import explode_vector, vector_sum
from tessera.operators import clean, encode, evaluate, experiment, models, profile, split, tune
from tessera.operators.layout import cache_counted, cache_sized, fit_budget, fit_concurrency
from tessera.plans import mechanisms, programs
from tessera.session import shared_dir
from tessera.sources import fixtures as fx
from tessera.sources.csv import labelled_schema, land_as_parquet, numbered, read_typed_csv, write_csv
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

R = 6  # decimals for computed doubles


def _r(c, d: int = R):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _prepared(fix: fx.Fixture, assemble: bool = True, handle_invalid: str = "error") -> DataFrame:
    df = encode.index_label(fix.df)
    return encode.assemble(df, fix.features, handle_invalid=handle_invalid) if assemble else df


# ================================================================ scans and sinks (S1-S6)

def csv_typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Headerless CSV of 64 features + label, scanned with a generated schema."""
    f = fx.embedding_wide(spark, sf)
    path = shared_dir(spark, "csv_typed_scan")
    write_csv(f.df.select(*f.features, "label"), path, header=False)
    return read_typed_csv(spark, path, labelled_schema(numbered(len(f.features))))


def csv_malformed_to_null(spark: SparkSession, sf: str) -> DataFrame:
    """Permissive typed scan: 'abc' and empty cells become NULL, rows kept."""
    path = shared_dir(spark, "csv_dirty")
    write_csv(fx.events_dirty_text(spark, sf), path, header=False)
    return read_typed_csv(spark, path, labelled_schema(numbered(2)))


# ================================================================ profiles, filters (P, A)

def feature_profile(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.events_nulls(spark, sf)
    p = profile.profile(f.df, f.features)
    return p.select("feature", "ordinal", "n", "n_null", _r("mean").alias("mean"), _r("sd").alias("sd"),
                    _r("lo").alias("lo"), _r("hi").alias("hi"))


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.events_nulls(spark, sf)
    return profile.null_counts(f.df, f.features)


def outlier_bounds(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.events_nulls(spark, sf)
    b = profile.outlier_bounds(f.df, f.features)
    return b.select("feature", "ordinal", _r("mean").alias("mean"), _r("sd").alias("sd"),
                    _r("lo").alias("lo"), _r("hi").alias("hi"))


def range_filter(spark: SparkSession, sf: str) -> DataFrame:
    """All-at-once 3-sigma filter: every bound from the same (unfiltered) rows."""
    f = fx.events_correlated(spark, sf)
    return clean.range_filter(f.df, profile.outlier_bounds(f.df, f.features))


# ================================================================ data quality (Q1-Q4)

def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.events_nulls(spark, sf)
    out = clean.impute_mean(f.df, f.features)
    return out.withColumn("value", _r("value"))


def outlier_filter_sequential(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.events_correlated(spark, sf)
    return clean.outlier_filter_sequential(f.df, f.features)


def clean_and_assemble(spark: SparkSession, sf: str) -> DataFrame:
    """Impute -> sequential filter -> assemble; exploded. The all-NULL column
    stays missing (kept as NaN in the vector, reported as NULL)."""
    f = fx.events_nulls(spark, sf)
    cleaned = clean.clean(f.df, f.features)
    vec = encode.assemble(cleaned, f.features, handle_invalid="keep")
    long = explode_vector(vec, "features", ["event_id"], f.features)
    v = F.when(F.isnan("value"), F.lit(None).cast("double")).otherwise(F.col("value"))
    return long.select("event_id", "pos", "feature", _r(v).alias("value"))


def prepare_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Typed CSV scan -> label index -> assemble, summarised per label."""
    f = fx.embedding_wide(spark, sf)
    path = shared_dir(spark, "prepare_dataset")
    write_csv(f.df.select(*f.features, "label"), path, header=False)
    names = numbered(len(f.features))
    raw = land_as_parquet(read_typed_csv(spark, path, labelled_schema(names)), shared_dir(spark, "prepared"))
    ds = encode.assemble(encode.index_label(raw), names)
    return ds.groupBy("label", "label_indexed").agg(
        F.count(F.lit(1)).alias("n"), _r(F.sum(vector_sum("features"))).alias("feature_sum"))


# ================================================================ encoders (F1-F5, A4, A6)

def label_frequency_index(spark: SparkSession, sf: str) -> DataFrame:
    return encode.label_frequency_index(fx.lineitem_encode(spark, sf).df)


def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.bucketed_select(spark, sf)
    vec = encode.assemble(f.df, f.features)
    return explode_vector(vec, "features", ["event_id"], f.features)


def scale_unit_std(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.lineitem_encode(spark, sf)
    vec = encode.assemble(f.df, f.features)
    scaled = encode.fit_scaler(vec).transform(vec)
    long = explode_vector(scaled, "scaled_features", [], f.features)
    return long.groupBy("feature", _r("value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def scale_train_apply_test(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.bucketed_select(spark, sf)
    vec = split.add_split(encode.assemble(f.df, f.features), [f.key], 42)
    scaler = encode.fit_scaler(vec.where(F.col("split") == "train"))
    long = explode_vector(scaler.transform(vec), "scaled_features", ["split"], f.features)
    return long.groupBy("split", "feature").agg(F.count(F.lit(1)).alias("n"),
                                                _r(F.sum("value"), 4).alias("sum_scaled"))


def chi2_scores(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.bucketed_select(spark, sf)
    s = encode.chi2_scores(_prepared(f), names=f.features)
    return s.select("feature_index", "feature", _r("statistic").alias("statistic"), "dof")


def chi2_select_binned(spark: SparkSession, sf: str) -> DataFrame:
    """The 8 best of 64 continuous columns, each cut into 16 equal-width bins."""
    f = fx.embedding_wide(spark, sf)
    chosen = encode.chi2_select_topk(encode.index_label(f.df), f.features, k=8, bins=16)
    return spark.createDataFrame([(f.features.index(c), c) for c in chosen], "feature_index int, feature string")


def chi2_select_topk(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.bucketed_select(spark, sf)
    chosen = encode.chi2_select_topk(encode.index_label(f.df), f.features, k=2)
    rows = [(f.features.index(c), c) for c in chosen]
    return spark.createDataFrame(rows, "feature_index int, feature string")


# ================================================================ splits (T1-T3)

def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.orders_flags(spark, sf)
    return split.add_split(f.df, [f.key], 42).select(f.key, "split")


def random_split(spark: SparkSession, sf: str) -> DataFrame:
    """What holds of Spark's Bernoulli split whatever the partitioning: no row on both sides, none lost."""
    f = fx.orders_flags(spark, sf)
    train, test = split.random_split(f.df, 42)
    sides = (train.select(f.key, F.lit(1).alias("train"), F.lit(0).alias("test"))
             .unionByName(test.select(f.key, F.lit(0).alias("train"), F.lit(1).alias("test"))))
    per_key = sides.groupBy(f.key).agg(F.sum("train").alias("train"), F.sum("test").alias("test"))
    found = f.df.select(f.key).join(per_key, f.key, "left")
    share = F.sum("train") / F.count(F.lit(1))
    return found.agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("train") > 0) & (F.col("test") > 0)).alias("n_overlap"),
        F.count_if(F.col("train").isNull()).alias("n_missing"),
        ((share > 0.65) & (share < 0.75)).alias("share_near_0_7"))


def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.orders_flags(spark, sf)
    return split.add_folds(f.df, [f.key], 42, 5).select(f.key, "fold")


def nested_split(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.orders_flags(spark, sf)
    return split.add_nested_split(f.df, [f.key], 42).select(f.key, "part")


# ================================================================ models (M1-M9)

def decision_tree_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Tree on a two-threshold rule label; all its nodes as rows (children of leaves are -1)."""
    f = fx.lineitem_rule(spark, sf)
    model = models.fit_tree(_prepared(f), seed=42)
    return models.tree_nodes(spark, model, f.features).select(
        "node", "depth", *[F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("left", "right")], "feature", _r("threshold").alias("threshold"), "prediction")


def decision_tree_predict(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.lineitem_rule(spark, sf)
    ds = _prepared(f)
    model = models.fit_tree(ds, seed=42)
    return (model.transform(ds).groupBy("label", "label_indexed", "prediction")
            .agg(F.count(F.lit(1)).alias("n")))


def _holdout(spark: SparkSession, f: fx.Fixture, seed: int, estimator) -> DataFrame:
    ds = split.add_split(_prepared(f), [f.key], seed)
    model = estimator.fit(ds.where(F.col("split") == "train"))
    m = evaluate.metrics(model.transform(ds), by=["split"])
    return m.select("split", "n", _r("accuracy").alias("accuracy"), _r("f1").alias("f1"))


def decision_tree_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return _holdout(spark, fx.orders_flags(spark, sf), 123, models.tree_classifier(seed=123))


def logistic_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Unregularised LR on one binary feature: the closed-form log-odds."""
    f = fx.orders_binary(spark, sf)
    model = models.fit_logistic(_prepared(f))
    return models.logistic_coefficients(spark, model, f.features).select(
        "class_index", "term", _r("value", 3).alias("value"))


def _coefficients_over(spark: SparkSession, f: fx.Fixture, grid: list[tuple[float, float]],
                       parallelism: int = 16) -> DataFrame:
    """Coefficients of every (reg_param, elastic_net); the fits run concurrently within the byte budget."""
    held, n = cache_counted(_prepared(f).select("label_indexed", "features"))

    def fit(p):
        m = models.fit_logistic(held, reg_param=p[0], elastic_net=p[1])
        return [(p[0], p[1], *row) for row in models.logistic_coefficients(spark, m, f.features).collect()]

    try:
        with ThreadPoolExecutor(max_workers=fit_concurrency(n, len(f.features), parallelism, fit_budget(spark))) as pool:
            rows = [r for rs in pool.map(inheritable_thread_target(spark)(fit), grid) for r in rs]
    finally:
        held.unpersist()
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, class_index long, term string, "
                                       "value double")


def logistic_elastic_net(spark: SparkSession, sf: str) -> DataFrame:
    """Coefficients over the regularisation grid of the tuned program."""
    return _coefficients_over(spark, fx.document_quality(spark, sf), [
        (r, e) for r in tune.GRID_SMALL["reg_param"] for e in tune.GRID_SMALL["elastic_net"]])


LASSO_REGS = (0.0001, 0.001, 0.01)


def logistic_lasso(spark: SparkSession, sf: str) -> DataFrame:
    """L1-regularised fits on one binary feature, whose optimum is closed-form."""
    out = _coefficients_over(spark, fx.orders_binary(spark, sf), [(r, 1.0) for r in LASSO_REGS])
    return out.withColumn("value", _r("value", 3))


def _group_probability(pred: DataFrame, feature: str) -> DataFrame:
    p1 = vector_to_array("probability").getItem(1)
    return pred.groupBy(feature, "prediction", _r(p1, 4).alias("p1")).agg(F.count(F.lit(1)).alias("n"))


def logistic_predict(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.orders_binary(spark, sf)
    ds = _prepared(f)
    return _group_probability(models.fit_logistic(ds).transform(ds), "u")


def logistic_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return _holdout(spark, fx.orders_binary(spark, sf), 42, models.logistic())


def scaled_logistic_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Scaler -> LR pipeline fitted on the training split; per-group probability."""
    f = fx.orders_binary(spark, sf)
    ds = split.add_split(_prepared(f), [f.key], 42)
    model = models.scaled_logistic().fit(ds.where(F.col("split") == "train"))
    return _group_probability(model.transform(ds), "u")


def selected_logistic_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Scaler -> chi-square top-2 -> LR; coefficients of the kept features."""
    f = fx.bucketed_select(spark, sf)
    ds = split.add_split(_prepared(f), [f.key], 42)
    model = models.scaled_logistic(select_k=2, reg_param=0.01).fit(ds.where(F.col("split") == "train"))
    kept = [f.features[i] for i in sorted(model.stages[1].selectedFeatures)]
    return models.logistic_coefficients(spark, model.stages[-1], kept)


# ================================================================ evaluation (A5, E1-E3)

def _tree_predictions(spark: SparkSession, sf: str, seed: int = 42) -> DataFrame:
    f = fx.orders_flags(spark, sf)
    ds = split.add_split(_prepared(f), [f.key], seed)
    model = models.fit_tree(ds.where(F.col("split") == "train"), seed=seed)
    return model.transform(ds)


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    pred = _tree_predictions(spark, sf).where(F.col("split") == "test")
    return evaluate.confusion(pred)


def eval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    pred = _tree_predictions(spark, sf).where(F.col("split") == "test")
    return evaluate.metrics(pred).select("n", _r("accuracy").alias("accuracy"))


def eval_weighted_f1(spark: SparkSession, sf: str) -> DataFrame:
    pred = _tree_predictions(spark, sf).where(F.col("split") == "test")
    return evaluate.metrics(pred).select("n", _r("f1").alias("f1"))


def eval_by_split(spark: SparkSession, sf: str) -> DataFrame:
    m = evaluate.metrics(_tree_predictions(spark, sf), by=["split"])
    return m.select("split", "n", _r("accuracy").alias("accuracy"), _r("f1").alias("f1"))


# ================================================================ model selection (H1-H4)

@contextmanager
def _cv(spark: SparkSession, f: fx.Fixture, grid: dict, train_only: bool = False):
    """(tagged rows, lr stage, search result) of the grid search on a fixture; the cached rows are released."""
    ds = cache_sized(split.add_split(_prepared(f), [f.key], 42).select(f.key, "split", "label_indexed", "features"))
    try:
        pipe = models.scaled_logistic()
        lr = pipe.getStages()[-1]
        points = tune.logistic_grid(lr, grid["reg_param"], grid["elastic_net"])
        data = ds.where(F.col("split") == "train") if train_only else ds
        yield ds, lr, tune.grid_search_cv(data, pipe, points, [f.key], seed=42, num_folds=5, parallelism=32)
    finally:
        ds.unpersist()


def cv_grid_metrics(spark: SparkSession, sf: str) -> DataFrame:
    with _cv(spark, fx.document_quality(spark, sf), tune.GRID_SMALL) as (_, lr, cvm):
        return tune.grid_metrics(spark, cvm, lr)


def cv_best_params(spark: SparkSession, sf: str) -> DataFrame:
    with _cv(spark, fx.document_quality(spark, sf), tune.GRID_SMALL) as (_, lr, cvm):
        b = tune.best_params(cvm)
    return spark.createDataFrame([(b.reg_param, b.elastic_net, b.metric)],
                                 "reg_param double, elastic_net double, mean_metric double")


def tune_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Tune on the training split, refit the best pipeline there, report both splits."""
    with _cv(spark, fx.document_quality(spark, sf), tune.GRID_SMALL, train_only=True) as (ds, lr, cvm):
        b = tune.best_params(cvm)
        m = evaluate.metrics(cvm.bestModel.transform(ds), by=["split"]).collect()
    rows = [(r["split"], r["n"], r["accuracy"], r["f1"], b.reg_param, b.elastic_net) for r in m]
    return spark.createDataFrame(rows, "split string, n long, accuracy double, f1 double, reg_param double, "
                                       "elastic_net double")


CV_EXACT = {"reg_param": [0.0001, 0.2], "elastic_net": [1.0]}


def cv_grid_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Grid search over L1 fits on one binary feature: every fold's predictions are closed-form."""
    with _cv(spark, fx.orders_binary(spark, sf), CV_EXACT) as (_, lr, cvm):
        return tune.grid_metrics(spark, cvm, lr).select(
            "grid_index", "reg_param", "elastic_net", _r("mean_metric").alias("mean_metric"), _r("sd_metric").alias("sd_metric"))


def cv_best_exact(spark: SparkSession, sf: str) -> DataFrame:
    with _cv(spark, fx.orders_binary(spark, sf), CV_EXACT) as (_, lr, cvm):
        b = tune.best_params(cvm)
    return spark.createDataFrame([(b.reg_param, b.elastic_net, round(b.metric, R))],
                                 "reg_param double, elastic_net double, mean_metric double")


def tune_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Tuning composite on a solvable table: search on the training split, best model, both splits."""
    with _cv(spark, fx.orders_binary(spark, sf), CV_EXACT, train_only=True) as (ds, lr, cvm):
        b = tune.best_params(cvm)
        m = evaluate.metrics(cvm.bestModel.transform(ds), by=["split"]).collect()
    rows = [(r["split"], r["n"], round(r["accuracy"], R), round(r["f1"], R), b.reg_param, b.elastic_net) for r in m]
    return spark.createDataFrame(rows, "split string, n long, accuracy double, f1 double, reg_param double, "
                                       "elastic_net double")


# ================================================================ experiments (X1-X5, A3, S4-S6)

def _rounded(long: DataFrame) -> DataFrame:
    return long.select("model", "run", "seed", "split", "n", _r("accuracy").alias("accuracy"), _r("f1").alias("f1"))


def _tree_runs(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.orders_flags(spark, sf)
    return experiment.repeated_holdout(spark, _prepared(f), [f.key], experiment.SEEDS_A,
                                       lambda s: models.tree_classifier(seed=s), model="decision_tree")


def repeated_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_tree_runs(spark, sf))


def repeated_model_seed(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.orders_flags(spark, sf)
    long = experiment.repeated_model_seed(
        spark, _prepared(f), [f.key], 42, experiment.SEEDS_B,
        {"decision_tree": (lambda s: models.tree_classifier(seed=s), True)})
    return _rounded(long)


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    f = fx.orders_binary(spark, sf)
    long = experiment.repeated_model_seed(
        spark, _prepared(f), [f.key], 42, experiment.SEEDS_B,
        {"decision_tree": (lambda s: models.tree_classifier(seed=s), True),
         "logistic_regression": (lambda s: models.logistic(), False)})
    return _rounded(long)


def results_table(spark: SparkSession, sf: str) -> DataFrame:
    return experiment.results_table(_tree_runs(spark, sf), "f1", 4)


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = experiment.run_summary(_tree_runs(spark, sf))
    return s.select("model", "split", "metric", _r("min").alias("min"), _r("max").alias("max"),
                    _r("mean").alias("mean"), _r("sd").alias("sd"))


RESULTS_CSV_SCHEMA = StructType([
    StructField("model", StringType()), StructField("run", LongType()), StructField("seed", LongType()),
    StructField("train_f1", DoubleType()), StructField("test_f1", DoubleType()),
])


def results_csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Write the results table as one headed CSV file, read it back."""
    path = shared_dir(spark, "results_csv")
    experiment.write_results_csv(experiment.results_table(_tree_runs(spark, sf), "f1", 4), path)
    return spark.read.schema(RESULTS_CSV_SCHEMA).option("header", "true").csv(path)


# ================================================================ end-to-end programs

def tree_program_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The tree program on a table whose cleaning and majority labels SQL can express."""
    return _rounded(programs.tree_experiment(spark, sf, fixture="orders_dirty"))


def tree_program_train_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The same with means and bounds from each seed's training rows only."""
    return _rounded(programs.tree_experiment(spark, sf, seeds=experiment.SEEDS_A[:2], fixture="orders_dirty",
                                             fit_on="train"))


def baseline_program_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(programs.baseline_comparison(spark, sf, fixture="orders_binary"))


def tuned_program_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(programs.tuned_logistic_experiment(spark, sf, seeds=experiment.SEEDS_B[:4], grid=CV_EXACT,
                                                       fixture="orders_two_flags"))


def selected_program_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Selection of the one telling feature, grid search, and refits."""
    return _rounded(programs.selected_logistic_experiment(
        spark, sf, seeds=experiment.SEEDS_A[:4], grid={"reg_param": [0.0001, 0.001], "elastic_net": [0.0]}, select_k=1,
        select_bins=None, fixture="orders_two_flags"))


def selected_logistic_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Scaler -> chi-square top-1 -> LR on the training split: the kept feature's group rates."""
    f = fx.orders_two_flags(spark, sf)
    ds = split.add_split(_prepared(f), [f.key], 42)
    model = models.scaled_logistic(select_k=1).fit(ds.where(F.col("split") == "train"))
    kept = [f.features[i] for i in model.stages[1].selectedFeatures]
    return _group_probability(model.transform(ds), "u").withColumn("kept", F.lit(",".join(kept)))


def tree_experiment(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(programs.tree_experiment(spark, sf))


def tuned_logistic_experiment(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(programs.tuned_logistic_experiment(spark, sf))


def selected_logistic_experiment(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(programs.selected_logistic_experiment(spark, sf))


def baseline_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(programs.baseline_comparison(spark, sf))


# ================================================================ registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_typed_scan": csv_typed_scan,
    "csv_malformed_to_null": csv_malformed_to_null,
    "feature_profile": feature_profile,
    "null_counts": null_counts,
    "outlier_bounds": outlier_bounds,
    "range_filter": range_filter,
    "impute_mean": impute_mean,
    "outlier_filter_sequential": outlier_filter_sequential,
    "clean_and_assemble": clean_and_assemble,
    "prepare_dataset": prepare_dataset,
    "label_frequency_index": label_frequency_index,
    "assemble_features": assemble_features,
    "scale_unit_std": scale_unit_std,
    "scale_train_apply_test": scale_train_apply_test,
    "chi2_scores": chi2_scores,
    "chi2_select_topk": chi2_select_topk,
    "chi2_select_binned": chi2_select_binned,
    "holdout_split": holdout_split,
    "random_split": random_split,
    "kfold_assign": kfold_assign,
    "nested_split": nested_split,
    "decision_tree_fit": decision_tree_fit,
    "decision_tree_predict": decision_tree_predict,
    "decision_tree_holdout": decision_tree_holdout,
    "logistic_fit": logistic_fit,
    "logistic_elastic_net": logistic_elastic_net,
    "logistic_lasso": logistic_lasso,
    "logistic_predict": logistic_predict,
    "logistic_holdout": logistic_holdout,
    "scaled_logistic_fit": scaled_logistic_fit,
    "selected_logistic_fit": selected_logistic_fit,
    "confusion_matrix": confusion_matrix,
    "eval_accuracy": eval_accuracy,
    "eval_weighted_f1": eval_weighted_f1,
    "eval_by_split": eval_by_split,
    "cv_grid_metrics": cv_grid_metrics,
    "cv_best_params": cv_best_params,
    "tune_logistic": tune_logistic,
    "tune_exact": tune_exact,
    "cv_grid_exact": cv_grid_exact,
    "cv_best_exact": cv_best_exact,
    "repeated_holdout": repeated_holdout,
    "repeated_model_seed": repeated_model_seed,
    "model_comparison": model_comparison,
    "results_table": results_table,
    "run_summary": run_summary,
    "results_csv_sink": results_csv_sink,
    "selected_logistic_exact": selected_logistic_exact,
    "tree_program_exact": tree_program_exact,
    "tree_program_train_fit": tree_program_train_fit,
    "baseline_program_exact": baseline_program_exact,
    "tuned_program_exact": tuned_program_exact,
    "selected_program_exact": selected_program_exact,
    "tree_experiment": tree_experiment,
    "tuned_logistic_experiment": tuned_logistic_experiment,
    "selected_logistic_experiment": selected_logistic_experiment,
    "baseline_comparison": baseline_comparison,
    **mechanisms.QUERIES,
}
