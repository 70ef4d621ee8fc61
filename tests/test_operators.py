
import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from tessera.operators import clean, encode, evaluate, experiment, models, profile, split
from tessera.session import shared_dir
from tessera.sources import fixtures as fx
from tessera.sources.csv import labelled_schema, numbered, read_typed_csv, write_csv


# ---------------------------------------------------------------- scans

def test_labelled_schema_shape():
    s = labelled_schema(numbered(41))
    assert len(s.fields) == 42
    assert s.fields[0].name == "feature_1" and s.fields[40].name == "feature_41"
    assert s.fields[-1].name == "label" and s.fields[-1].dataType.simpleString() == "string"
    assert all(f.nullable for f in s.fields)
    assert labelled_schema(["a", "b"], "y").names == ["a", "b", "y"]
    with pytest.raises(ValueError):
        labelled_schema([])


def test_permissive_scan_short_and_long_lines(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("1.5,abc,yes\n2.5\n3.5,4.5,no,extra\n")
    rows = read_typed_csv(spark, str(p), labelled_schema(numbered(2))).orderBy("feature_1").collect()
    assert [tuple(r) for r in rows] == [(1.5, None, "yes"), (2.5, None, None), (3.5, 4.5, "no")]


def test_corrupt_record_column_keeps_raw_text(spark, tmp_path):
    p = tmp_path / "y.csv"
    p.write_text("1.0,2.0,a\nbad,2.0,b\n")
    df = read_typed_csv(spark, str(p), labelled_schema(numbered(2)), corrupt_col="_corrupt").cache()
    bad = df.where(F.col("_corrupt").isNotNull()).collect()
    assert len(bad) == 1 and bad[0]["_corrupt"] == "bad,2.0,b"


def test_dirty_csv_null_count(spark):
    path = shared_dir(spark, "t_dirty")
    write_csv(fx.events_dirty_text(spark, SF_CHECK), path, header=False)
    df = read_typed_csv(spark, path, labelled_schema(numbered(2)))
    assert df.count() == 10000
    assert df.where(F.col("feature_2").isNull()).count() == 1313


# ---------------------------------------------------------------- profiles and cleaning

def test_profile_one_pass_matches_per_column(spark):
    f = fx.events_nulls(spark, SF_CHECK)
    p = {r["feature"]: r for r in profile.profile(f.df, f.features).collect()}
    for c in ("value", "hour"):
        m, s = f.df.agg(F.avg(c), F.stddev_samp(c)).first()
        assert math.isclose(p[c]["mean"], m, rel_tol=1e-12)
        assert math.isclose(p[c]["sd"], s, rel_tol=1e-12)
    assert p["empty"]["n"] == 0 and p["empty"]["lo"] is None
    assert p["constant"]["sd"] == 0 and p["constant"]["hi"] is None


def test_impute_leaves_all_null_column(spark):
    f = fx.events_nulls(spark, SF_SMALL)
    out = clean.impute_mean(f.df, f.features)
    nulls = out.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in f.features]).first()
    assert nulls["value"] == 0 and nulls["empty"] == out.count()


def test_null_counts_agree_with_the_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    counts = {r["feature"]: r["n_null"] for r in profile.null_counts(df, ["x", "s"]).collect()}
    assert counts == {"x": 2, "s": 1}
    assert profile.profile(df, ["x"]).first()["n_null"] == 2


def test_sequential_filter_leaves_no_scratch(spark):
    import os
    base = shared_dir(spark)
    f = fx.events_correlated(spark, SF_SMALL)
    before = set(os.listdir(base.removeprefix("file:")))
    assert clean.outlier_filter_sequential(f.df, f.features).count() > 0
    assert set(os.listdir(base.removeprefix("file:"))) == before


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert clean.fit_means(df, ["x"])["x"] == 2.0
    filled = [r["x"] for r in clean.impute_mean(df, ["x"]).collect()]
    assert sorted(filled) == [1.0, 2.0, 2.0, 3.0]


def test_sequential_filter_is_order_dependent(spark):
    f = fx.events_correlated(spark, SF_CHECK)
    ab = clean.outlier_filter_sequential(f.df, ["a", "b"]).count()
    at_once = clean.range_filter(f.df, profile.outlier_bounds(f.df, ["a", "b"])).count()
    assert (ab, at_once) == (9890, 9900)


def test_sequential_filter_refresh_does_not_change_result(spark):
    f = fx.embedding_wide(spark, SF_SMALL)
    cols = f.features[:20]
    a = clean.sequential_bounds(f.df, cols, refresh_every=0)
    b = clean.sequential_bounds(f.df, cols, refresh_every=3)
    c = clean.sequential_bounds(f.df, cols, materialise="cache", refresh_every=5)
    for x, y, z in zip(a, b, c):
        assert x["applied"] == y["applied"] == z["applied"]
        if x["applied"]:
            assert math.isclose(x["lo"], y["lo"], rel_tol=1e-12) and math.isclose(x["hi"], z["hi"], rel_tol=1e-12)


def test_value_outliers_after_injection(spark):
    f = fx.events_nulls(spark, SF_CHECK)
    m, s = f.df.agg(F.avg("value"), F.stddev_samp("value")).first()
    assert f.df.where(F.col("value") > m + 3 * s).count() == 156


# ---------------------------------------------------------------- encoders

def test_label_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "label string")
    assert encode.fit_label_index(df).labels == ["c", "a", "b"]


def test_scaler_zero_variance_gives_zero(spark):
    f = fx.events_nulls(spark, SF_SMALL)
    df = encode.assemble(f.df.select("hour", "constant"), ["hour", "constant"])
    out = encode.fit_scaler(df).transform(df).select("scaled_features").first()[0]
    assert out[1] == 0.0


def test_chi2_select_refuses_k_missing():
    with pytest.raises(ValueError):
        encode.chi2_selector(None)


def test_chi2_binning_is_explicit(spark):
    df = spark.range(12000).select((F.col("id") * 1.000001).alias("x"), (F.col("id") % 7).alias("y"),
                                   (F.col("id") % 2).cast("double").alias("label_indexed"))
    # without bins every distinct value is a category, and Spark's test refuses 12,000 of them
    with pytest.raises(Exception, match="distinct values"):
        encode.chi2_select_topk(df, ["x", "y"], 1)
    assert encode.chi2_select_topk(df, ["x", "y"], 1, bins=16) in (["x"], ["y"])


@pytest.mark.parametrize("n", [2_000, 200_000])
def test_chi2_keeps_the_stronger_column_at_every_size(spark, n):
    """Columns that agree with the label in 60 % and 95 % of rows; with many rows both p-values are 0."""
    y = (F.col("id") % 2).cast("double")
    agree = lambda share, salt: F.when(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(100)) < share, y).otherwise(1 - y)
    df = spark.range(n).select(agree(60, 1).alias("weak"), agree(95, 2).alias("strong"), y.alias("label_indexed"))
    for bins in (None, 8):
        assert encode.chi2_select_topk(df, ["weak", "strong"], 1, bins=bins) == ["strong"]


def test_chi2_rank_ignores_rounding():
    from tessera.operators.select import rank_slots
    assert rank_slots([(0, 1e-5 + 1e-17, 4, 30.0), (1, 1e-5, 4, 30.000000000001), (2, 0.0, 1, 900.0), (3, 0.0, 1, 5000.0)]) == [
        3, 2, 0, 1]


# ---------------------------------------------------------------- splits

def test_holdout_split_counts_and_stability(spark):
    f = fx.orders_flags(spark, SF_CHECK)
    a = split.add_split(f.df, [f.key], 42)
    counts = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == 15000 and abs(counts["train"] / 15000 - 0.7) < 0.015
    b = split.add_split(f.df.repartition(7), [f.key], 42)
    assert a.select(f.key, "split").exceptAll(b.select(f.key, "split")).count() == 0


def test_random_split_disjoint_and_complete(spark):
    f = fx.orders_flags(spark, SF_SMALL)
    tr, te = split.random_split(f.df, 42)
    assert tr.count() + te.count() == f.df.count()
    assert tr.join(te, f.key).count() == 0


def test_folds_partition_rows(spark):
    f = fx.orders_flags(spark, SF_CHECK)
    folds = split.add_folds(f.df, [f.key], 42, 5)
    sizes = [r["count"] for r in folds.groupBy("fold").count().orderBy("fold").collect()]
    assert len(sizes) == 5 and sum(sizes) == 15000 and min(sizes) > 2700


def _train_share(df, keys, seed=42):
    return split.add_split(df, keys, seed).agg(F.avg((F.col("split") == "train").cast("double"))).first()[0]


def test_null_and_compound_keys_are_told_apart(spark):
    from tessera.functions.hashing import key_text
    df = spark.createDataFrame([(1, None, 2), (1, 2, None), (None, 1, 2), (12, None, None), (1, 2, 3)], "a int, b int, c int")
    assert df.select(key_text(["a", "b", "c"]).alias("k")).distinct().count() == 5
    text = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), ("a", ":b:c"), ("a:", "b:c")], "x string, y string")
    assert text.select(key_text(["x", "y"]).alias("k")).distinct().count() == 4


def test_landed_rows_split_one_by_one(spark, tmp_path):
    """One line repeated for half of the file, and empty lines of all NULLs: each row is drawn on its own."""
    from tessera.plans import programs
    (tmp_path / "x.csv").write_text("".join(["1.5,2.5,yes\n"] * 2000 + [f"{i},{i / 7},no\n" for i in range(1000)]
                                            + [",,\n"] * 1000))
    src = programs.csv_source(spark, str(tmp_path / "x.csv"), 3)
    assert src.key == "row_id" and src.df.select("row_id").distinct().count() == 4000
    for part in (src.df, src.df.where("feature_1 = 1.5"), src.df.where("feature_1 IS NULL")):
        assert abs(_train_share(part, [src.key]) - 0.7) < 0.05


# ---------------------------------------------------------------- models and metrics

def test_metrics_equal_spark_evaluator(spark):
    f = fx.orders_flags(spark, SF_CHECK)
    ds = split.add_split(encode.assemble(encode.index_label(f.df), f.features), [f.key], 7)
    pred = models.fit_tree(ds.where("split = 'train'"), seed=7).transform(ds).cache()
    mine = {r["split"]: r for r in evaluate.metrics(pred, by=["split"]).collect()}
    for part in ("train", "test"):
        p = pred.where(F.col("split") == part)
        for metric, col in (("accuracy", "accuracy"), ("f1", "f1")):
            ev = MulticlassClassificationEvaluator(labelCol="label_indexed", metricName=metric).evaluate(p)
            assert math.isclose(mine[part][col], ev, rel_tol=1e-12)


def test_tree_recovers_rule(spark):
    f = fx.lineitem_rule(spark, SF_CHECK)
    ds = encode.assemble(encode.index_label(f.df), f.features)
    pred = models.fit_tree(ds, seed=1).transform(ds)
    assert pred.where(F.col("prediction") != F.col("label_indexed")).count() == 0


def test_logistic_closed_form(spark):
    f = fx.orders_binary(spark, SF_CHECK)
    ds = encode.assemble(encode.index_label(f.df), f.features)
    m = models.fit_logistic(ds)
    rates = {r["u"]: r["p"] for r in f.df.groupBy("u").agg(F.avg((F.col("label") == "F").cast("double")).alias("p"))
             .collect()}
    logit = lambda p: math.log(p / (1 - p))
    assert abs(m.intercept - logit(rates[0.0])) < 1e-3
    assert abs(m.coefficients[0] - (logit(rates[1.0]) - logit(rates[0.0]))) < 1e-3


def test_elastic_net_shrinks(spark):
    f = fx.document_quality(spark, SF_CHECK)
    ds = encode.assemble(encode.index_label(f.df), f.features).cache()
    small = models.fit_logistic(ds, reg_param=0.0001, elastic_net=1.0).coefficients.norm(1)
    big = models.fit_logistic(ds, reg_param=0.4, elastic_net=1.0).coefficients.norm(1)
    assert big < small


def test_tree_nodes_table(spark):
    f = fx.lineitem_rule(spark, SF_SMALL)
    m = models.fit_tree(encode.assemble(encode.index_label(f.df), f.features), seed=3)
    rows = {r["node"]: r for r in models.tree_nodes(spark, m, f.features).collect()}
    assert len(rows) == m.numNodes and rows[0]["depth"] == 0 and max(r["depth"] for r in rows.values()) == m.depth
    for r in rows.values():
        inner = r["left"] is not None
        assert (r["feature"] in f.features) == inner and (r["right"] is not None) == inner
        if inner:
            assert rows[r["left"]]["depth"] == rows[r["right"]]["depth"] == r["depth"] + 1


def test_model_seed_changes_trees_but_not_logistic_fits(spark):
    """Over 10,000 rows and 32 values the tree's candidate thresholds are sampled by its seed."""
    from tessera.sources.tables import table
    li = table(spark, SF_CHECK, "lineitem").select(
        F.col("l_extendedprice").cast("double").alias("x"), F.col("l_quantity").cast("double").alias("q"),
        F.when(F.col("l_extendedprice") * (1 + F.col("l_tax")) > 40000, "y").otherwise("n").alias("label"))
    ds = encode.assemble(encode.index_label(li), ["x", "q"]).select("features", "label_indexed").cache()
    nodes = [[(r["feature_index"], r["threshold"]) for r in models.tree_nodes(spark, models.fit_tree(ds, seed=s)).collect()]
             for s in (1, 2, 1)]
    assert nodes[0] != nodes[1] and nodes[0] == nodes[2]
    a, b = (models.logistic(maxIter=5).fit(ds) for _ in range(2))
    assert a.coefficients == b.coefficients
    ds.unpersist()


# ---------------------------------------------------------------- experiments

def test_results_csv_round_trip(spark):
    f = fx.orders_flags(spark, SF_SMALL)
    ds = encode.assemble(encode.index_label(f.df), f.features)
    long = experiment.repeated_holdout(spark, ds, [f.key], [1, 2, 3], lambda s: models.tree_classifier(seed=s),
                                       model="decision_tree")
    table = experiment.results_table(long)
    path = shared_dir(spark, "t_results")
    experiment.write_results_csv(table, path)
    back = spark.read.option("header", "true").schema(table.schema).csv(path)
    assert back.exceptAll(table).count() == 0 and table.exceptAll(back).count() == 0
    summ = {(r["split"], r["metric"]): r for r in experiment.run_summary(long).collect()}
    f1s = [r["f1"] for r in long.where("split = 'test'").collect()]
    mean = sum(f1s) / 3
    assert math.isclose(summ[("test", "f1")]["mean"], mean, rel_tol=1e-12)
    assert math.isclose(summ[("test", "f1")]["sd"], math.sqrt(sum((x - mean) ** 2 for x in f1s) / 3),
                        rel_tol=1e-9, abs_tol=1e-12)


def test_chi2_topk_equals_spark_selector_within_limit(spark):
    from pyspark.ml.feature import UnivariateFeatureSelector
    f = fx.bucketed_select(spark, SF_CHECK)
    ds = encode.assemble(encode.index_label(f.df), f.features)
    ref = UnivariateFeatureSelector(featuresCol="features", outputCol="s", labelCol="label_indexed",
                                    selectionMode="numTopFeatures")
    ref.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(2.0)
    mine = encode.chi2_selector(2, "features", "s2").fit(ds)
    assert mine.selectedFeatures == sorted(ref.fit(ds).selectedFeatures)
    assert len(mine.transform(ds).select("s2").first()[0]) == 2


def test_cleaning_fitted_on_train_rows_only(spark):
    f = fx.events_nulls(spark, SF_CHECK)
    tagged = split.add_split(f.df, [f.key], 42)
    train = F.col("split") == "train"
    means = clean.fit_means(tagged.where(train), ["value"])
    out = clean.impute_mean(tagged, ["value"], fit_where=train)
    filled = out.where((F.col("event_id") % 7 == 0)).select("value").distinct().collect()
    assert len(filled) == 1 and math.isclose(filled[0][0], means["value"], rel_tol=1e-15)
    kept = clean.outlier_filter_sequential(out, ["value"], fit_where=train)
    m, s = out.where(train).agg(F.avg("value"), F.stddev_samp("value")).first()
    assert kept.count() == out.where(F.col("value").between(m - 3 * s, m + 3 * s)).count()


def test_runs_hash_their_key_once(spark, monkeypatch):
    """The cached rows of repeated runs carry each seed's side, which equals the split's; the runs hash nothing."""
    from tessera.operators import encode, experiment, models, split
    df = encode.assemble(spark.range(300).selectExpr("id k", "cast(id % 5 AS double) x", "cast(id % 3 AS double) label_indexed"), ["x"])
    once, given = experiment._run_once, []

    def seen(rows, *rest):
        given.append((rows.columns, rows._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]))
        return once(rows, *rest)

    monkeypatch.setattr(experiment, "_run_once", seen)
    long = experiment.repeated_holdout(spark, df, ["k"], [42, 7], lambda s: models.tree_classifier(seed=s)).collect()
    assert all("__key" not in columns and "md5" not in plan for columns, plan in given) and len(given) == 2
    for s in (42, 7):
        assert {r["split"]: r["n"] for r in long if r["seed"] == s} == {
            r["split"]: r["count"] for r in split.add_split(df, ["k"], s).groupBy("split").count().collect()}
