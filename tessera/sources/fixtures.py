"""Labelled feature tables derived from the test tables.

Each fixture is a lazy projection of one table (or one join) with a key,
numeric feature columns and a string label, i.e. the shape the classifier
programs consume (numeric features + label). They are Spark plans over the
whole table, so their size grows with the scale factor; NULLs and dirty text
are injected by key so every row is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


@dataclass
class Fixture:
    df: DataFrame
    features: list[str]
    label: str = "label"
    key: str | None = None


def orders_flags(spark: SparkSession, sf_dir: str) -> Fixture:
    """f1 = priority digit (5 values), label = order status (3 classes)."""
    o = table(spark, sf_dir, "orders")
    df = o.select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("double").alias("f1"),
        F.col("o_orderstatus").alias("label"),
    )
    return Fixture(df, ["f1"], key="o_orderkey")


def orders_binary(spark: SparkSession, sf_dir: str) -> Fixture:
    """u = urgent flag, label = 'F' or 'notF' (binary, rate far from 1/2)."""
    o = table(spark, sf_dir, "orders")
    df = o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0).alias("u"),
        F.when(F.col("o_orderstatus") == "F", "F").otherwise("notF").alias("label"),
    )
    return Fixture(df, ["u"], key="o_orderkey")


def lineitem_rule(spark: SparkSession, sf_dir: str) -> Fixture:
    """Label defined by a two-threshold rule a depth-2 tree can recover."""
    li = table(spark, sf_dir, "lineitem")
    df = li.select(
        "l_discount", "l_tax",
        F.when((F.col("l_discount") > 0.05) & (F.col("l_tax") > 0.03), "yes").otherwise("no").alias("label"),
    )
    return Fixture(df, ["l_discount", "l_tax"])


def lineitem_encode(spark: SparkSession, sf_dir: str) -> Fixture:
    li = table(spark, sf_dir, "lineitem")
    df = li.select("l_quantity", "l_discount", "l_tax", F.col("l_returnflag").alias("label"))
    return Fixture(df, ["l_quantity", "l_discount", "l_tax"])


def events_nulls(spark: SparkSession, sf_dir: str) -> Fixture:
    """value NULL on every 7th key, hour of day, an all-NULL and a constant column."""
    ev = table(spark, sf_dir, "events")
    df = ev.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.hour("ts").cast("double").alias("hour"),
        F.lit(None).cast("double").alias("empty"),
        F.lit(1.0).alias("constant"),
        F.col("event_type").alias("label"),
    )
    return Fixture(df, ["value", "hour", "empty", "constant"], key="event_id")


def events_correlated(spark: SparkSession, sf_dir: str) -> Fixture:
    """Outliers of ``a`` coincide with outliers of ``b``: the sequential
    3-sigma filter keeps a different row set than the all-at-once filter."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    df = ev.select(
        "event_id",
        F.when(eid % 100 == 0, 50.0).otherwise((eid % 11) / 100.0).alias("a"),
        F.when(eid % 100 == 0, 1000.0).when(eid % 1000 == 1, 20.0).otherwise((eid % 9) / 100.0).alias("b"),
        F.col("event_type").alias("label"),
    )
    return Fixture(df, ["a", "b"], key="event_id")


def embedding_wide(spark: SparkSession, sf_dir: str, width: int = 64) -> Fixture:
    """64 double features from the embedding array, label as string."""
    emb = table(spark, sf_dir, "embeddings")
    names = [f"feature_{i + 1}" for i in range(width)]
    df = emb.select(
        "vec_id",
        *[F.col("embedding").getItem(i).cast("double").alias(n) for i, n in enumerate(names)],
        F.col("label").cast("string").alias("label"),
    )
    return Fixture(df, names, key="vec_id")


def bucketed_select(spark: SparkSession, sf_dir: str) -> Fixture:
    """Four features with 5 values each (equal degrees of freedom)."""
    ev = table(spark, sf_dir, "events")
    df = ev.select(
        "event_id",
        (F.col("event_id") % 5).cast("double").alias("c1"),
        (F.floor(F.col("event_id") / 5) % 5).cast("double").alias("c2"),
        (F.col("user_id") % 5).cast("double").alias("c3"),
        (F.minute("ts") % 5).cast("double").alias("c4"),
        F.col("event_type").alias("label"),
    )
    return Fixture(df, ["c1", "c2", "c3", "c4"], key="event_id")


def document_quality(spark: SparkSession, sf_dir: str) -> Fixture:
    """documents joined to their quality labels; length, word and line counts.

    Both sides are keyed by doc_id; the planner picks the join strategy
    (labels are a small subset, AQE turns it into a broadcast when its
    measured size allows). Whole texts are measured, never prefixes.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    df = docs.join(labels, "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.col("text"), r"\s+")).cast("double").alias("n_words"),
        # newline count + 1 (= parts of a split on newline, without building the array)
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1)
        .cast("double").alias("n_lines"),
        F.col("quality").cast("string").alias("label"),
    )
    return Fixture(df, ["n_chars", "n_words", "n_lines"], key="doc_id")


def orders_dirty(spark: SparkSession, sf_dir: str) -> Fixture:
    """orders_flags with f1 NULL on every 13th and 1000 on every 101st key: both cleaning steps
    have work, and every remaining value of f1 decides by its majority label."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1).cast("double")
    df = o.select(
        "o_orderkey",
        F.when(key % 13 == 0, F.lit(None).cast("double")).when(key % 101 == 0, 1000.0).otherwise(digit).alias("f1"),
        F.col("o_orderstatus").alias("label"),
    )
    return Fixture(df, ["f1"], key="o_orderkey")


def orders_two_flags(spark: SparkSession, sf_dir: str) -> Fixture:
    """Two binary features: u raises the rate of label 'F' from 3 to 8 in 10, w says nothing about it."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    df = o.select(
        "o_orderkey",
        F.when(urgent, 1.0).otherwise(0.0).alias("u"),
        (F.floor(key / 10) % 2).cast("double").alias("w"),
        F.when((key * 7 + F.floor(key / 10) * 3) % 10 < F.when(urgent, 8).otherwise(3), "F").otherwise("notF").alias("label"),
    )
    return Fixture(df, ["u", "w"], key="o_orderkey")


def events_dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as text rows for the CSV scan: 'abc' on every 13th key, empty on every 17th."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    value_text = (F.when(eid % 13 == 0, F.lit("abc"))
                  .when(eid % 17 == 0, F.lit(""))
                  .otherwise(F.col("value").cast("string")))
    return ev.select(eid.cast("string").alias("event_id"), value_text.alias("value"), "event_type")


FIXTURES = {
    "orders_flags": orders_flags,
    "orders_binary": orders_binary,
    "orders_dirty": orders_dirty,
    "orders_two_flags": orders_two_flags,
    "lineitem_rule": lineitem_rule,
    "lineitem_encode": lineitem_encode,
    "events_nulls": events_nulls,
    "events_correlated": events_correlated,
    "embedding_wide": embedding_wide,
    "bucketed_select": bucketed_select,
    "document_quality": document_quality,
}
