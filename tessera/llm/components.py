"""Connected components of an edge table, and written tables between steps.

Components are found by repeated minimum-label exchange with pointer
jumping: every round is two joins and two aggregates in Spark, and the driver
only reads one count per round. Each round's labels are written to the shared
folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir


_collected: ContextVar[list[DataFrame] | None] = ContextVar("collected", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back. The table stays until it is discarded: an operator's result
    may still read it. Within :func:`collecting` it is listed for that."""
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_path = path
    if (into := _collected.get()) is not None:
        into.append(back)
    return back


@contextmanager
def collecting(into: list[DataFrame]) -> Iterator[list[DataFrame]]:
    """Every table written inside is added to ``into``, for :func:`discard` once the result has been used."""
    token = _collected.set(into)
    try:
        yield into
    finally:
        _collected.reset(token)


def discard(df: DataFrame) -> None:
    """Remove a written table that no later step reads (one that is gone already is no error)."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._written_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label), a written table, with the smallest node of its component as the label.

    Nodes are longs; self loops and repeated edges are allowed. Nodes without
    an edge are not in the result.
    """
    both = written(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
             .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = labels_table = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label"))
                         .withColumnRenamed("u", "node"), "labels")
    while True:
        # the smallest label among a node's neighbours, then the label of that label
        near = (both.join(labels, both["v"] == labels["node"]).groupBy("u")
                    .agg(F.min("label").alias("near")).withColumnRenamed("u", "node"))
        hooked = labels.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("low"))
        # a label hears of the lowest label any of its members has seen
        told = hooked.groupBy("label").agg(F.min("low").alias("best"))
        step = hooked.join(told, "label").select("node", "label", F.least("low", "best").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = written(step.join(jump, "next", "left").select(
            "node", F.col("label").alias("old"),
            F.least("next", F.coalesce("far", "next")).alias("label")), "labels")
        discard(labels_table)
        labels_table = step
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            discard(both)
            labels._written_path = step._written_path
            return labels


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are already written.

    Spark removes them when the driver's JVM collects the plans that own them, which else may
    take until the end of the job. Python's handles of these plans go first, a moment later.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
