"""Partition sizing and fit concurrency for frames that are scanned many
times (model fits).

Iterative fits run one Spark job per optimiser iteration (or tree level), so
every partition of their cached input costs one task per iteration. Small
inputs split into many tiny partitions pay that overhead for nothing, large
inputs need their partitions for parallelism. :func:`cache_sized` caches a
frame, counts it, and coalesces (no shuffle) only when its partitions hold
far fewer rows than the target.

Each concurrent fit also keeps its own cached copy of its training rows
(``pyspark.ml`` persists the instances it iterates over), so the number of fits in flight
is bounded by a budget in bytes, an argument of everything that fits in parallel (half of the
executors' storage memory if not given): what one fit holds is the training rows times the bytes of a row, in blocks of
doubles (regression) or as one object per row (trees), whichever is more.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_PARTITION = 250_000
FIT_BYTES = 64 << 30


def executor_storage(spark: SparkSession) -> list[int]:
    """Bytes of storage memory of every executor (of the driver in local mode). The driver is listed among
    them; the largest is left out for it, so the sum is never too high."""
    each = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    sizes = []
    while each.hasNext():
        sizes.append(int(each.next()._1()))
    return sorted(sizes)[:-1] if len(sizes) > 1 else sizes


def fit_budget(spark: SparkSession, fit_bytes: int | None = None) -> int:
    """Bytes that all fits in flight may hold: as given, or half of the executors' storage memory."""
    return fit_bytes if fit_bytes is not None else sum(executor_storage(spark)) // 2


def partitions_for(n: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    return max(1, math.ceil(n / rows_per_partition))


def cache_counted(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION,
                  level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> tuple[DataFrame, int]:
    """(persisted copy of ``df`` with about ``rows_per_partition`` rows per
    partition -- never more partitions than it had --, its row count).
    The caller unpersists."""
    held = df.persist(level)
    n = held.count()
    have = held.rdd.getNumPartitions()
    want = partitions_for(n, rows_per_partition)
    if want >= have:
        return held, n
    sized = held.coalesce(want).persist(level)
    sized.count()
    held.unpersist()
    return sized, n


def cache_sized(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION,
                level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    return cache_counted(df, rows_per_partition, level)[0]


def fit_concurrency(train_rows: int, width: int, requested: int, fit_bytes: int = FIT_BYTES) -> int:
    """Concurrent fits allowed for a training set of ``train_rows`` vectors of ``width``
    doubles when all fits together may hold ``fit_bytes``. A row takes 8 bytes per double in a block, or as the
    object that trees keep of it 112 bytes and 4 per feature."""
    row = max((width + 2) * 8, 112 + 4 * width)
    return max(1, min(requested, fit_bytes // max(1, train_rows * row)))


def vector_width(df: DataFrame, col: str) -> int:
    """Width of a vector column, from its metadata or else its first row."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    row = df.select(col).first()
    return len(row[0]) if row is not None else 0
