"""Windowed profiles over event time, with a watermark.

:func:`windowed_profile` is the streaming aggregate: tumbling windows of event time per key, count, sum, minimum and maximum. State is one row per open
(window, key); the watermark drops rows that come after their window is closed, so state does not grow with the stream.

:func:`replay` runs it over files that arrive in order (one micro-batch per group of files) and returns the last state of each window.
Update mode writes every changed window with its batch number to a table in the shared folder; a retried batch writes the same rows in
its own folder again, so the result is the same after a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir


def windowed_profile(stream: DataFrame, time: str, key: str, value: str, width: str, delay: str) -> DataFrame:
    """(started, key, n, total, low, high) per tumbling window of ``width``; rows more than ``delay`` late may be dropped."""
    late = stream.withWatermark(time, delay)
    return late.groupBy(F.window(time, width).alias("w"), F.col(key)).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")).select(
        F.col("w.start").alias("started"), key, "n", "total", "low", "high")


def land_arrivals(df: DataFrame, batch: Column, batches: int, files: int) -> str:
    """Folder with ``files`` files per batch number, in order of arrival. Rows of a batch are spread over its files."""
    path = shared_dir(df.sparkSession, "arrivals")
    numbered = df.withColumn("_batch", batch).cache()
    try:
        for b in range(batches):
            numbered.where(F.col("_batch") == b).drop("_batch").repartition(files).write.mode("append").parquet(path)
    finally:
        numbered.unpersist()
    return path


def replay(spark: SparkSession, path: str, schema, files: int, time: str, key: str, value: str, width: str, delay: str) -> DataFrame:
    """The last state of every window after all files under ``path``."""
    out = shared_dir(spark, "windows")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)

    def keep(changed: DataFrame, number: int) -> None:
        changed.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (windowed_profile(stream, time, key, value, width, delay).writeStream.outputMode("update").foreachBatch(keep)
             .option("checkpointLocation", shared_dir(spark, "windows-state")).trigger(availableNow=True).start())
    query.awaitTermination()
    rows = spark.read.parquet(f"{out}/*")
    last = F.max_by(F.struct("n", "total", "low", "high"), "batch").alias("s")
    return rows.groupBy("started", key).agg(last).select("started", key, "s.*")
