"""Session helpers.

Operators never create or stop a session; the caller owns it. These helpers
exist for tests, the bench harness and the command-line entry points.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera") -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, sub: str | None = None) -> str:
    """Directory on storage shared by the whole cluster.

    Read from ``spark.checkpoint.dir`` (set by the cluster); only when it is
    unset (local tests) a fresh scratch directory is created and registered,
    so ``DataFrame.checkpoint()`` and written intermediate tables land in the
    same place. With ``sub`` a fresh, unique child path is returned.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder on storage shared by the cluster")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, base)
        spark.sparkContext.setCheckpointDir(base)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    if sub is None:
        return base
    return f"{base}/{sub}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage, whatever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
