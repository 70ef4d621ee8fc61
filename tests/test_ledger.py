"""The ledger connector: commits, lost and repeated tasks, pruning, exact round trips."""

import math
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThan

from tessera.session import shared_dir
from tessera.sources import ledger

SCHEMA = "k long, s string, d double, b boolean, a array<int>"


def table(n, seed=0):
    rnd = random.Random(seed)
    return [(None if i % 11 == 0 else i, rnd.choice((None, "", "é", "x" * 50)), rnd.choice((None, float("nan"), 1.5, -2.0)), rnd.choice((None, True)),
             rnd.choice((None, [], [1, None, 2]))) for i in range(n)]


def canon(rows):
    return sorted((tuple("nan" if isinstance(c, float) and math.isnan(c) else c for c in r) for r in rows), key=str)


@pytest.fixture
def path(spark):
    ledger.register(spark)
    return shared_dir(spark, "ledger")


def read(spark, path):
    return spark.read.format("ledger").option("path", path).load()


def test_round_trip_append_and_overwrite(spark, path):
    one, two = table(300), table(50, 1)
    df = spark.createDataFrame(one, SCHEMA).repartition(4)
    df.write.format("ledger").option("path", path).mode("append").save()
    assert canon(read(spark, path).collect()) == canon(one) and read(spark, path).schema == df.schema
    spark.createDataFrame(two, SCHEMA).write.format("ledger").option("path", path).mode("append").save()
    assert canon(read(spark, path).collect()) == canon(one + two)
    spark.createDataFrame(two, SCHEMA).write.format("ledger").option("path", path).mode("overwrite").save()
    assert canon(read(spark, path).collect()) == canon(two)
    assert ledger.vacuum(path) > 0 and canon(read(spark, path).collect()) == canon(two)
    df.limit(0).write.format("ledger").option("path", path).mode("overwrite").save()
    assert read(spark, path).count() == 0


def test_lost_and_repeated_tasks(spark, path):
    """A task that wrote its part but was lost, and one that was run again, change nothing."""
    df = spark.createDataFrame(table(40), SCHEMA)
    df.write.format("ledger").option("path", path).mode("append").save()
    writer = ledger.LedgerWriter(path, df.schema, False)
    batch = pa.RecordBatch.from_pylist([{"k": 1000, "s": "new", "d": 0.5, "b": True, "a": [1]}],
                                       pa.schema([("k", pa.int64()), ("s", pa.string()), ("d", pa.float64()), ("b", pa.bool_()), ("a", pa.list_(pa.int32()))]))
    lost = writer.write(iter([batch]))
    assert os.path.exists(os.path.join(path.removeprefix("file://"), lost.name)) and read(spark, path).count() == 40
    writer.commit([writer.write(iter([batch])), None])
    assert canon(read(spark, path).collect()) == canon(table(40) + [(1000, "new", 0.5, True, [1])])
    assert ledger.vacuum(path) == 1


def test_failed_jobs_and_rival_commits(spark, path):
    df = spark.createDataFrame(table(40), SCHEMA).repartition(4)
    df.write.format("ledger").option("path", path).mode("append").save()
    broken = df.withColumn("k", F.when(F.col("k") == 7, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("k")))
    with pytest.raises(Exception):
        broken.write.format("ledger").option("path", path).mode("append").save()
    assert canon(read(spark, path).collect()) == canon(table(40))
    first, second = ledger.LedgerWriter(path, df.schema, False), ledger.LedgerWriter(path, df.schema, False)
    first.commit([])
    with pytest.raises(RuntimeError):
        second.commit([])
    assert read(spark, path).count() == 40


def test_pushed_comparisons_prune_parts(spark, path):
    df = spark.range(10_000).selectExpr("id as k", "cast(id as string) as s")
    df.repartitionByRange(8, "k").write.format("ledger").option("path", path).mode("append").save()
    few = read(spark, path).where("k >= 9000 and k < 9100")
    assert few.count() == 100
    reader = ledger.LedgerReader(path)
    left = list(reader.pushFilters([GreaterThan(("k",), 9500)]))
    assert len(left) == 1 and len(reader.partitions()) == 1
    assert read(spark, path).where("k in (5, 9999) or s = '17'").count() == 3
    assert read(spark, path).where("k > 20000").count() == 0 and read(spark, path).where("k is null").count() == 0
