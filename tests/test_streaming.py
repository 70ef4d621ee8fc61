"""Fitted preparation + model applied to a file stream gives the batch result."""

import math

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tessera import streaming
from tessera.operators import evaluate, models
from tessera.session import shared_dir
from tessera.sources import fixtures as fx


def test_stream_scoring_matches_batch(spark):
    f = fx.events_nulls(spark, SF_SMALL)
    feats = ["value", "hour"]
    prep = streaming.fit_preparation(f.df, feats)
    batch = prep.apply(f.df)
    model = models.fit_tree(batch, seed=1)
    expected = evaluate.metrics(model.transform(batch)).first()

    src = shared_dir(spark, "t_stream_src")
    f.df.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(f.df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    counts = streaming.running_confusion(streaming.score_stream(stream, prep, model))
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("t_stream_counts")
         .option("checkpointLocation", shared_dir(spark, "t_stream_ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = streaming.metrics_snapshot(spark.table("t_stream_counts")).first()
    assert got["n"] == expected["n"]
    assert math.isclose(got["f1"], expected["f1"], rel_tol=1e-12)
    assert math.isclose(got["accuracy"], expected["accuracy"], rel_tol=1e-12)
    assert spark.table("t_stream_counts").agg(F.sum("n")).first()[0] == batch.count()
