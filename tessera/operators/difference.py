"""Difference of two tables as multisets.

:func:`difference` reports what must be removed from and added to one table to get the other, with multiplicities. Rows are compared in all columns;
NULL equals NULL.

Equal parts of the tables are not compared row by row: rows are filed in buckets by the hash of their key, and each bucket has an order-independent
digest (count, sum of one row hash, exclusive or of another). Both tables are read once for the digests, combined before the shuffle. Only rows of buckets
whose digests differ are read again and take part in the one aggregate that nets out multiplicities. Two tables that are
almost equal so shuffle little more than the digests.

A key that loses and gains rows has changed: its rows are ``changed_from`` and ``changed_to``; other rows are ``removed`` or ``added``. A NULL key is
a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def row_hash(cols: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row; NULLs are told apart by their place."""
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def bucket_digests(df: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, total, mixed) of every bucket with rows."""
    cols = df.columns
    filed = df.select(F.pmod(row_hash(key, 0), F.lit(buckets)).alias("bucket"), row_hash(cols, 1).alias("h1"), row_hash(cols, 2).alias("h2"))
    return filed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("h1").cast("decimal(20,0)")).alias("total"), F.bit_xor("h2").alias("mixed"))


def unequal_buckets(old: DataFrame, new: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket) where the tables differ; at most ``buckets`` rows."""
    sides = bucket_digests(old, key, buckets).unionByName(bucket_digests(new, key, buckets))
    seen = sides.groupBy("bucket").agg(F.count("*").alias("sides"), F.count_distinct("n", "total", "mixed").alias("kinds"))
    return seen.where("sides < 2 OR kinds > 1").select("bucket")


def difference(old: DataFrame, new: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(change, n, columns...): rows to remove from ``old`` and to add to get ``new``."""
    cols = old.columns
    new = new.select(*cols)
    rest = F.broadcast(unequal_buckets(old, new, key, buckets))      # at most ``buckets`` numbers

    def signed(df: DataFrame, sign: int) -> DataFrame:
        filed = df.withColumn("_bucket", F.pmod(row_hash(key, 0), F.lit(buckets)))
        return filed.join(rest, F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket").withColumn("_sign", F.lit(sign))

    net = signed(old, -1).unionByName(signed(new, 1)).groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    # keys that lose and gain rows: an aggregate, so a key of many rows is combined before the shuffle
    both = net.groupBy(*[F.col(f"`{c}`") for c in key]).agg((F.min("_net") < 0).alias("_loses"), (F.max("_net") > 0).alias("_gains"))
    both = both.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(key)], (F.col("_loses") & F.col("_gains")).alias("_changed"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    out = net.join(both, same)
    change = (F.when(F.col("_changed") & (F.col("_net") < 0), "changed_from").when(F.col("_changed"), "changed_to")
               .when(F.col("_net") < 0, "removed").otherwise("added"))
    return out.select(change.alias("change"), F.abs("_net").cast("long").alias("n"), *[F.col(f"`{c}`") for c in cols])


def patch(old: DataFrame, changes: DataFrame) -> DataFrame:
    """``old`` with the rows of :func:`difference` removed and added: the new table."""
    cols = old.columns
    lost = changes.where(F.col("change").isin("removed", "changed_from"))
    gained = changes.where(F.col("change").isin("added", "changed_to"))
    repeated = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))

    def rows(part: DataFrame) -> DataFrame:
        return part.select(*[F.col(f"`{c}`") for c in cols], repeated.alias("_i")).drop("_i")

    return old.exceptAll(rows(lost)).unionByName(rows(gained))
