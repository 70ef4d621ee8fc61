"""Partition sizing and fit concurrency."""

from tessera.operators import layout


def test_small_input_coalesced_large_kept(spark):
    small, n = layout.cache_counted(spark.range(1000).repartition(8))
    assert n == 1000 and small.rdd.getNumPartitions() == 1
    small.unpersist()
    big, n = layout.cache_counted(spark.range(1000).repartition(8), rows_per_partition=100)
    assert big.rdd.getNumPartitions() == 8  # 10 wanted, never more than it had
    big.unpersist()
    mid, _ = layout.cache_counted(spark.range(1000).repartition(8), rows_per_partition=300)
    assert mid.rdd.getNumPartitions() == 4
    mid.unpersist()


def test_fit_concurrency_bounded_by_bytes():
    assert layout.fit_concurrency(1_000, 40, 32) == 32
    assert layout.fit_concurrency(1_000_000, 98, 32, fit_bytes=4 * 800_000_000) == 4
    assert layout.fit_concurrency(10**12, 1, 32) == 1


def test_vector_width(spark):
    from tessera.operators import encode
    df = encode.assemble(spark.range(3).selectExpr("id", "cast(id as double) x", "1.0D y"), ["x", "y"])
    assert layout.vector_width(df, "features") == 2


def test_fit_budget_is_what_executors_store(spark):
    assert layout.fit_budget(spark, 5) == 5
    assert 0 < layout.fit_budget(spark) < layout.FIT_BYTES
    # a narrow row is held as an object by a tree: two of these fits do not fit into 8 GB
    assert layout.fit_concurrency(38_000_000, 1, 8, fit_bytes=8 << 30) == 1
