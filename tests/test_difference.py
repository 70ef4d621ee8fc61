"""Table differences, grouping sets and variants against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import difference, levels
from tessera.sources import variants


def table(rnd, n):
    return [(rnd.choice((None, *range(12))), rnd.choice((None, "a", "b")), rnd.choice((None, 1.5, float("nan"))), rnd.choice((None, "a", "b"))) for _ in range(n)]


@pytest.mark.parametrize("seed,buckets", [(0, 1), (1, 7), (2, 4096)])
def test_difference_equals_counters(spark, seed, buckets):
    """Repeated rows, NULLs that swap places, NaN and NULL keys."""
    rnd = random.Random(seed)
    old = table(rnd, 120)
    new = [r for r in old if rnd.random() < 0.8] + table(rnd, 15) + [(k, d, v, b) for k, b, v, d in old[:10]]
    schema = "k long, a string, v double, b string"
    x, y = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select("b", "v", "a", "k")
    out = difference.difference(x, y, ["k"], buckets)
    canon = lambda r: tuple("nan" if isinstance(c, float) and c != c else c for c in r)
    a, b = Counter(map(canon, old)), Counter(map(canon, new))
    lost, gained = a - b, b - a
    changed = {r[0] for r in lost} & {r[0] for r in gained}
    want = {(("changed_from" if r[0] in changed else "removed"), n, *r) for r, n in lost.items()}
    want |= {(("changed_to" if r[0] in changed else "added"), n, *r) for r, n in gained.items()}
    assert {canon(r) for r in out.collect()} == want and out.count() == len(want)
    assert Counter(canon(r) for r in difference.patch(x, out).collect()) == b


def test_equal_parts_are_not_compared(spark):
    x = spark.range(2000).selectExpr("id as k", "id % 7 as v")
    y = x.withColumn("v", F.when(F.col("k") == 1234, 99).otherwise(F.col("v")))
    assert difference.unequal_buckets(x, x.orderBy(F.rand(1)), ["k"]).count() == 0
    assert difference.unequal_buckets(x, y, ["k"]).count() == 1
    assert {tuple(r) for r in difference.difference(x, y, ["k"]).collect()} == {("changed_from", 1, 1234, 2), ("changed_to", 1, 1234, 99)}
    assert difference.difference(x, x.limit(0), ["k"]).groupBy("change").count().collect()[0] == ("removed", 2000)
    assert difference.difference(x.limit(0), x.limit(0), ["k"]).count() == 0


def test_levels_tell_totals_from_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", 4), (None, None, 8)], "p string, q string, v long")
    out = levels.aggregate_levels(df, ["p", "q"], levels.cube_sets(["p", "q"]), [F.sum("v").alias("v")])
    got = {(r.level, r.p, r.q): r.v for r in out.collect()}
    assert got == {(0, "a", None): 1, (0, "a", "x"): 2, (0, None, "x"): 4, (0, None, None): 8, (1, "a", None): 3, (1, None, None): 12,
                   (2, None, None): 9, (2, None, "x"): 6, (3, None, None): 15}
    assert levels.rollup_sets(["p", "q"]) == [["p", "q"], ["p"], []]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Scan ExistingRDD") == 1


def test_variants(spark):
    text = ['{"a": 1, "l": [1, 2]}', '{"a": "x", "l": "no"}', '{"a": 1.5}', "{broken", None, "null", "[]"]
    df = variants.parse(spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, t string"), "t")
    got = {r.i: (r.v_bad, r.n, r.s) for r in variants.fields(df, {"n": ("$.a", "long"), "s": ("$.a", "string")}).collect()}
    assert got == {0: (False, 1, "1"), 1: (False, None, "x"), 2: (False, 1, "1.5"), 3: (True, None, None), 4: (False, None, None),
                   5: (False, None, None), 6: (False, None, None)}, got
    assert [(r.i, r.pos, r.item) for r in variants.explode_list(df, ["i"], "$.l", "long").orderBy("i", "pos").collect()] == [(0, 0, 1), (0, 1, 2)]
    assert "a" in variants.schema_of(df.where("i < 3")).first().schema
