"""As-of join, sessions, exact quantiles and sketches against brute force; hot keys are cut by time."""

import bisect
import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import selection, sketches, timeline


def rows(seed, n=400, keys=5, times=300, hot=0.4):
    rnd = random.Random(seed)
    return [(i, None if rnd.random() < 0.03 else 0 if rnd.random() < hot else rnd.randrange(keys), None if rnd.random() < 0.03 else rnd.randrange(times))
            for i in range(n)]


@pytest.mark.parametrize("seed,per_range", [(0, 1_000_000), (1, 37), (2, 5), (3, 1)])
def test_asof_join(spark, seed, per_range):
    left, right = rows(seed), rows(seed + 100, 200)
    a = spark.createDataFrame(left, "id long, k long, at long")
    b = spark.createDataFrame(right, "pid long, k long, t long")
    out = timeline.asof_join(a, b, "k", "at", "t", ["pid", "t"], per_range)
    assert out.columns == ["id", "k", "at", "pid", "t"]
    want = []
    for i, k, at in left:
        seen = [(t, p) for p, kk, t in right if None not in (kk, t, k, at) and kk == k and t <= at]
        t, p = max(seen) if seen else (None, None)
        want.append((i, k, at, p, t))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert timeline.asof_join(a.limit(0), b, "k", "at", "t", ["pid"]).count() == 0
    assert {r.pid for r in timeline.asof_join(a, b.limit(0), "k", "at", "t", ["pid"]).collect()} == {None}


@pytest.mark.parametrize("seed,per_range", [(0, 1_000_000), (1, 40), (2, 3)])
def test_sessions(spark, seed, per_range):
    events = rows(seed, 500, 4, 4000)
    df = spark.createDataFrame(events, "id long, k long, t long")
    got = {r.id: r.session for r in timeline.sessions(df, "k", "t", 20, per_range).collect()}
    want = {}
    for key in {k for _, k, _ in events if k is not None}:
        last, number = None, 0
        for t, i in sorted((t, i) for i, k, t in events if k == key and t is not None):
            number += last is None or t - last > 20
            want[i], last = number, t
    assert got == want
    assert timeline.sessions(df.limit(0), "k", "t", 20).count() == 0


def test_a_hot_key_is_cut_by_time(spark):
    """A third of the rows share a key: no group of (key, range) holds more than a few ranges' worth."""
    df = spark.createDataFrame([(i % 3 == 0 and 7 or i, i) for i in range(9000)], "k long, t long")
    cuts = timeline.borders(df.select("t"), 300)
    assert len(cuts) == 29
    groups = df.withColumn("r", timeline.range_of(F.col("t"), cuts)).groupBy("k", "r").count()
    assert groups.agg(F.max("count")).first()[0] < 200
    xs = spark.range(-2, 9002).select("id", timeline.range_of(F.col("id"), cuts).alias("r"))
    assert all(r.r == bisect.bisect_right(cuts, r.id) for r in xs.collect())


@pytest.mark.parametrize("seed,bins", [(0, 4), (1, 1024), (2, 2)])
def test_quantiles_and_largest(spark, seed, bins):
    rnd = random.Random(seed)
    data = [(rnd.choice((1.5, 1.5, rnd.gauss(0, 1), -1e308, 1.7e308, rnd.random() * 1e-300, None, float("nan"))), float(rnd.randrange(4)), None, 3.0)
            for _ in range(300)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    qs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r.feature, r.q): r.value for r in selection.quantiles(df, list("abcd"), qs, bins).collect()}
    for j, c in enumerate("abcd"):
        values = sorted(r[j] for r in data if r[j] is not None and not math.isnan(r[j]))
        for q in qs:
            assert got[c, q] == (values[max(1, math.ceil(q * len(values))) - 1] if values else None), (c, q)
    ranked = sorted((r[1] for r in data), reverse=True)
    assert sorted(r.b for r in selection.largest(df, "b", 90, bins).collect()) == sorted(x for x in ranked if x >= ranked[89])
    assert selection.largest(df, "c", 5).count() == 0 and selection.largest(df, "b", 10_000).count() == len(data)


def test_sketches_merge_to_the_same_estimates(spark):
    df = spark.range(20_000).selectExpr("id % 7 as g", "id % 3 as h", "id % 5000 as u", "cast(id as double) as v")
    stored = sketches.summarise(df, ["g", "h"], "u", "v")
    merged = {r.h: r for r in sketches.estimates(sketches.merge(stored, ["h"]), [0.1, 0.9]).collect()}
    assert set(merged) == {0, 1, 2} and sum(r.n for r in merged.values()) == 20_000
    for r in merged.values():
        assert abs(r.n_distinct - 5000) <= sketches.DISTINCT_ERROR * 5000
        assert all(abs(x / 20_000 - q) <= sketches.RANK_ERROR for x, q in zip(r.quantiles, (0.1, 0.9)))
    empty = spark.createDataFrame([(1, None, None), (1, None, float("nan"))], "g int, u long, v double")
    r = sketches.estimates(sketches.summarise(empty, ["g"], "u", "v"), [0.5]).first()
    assert (r.n, r.n_distinct, r.quantiles) == (2, 0, None)


def test_late_rows_are_dropped_by_the_watermark(spark):
    """The replayed windows hold fewer rows than the table, and no open window loses one."""
    from conftest import SF_CHECK
    from tessera.plans import mechanisms
    from tessera.sources.tables import table
    got = mechanisms.streaming_windows(spark, SF_CHECK).agg(F.sum("n")).first()[0]
    n = table(spark, SF_CHECK, "events").count()
    assert 0.9 * n < got < n
