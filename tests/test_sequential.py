"""The sequential filter in few passes equals the filter as it is defined, one column after the other."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean


def table(seed, n=600, m=7):
    """Heavy tails, columns that follow each other, missing values, and columns that say nothing."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = rnd.gauss(0, 1) * (50 if rnd.random() < 0.01 else 1)
        row = [a, a + rnd.gauss(0, .1) * (30 if rnd.random() < 0.02 else 1), rnd.expovariate(1), 1e9 if i == 3 else rnd.random(),
               rnd.choice((0.0, 0.0, 0.0, 1.0)), 7.5, None]
        row += [row[j % 5] * rnd.gauss(1, .2) for j in range(m - 7)]
        if rnd.random() < 0.05:
            row[rnd.randrange(m)] = rnd.choice((None, float("nan")))
        rows.append(tuple(row))
    return rows


def near(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))


@pytest.mark.parametrize("seed,m,k,narrow", [(0, 7, 3.0, 0.95), (1, 12, 2.0, 0.95), (2, 9, 1.0, 0.99), (3, 10, 0.5, 1.2)])
def test_equals_stepwise(spark, seed, m, k, narrow):
    cols = [f"c{j}" for j in range(m)]
    df = spark.createDataFrame(table(seed, m=m), ", ".join(f"{c} double" for c in cols)).withColumn("x", F.lit("kept"))
    fast, slow = clean.sequential_bounds(df, cols, k, narrow=narrow), clean.stepwise_bounds(df, cols, k, materialise="cache")
    for a, b in zip(fast, slow):
        assert a["column"] == b["column"] and a["applied"] == b["applied"]
        assert near(a["lo"], b["lo"]) and near(a["hi"], b["hi"]) and near(a["sd"], b["sd"]), (a, b)
    assert sum(s["applied"] for s in fast) >= 4
    kept = {s["column"]: (s["lo"], s["hi"]) for s in slow if s["applied"]}
    assert clean.outlier_filter_sequential(df, cols, k).count() == df.where(clean.bounds_predicate(kept)).count()


def test_scans_do_not_grow_with_columns(spark, monkeypatch):
    """All rows, plain rows, suspects: three scans of the table for 40 columns."""
    rnd = random.Random(9)
    cols = [f"c{j}" for j in range(40)]
    df = spark.createDataFrame([tuple(rnd.gauss(0, 1) for _ in cols) for _ in range(400)], ", ".join(f"{c} double" for c in cols))
    scans = []
    whole, held = clean.moments, clean._materialise
    monkeypatch.setattr(clean, "moments", lambda rows, n, upto=None: (scans.append(1) if upto is None else None, whole(rows, n, upto))[1])
    monkeypatch.setattr(clean, "_materialise", lambda rows, how: (scans.append(1), held(rows, how))[1])
    fast = clean.sequential_bounds(df, cols)
    assert len(scans) == 3
    assert all(near(a["lo"], b["lo"]) for a, b in zip(fast, clean.stepwise_bounds(df, cols, materialise="cache")))


def test_empty_and_tiny(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    for d in (df, df.limit(0)):
        assert [s["applied"] for s in clean.sequential_bounds(d, ["a", "b"])] == [False, False]
        assert clean.outlier_filter_sequential(d, ["a", "b"]).count() == d.count()
    assert clean.sequential_bounds(df, []) == []
