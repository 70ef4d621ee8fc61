"""Exact quantiles and the largest rows without a sort, by refining histograms.

Every round counts the rows of the current value range of each (column, quantile) in ``BINS`` bins of equal width: one scan,
combined before the shuffle, of which one row per (column, quantile) comes to the driver: the bin that holds the wanted rank. A bin's own
smallest and largest value become the next range, so a round narrows it by ``BINS`` at least and the search ends as soon as
they are equal. Ties cost nothing: a value that a third of the rows share ends the search when its bin holds nothing else.

NULL and NaN are missing. A column without values has the quantile NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.profile import as_missing

BINS = 1024


def _ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float, int]]:
    row = df.agg(*[f(as_missing(c)).alias(f"{n}{i}") for i, c in enumerate(cols)
                   for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"], row[f"n{i}"]) for i, c in enumerate(cols)}


def kth_values(df: DataFrame, wanted: Sequence[tuple[str, int]], bins: int = BINS,
               ranges: dict[str, tuple[float, float, int]] | None = None) -> dict[tuple[str, int], float | None]:
    """Value of rank k (1 = smallest) of a column, for each wanted (column, k)."""
    ranges = ranges or _ranges(df, sorted({c for c, _ in wanted}))
    found: dict[tuple[str, int], float | None] = {}
    state: dict[tuple[str, int], tuple[float, float, int]] = {}     # value range, rank within it
    for c, k in wanted:
        lo, hi, n = ranges[c]
        if not n or not 1 <= k <= n:
            found[c, k] = None
        else:
            state[c, k] = (lo, hi, k)
    while state:
        for item, (lo, hi, _) in list(state.items()):
            if lo == hi:
                found[item] = lo
                del state[item]
        if not state:
            break
        items = sorted(state)
        # the same value range is counted once
        spans = sorted({(c, *state[c, k][:2]) for c, k in items})
        parts = []
        for s, (c, lo, hi) in enumerate(spans):
            v = as_missing(c)
            # halves keep the width finite for ranges as wide as the type
            width = hi / 2 - lo / 2
            bin_ = F.least(F.floor((v / 2 - lo / 2) / width * bins), F.lit(bins - 1)).cast("int")
            parts.append(F.when((v >= lo) & (v <= hi), F.struct(F.lit(s).alias("s"), bin_.alias("b"), v.alias("v"))))
        each = df.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("x")).select("x.*")
        counts = each.groupBy("s", "b").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        run = F.sum("n").over(Window.partitionBy("s").orderBy("b"))
        counts = counts.withColumn("upto", run)
        place = {span: i for i, span in enumerate(spans)}
        ranks = df.sparkSession.createDataFrame(
            [(i, place[c, state[c, k][0], state[c, k][1]], state[c, k][2]) for i, (c, k) in enumerate(items)], "i int, s int, k long")
        hit = counts.join(F.broadcast(ranks), "s").where("upto >= k AND upto - n < k")     # one row per wanted rank
        for r in hit.select("i", "lo", "hi", (F.col("k") - F.col("upto") + F.col("n")).alias("rank")).collect():
            state[items[r.i]] = (r.lo, r.hi, r["rank"])
    return found


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], bins: int = BINS) -> DataFrame:
    """(feature, q, value): the smallest value whose share of values at or below it reaches q."""
    ranges = _ranges(df, cols)
    rank = {(c, q): max(1, math.ceil(q * ranges[c][2])) for c in cols for q in qs}
    values = kth_values(df, sorted({(c, k) for (c, _), k in rank.items()}), bins, ranges)
    return df.sparkSession.createDataFrame([(c, float(q), values[c, rank[c, q]]) for c in cols for q in qs],
                                           "feature string, q double, value double")


def largest(df: DataFrame, col: str, k: int, bins: int = BINS) -> DataFrame:
    """The rows whose ``col`` is among the k largest values (all rows of the k-th value)."""
    ranges = _ranges(df, [col])
    n = ranges[col][2]
    if not n:
        return df.limit(0)
    rank = max(1, n - k + 1)
    return df.where(as_missing(col) >= F.lit(kth_values(df, [(col, rank)], bins, ranges)[col, rank]))
