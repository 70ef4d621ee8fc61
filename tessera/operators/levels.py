"""Aggregates over several grouping sets in one scan.

Spark expands every row once per set and combines partial sums before the shuffle, so the shuffle holds one row per group and task. ``level`` is the
``grouping_id``: bit i (from the last column) is 1 where column i is summed over, which tells such a NULL from a NULL in the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_sets(cols: Sequence[str]) -> list[list[str]]:
    """All columns, then without the last, and so on to the total."""
    return [list(cols[:n]) for n in range(len(cols), -1, -1)]


def cube_sets(cols: Sequence[str]) -> list[list[str]]:
    """All subsets of the columns."""
    return [list(s) for n in range(len(cols), -1, -1) for s in combinations(cols, n)]


def aggregate_levels(df: DataFrame, cols: Sequence[str], sets: Sequence[Sequence[str]], aggs: Sequence[Column]) -> DataFrame:
    """cols..., level, aggregates: one row per group of every set."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(
        F.grouping_id(*cols).cast("long").alias("level"), *aggs)
