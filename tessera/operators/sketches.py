"""Mergeable sketches: stored per fine group, merged over levels.

A HyperLogLog sketch estimates distinct values, a KLL sketch ranks and quantiles. Both are small binary columns, so a fine
level (say a day) is summed up once, stored as a table, and every coarser level is a merge of stored rows: the base table is
not read again, and a new day only adds rows.

* :func:`summarise` builds the rows of the fine level in one aggregate (partial sketches combine before the shuffle);
* :func:`merge` merges stored rows over a coarser grouping;
* :func:`estimates` reads count, distinct values and quantiles from the sketches.

Stated errors (used by the tests): distinct values within ``DISTINCT_ERROR`` (over three standard errors of 2**12 registers);
the true rank of a quantile within ``RANK_ERROR`` of the number of values. NULL and NaN are not counted; a group without values has no sketch and its
estimates are 0 and NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.profile import as_missing

REGISTERS_LOG2, KLL_K = 12, 400
DISTINCT_ERROR, RANK_ERROR = 0.06, 0.02


def summarise(df: DataFrame, by: Sequence[str], distinct_col: str, value_col: str) -> DataFrame:
    """by..., n, distinct_sketch, value_sketch."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.hll_sketch_agg(distinct_col, REGISTERS_LOG2).alias("distinct_sketch"),
        F.kll_sketch_agg_double(as_missing(value_col), KLL_K).alias("value_sketch"))


def merge(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same columns over a coarser grouping of stored rows."""
    return stored.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
                                   F.kll_merge_agg_double("value_sketch", KLL_K).alias("value_sketch"))


def estimates(sketches: DataFrame, qs: Sequence[float]) -> DataFrame:
    """Sketch columns replaced by ``n_distinct`` and an array ``quantiles``."""
    held = F.kll_sketch_get_n_double("value_sketch") > 0
    return sketches.withColumns({
        "n_distinct": F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)),
        "quantiles": F.when(held, F.kll_sketch_get_quantile_double("value_sketch", F.lit([float(q) for q in qs])))}).drop(
        "distinct_sketch", "value_sketch")
