"""Column profiles as tables.

One aggregate computes count, NULL count, mean and sample standard deviation
for every requested column at once (partial aggregation on the map side, one
tiny shuffle), instead of one job per column. The one-row result is turned
into a long table ``(feature, ordinal, n, n_null, mean, sd, lo, hi)`` inside
the same plan with ``stack``; nothing goes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_missing(c: str) -> Column:
    """The column with NaN treated as missing (NULL)."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _stat_exprs(cols: Sequence[str], nan_as_null: bool) -> list[Column]:
    exprs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        v = as_missing(c) if nan_as_null else F.col(c).cast("double")
        exprs += [
            F.count(v).alias(f"__n{i}"),
            F.avg(v).alias(f"__m{i}"),
            F.stddev_samp(v).alias(f"__s{i}"),
        ]
    return exprs


def profile(df: DataFrame, cols: Sequence[str], k: float = 3.0, nan_as_null: bool = True) -> DataFrame:
    """Long statistics table, one row per column, in one pass over ``df``.

    ``lo``/``hi`` are ``mean -/+ k*sd``; both are NULL when sd is NULL (fewer
    than two values) or 0, i.e. when a range filter would skip the column.
    """
    if not cols:
        raise ValueError("profile needs at least one column")
    one = df.agg(*_stat_exprs(cols, nan_as_null))
    per_column = [
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ordinal"), F.col(f"__n{i}").alias("n"),
                 F.col(f"__m{i}").alias("mean"), F.col(f"__s{i}").alias("sd"))
        for i, c in enumerate(cols)
    ]
    stacked = one.select(F.col("__rows").alias("rows"), F.inline(F.array(*per_column)))
    usable = F.col("sd").isNotNull() & (F.col("sd") != 0)
    return stacked.select(
        "feature", "ordinal",
        F.col("n").cast("bigint").alias("n"),
        (F.col("rows") - F.col("n")).cast("bigint").alias("n_null"),
        "mean", "sd",
        F.when(usable, F.col("mean") - F.lit(k) * F.col("sd")).alias("lo"),
        F.when(usable, F.col("mean") + F.lit(k) * F.col("sd")).alias("hi"),
    )


def null_counts(df: DataFrame, cols: Sequence[str], nan_as_null: bool = True) -> DataFrame:
    """``(feature, n_null)`` for every column, one pass; NaN counts as missing, as in :func:`profile`."""
    def missing(c: str) -> Column:
        numeric = df.schema[c].dataType.typeName() in ("double", "float")
        return (as_missing(c) if nan_as_null and numeric else F.col(c)).isNull()
    one = df.agg(*[F.count_if(missing(c)).alias(f"__z{i}") for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"__z{i}").alias("n_null")) for i, c in enumerate(cols)])))


def outlier_bounds(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """``(feature, mean, sd, lo, hi)``: the k-sigma bounds of every column,
    all computed over the same rows (the all-at-once variant)."""
    return profile(df, cols, k=k).select("feature", "ordinal", "mean", "sd", "lo", "hi")


def means_row(df: DataFrame, cols: Sequence[str], nan_as_null: bool = True) -> dict[str, float | None]:
    """Mean of every column from one aggregate (one value per column)."""
    row = df.agg(*[F.avg(as_missing(c) if nan_as_null else F.col(c)).alias(f"__m{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: row[f"__m{i}"] for i, c in enumerate(cols)}


def stats_row(df: DataFrame, cols: Sequence[str], nan_as_null: bool = True) -> dict[str, tuple]:
    """(mean, sd, n) per column from one aggregate, fetched as one row.

    The row holds three numbers per column, so its size is bounded by the
    width of the table, never by its length.
    """
    row = df.agg(*_stat_exprs(cols, nan_as_null)).first()
    return {c: (row[f"__m{i}"], row[f"__s{i}"], row[f"__n{i}"]) for i, c in enumerate(cols)}
