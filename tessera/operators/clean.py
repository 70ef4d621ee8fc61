"""Data-quality operators: mean imputation and k-sigma row filters.

Imputation: the mean of every column is independent of the others, so one
aggregate over all columns replaces one job per column; the means enter the
plan as literals in a single projection (``coalesce(col, mean)``), which keeps
the whole step inside one codegen stage.

Sequential filter: column j's bounds are computed over the rows that survived
columns 1..j-1. Done as written that is one job per column
(:func:`stepwise_bounds`). :func:`sequential_bounds` needs few passes:

1. one aggregate gives mean and deviation of every column over all rows;
2. two scans split the rows. Those inside a range somewhat narrower than mean +/- k*sd in every
   column are summed up as centred moments (count, mean, sum of squares); the others, the
   suspects, are written to a table of their own;
3. the steps of all columns are settled together on the suspects. Under guessed bounds every suspect has a first column that
   drops it, so one aggregate gives the moments of every column's survivors, merged with
   those of step 2. These give better bounds, until they stay. Column 1 is right after the first round, and each round makes at least
   one more column right;
4. the result is proven if every column's range of step 2 lies inside its bounds, since then no row but a
   suspect can be dropped. Else step 2 is done again around the bounds found, with a narrower range.

Moments are merged, never subtracted, so an extreme value that is dropped early leaves no
rounding error behind.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.layout import cache_sized
from tessera.operators.profile import as_missing, means_row, stats_row
from tessera.session import remove_dir, shared_dir
from tessera.sources.csv import land_as_parquet


def fit_means(df: DataFrame, cols: Sequence[str], nan_as_null: bool = True) -> dict[str, float | None]:
    """Mean of every column over its non-missing values (one aggregate)."""
    return means_row(df, cols, nan_as_null=nan_as_null)


def apply_means(df: DataFrame, means: dict[str, float | None], nan_as_null: bool = True) -> DataFrame:
    """Replace missing values by the given means; a column whose mean is
    None (all values missing) is left as it is."""
    fills = {}
    for c, m in means.items():
        if m is None:
            continue
        v = as_missing(c) if nan_as_null else F.col(c)
        fills[c] = F.coalesce(v, F.lit(float(m)))
    return df.withColumns(fills) if fills else df


def impute_mean(df: DataFrame, cols: Sequence[str], nan_as_null: bool = True, fit_where=None) -> DataFrame:
    """Mean imputation; with ``fit_where`` (a boolean Column, e.g. the
    training split) the means come from those rows only and are applied to
    all rows, so no test row informs the statistics."""
    fit_rows = df.where(fit_where) if fit_where is not None else df
    return apply_means(df, fit_means(fit_rows, cols, nan_as_null), nan_as_null)


def bounds_predicate(bounds: dict[str, tuple[float, float]]):
    """Conjunction of closed ranges ``lo <= col <= hi`` (NULL fails)."""
    pred = F.lit(True)
    for c, (lo, hi) in bounds.items():
        pred = pred & (F.col(c) >= F.lit(lo)) & (F.col(c) <= F.lit(hi))
    return pred


def range_filter(df: DataFrame, bounds: DataFrame | dict[str, tuple[float, float]]) -> DataFrame:
    """Keep rows inside every ``[lo, hi]`` of a bounds table ``(feature, lo, hi)``
    (as produced by :func:`~tessera.operators.profile.outlier_bounds`); rows
    with NULL lo/hi are skipped columns. The bounds table has one row per
    column, so fetching it is bounded by the table's width."""
    if isinstance(bounds, DataFrame):
        rows = bounds.where(F.col("lo").isNotNull() & F.col("hi").isNotNull()).select("feature", "lo", "hi").collect()
        bounds = {r["feature"]: (r["lo"], r["hi"]) for r in rows}
    return df.where(bounds_predicate(bounds))


def _materialise(df: DataFrame, how: str) -> tuple[DataFrame, Callable]:
    if how == "cache":
        held = cache_sized(df)
        return held, held.unpersist
    if how == "parquet":
        path = shared_dir(df.sparkSession, "seqfilter")
        return land_as_parquet(df, path), lambda: remove_dir(df.sparkSession, path)
    if how == "none":
        return df, (lambda: None)
    raise ValueError(f"unknown materialisation {how!r}")


class Moments(NamedTuple):
    """Count, mean and sum of squared distances from the mean."""
    n: int = 0
    mean: float = 0.0
    m2: float = 0.0

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return other if other.n else self
        n, apart = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + apart * other.n / n, self.m2 + other.m2 + apart * apart * self.n * other.n / n)

    def sd(self) -> float | None:
        """Sample standard deviation; what is below the resolution of the mean is 0."""
        if self.n < 2:
            return None
        sd = math.sqrt(self.m2 / (self.n - 1))
        return 0.0 if sd <= 1e-15 * abs(self.mean) else sd


def moments(rows: DataFrame, width: int, upto: Column | None = None) -> list[Moments]:
    """Moments of every column of the arrays ``x`` (of the first ``upto`` columns of each row): one scan, one group per
    column, combined before the shuffle. The plan is the same small one for any width."""
    x = F.col("x") if upto is None else F.slice("x", F.lit(1), upto)
    got = {r.j: Moments(r.n, r.m, r.v * r.n) for r in rows.select(F.posexplode(x).alias("j", "v")).groupBy("j").agg(
        F.count("v").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("v")).collect() if r.n}
    return [got.get(j, Moments()) for j in range(width)]


def first_failing(cols: Sequence[str], ranges: dict[str, tuple[float, float]]) -> Column:
    """Number of the first column of ``x`` outside its range (missing values are), 0 if none. Ranges enter as
    arrays, so every call runs the same compiled code."""
    used = F.lit([c in ranges for c in cols])
    lo, hi = (F.lit([float(ranges.get(c, (0.0, 0.0))[side]) for c in cols]) for side in (0, 1))
    return F.array_position(F.transform("x", lambda v, i: F.get(used, i) & ~F.coalesce(
        (v >= F.get(lo, i)) & (v <= F.get(hi, i)), F.lit(False))), True)


def settle(suspects: DataFrame, base: list[Moments], cols: Sequence[str], k: float,
           guess: dict[str, tuple[float, float]]) -> list[dict]:
    """Bounds of the sequential filter if only ``suspects`` (arrays ``x`` of the columns) can be dropped; ``base`` has the
    moments of all other rows."""
    bounds = guess
    while True:
        place = first_failing(cols, bounds)
        got = moments(suspects, len(cols), F.when(place == 0, len(cols)).otherwise(place).cast("int"))   # a row is seen up to there
        steps, found = [], {}
        for j, c in enumerate(cols):
            m = base[j] + got[j]
            mean, sd = (m.mean if m.n else None), m.sd()
            applied = sd is not None and sd != 0
            if applied:
                found[c] = (mean - k * sd, mean + k * sd)
            at, upto = found.get(c, (None, None))
            steps.append({"column": c, "mean": mean, "sd": sd, "lo": at, "hi": upto, "applied": applied})
        same = found.keys() == bounds.keys() and all(
            abs(x - y) <= 1e-12 * (abs(x) + abs(y)) or x != x for c in found for x, y in zip(found[c], bounds[c]))
        if same:
            return steps
        bounds = found


def sequential_bounds(df: DataFrame, cols: Sequence[str], k: float = 3.0, nan_as_null: bool = True,
                      materialise: str = "parquet", narrow: float = 0.95, refresh_every: int | None = None) -> list[dict]:
    """Bounds of the sequential k-sigma filter, in column order, from three scans of ``df``.

    Returns one record per column: ``column, mean, sd, lo, hi, applied``.
    Column j's statistics are taken over the rows kept by columns 1..j-1;
    a column with NULL or zero sd is skipped (``applied`` False).
    Rows outside ``narrow`` times the range of a column are suspects; where that proves too wide, two more scans take
    a narrower one. ``materialise`` says how suspects are held: parquet, cache or none. With ``refresh_every``
    the columns are done one after the other, as in :func:`stepwise_bounds`.
    """
    if refresh_every is not None:
        return stepwise_bounds(df, cols, k, nan_as_null, materialise, refresh_every)
    cols = list(cols)
    if not cols:
        return []
    rows = df.select(F.array(*[as_missing(c) if nan_as_null else F.col(c).cast("double") for c in cols]).alias("x"))
    whole = moments(rows, len(cols))
    around = {c: (m.mean, m.sd()) for c, m in zip(cols, whole) if m.sd()}
    guess = {c: (m - k * s, m + k * s) for c, (m, s) in around.items()}
    while True:
        inner = {c: (m - narrow * k * s, m + narrow * k * s) for c, (m, s) in around.items()}
        plain = first_failing(cols, inner) == 0
        base = moments(rows.where(plain), len(cols))
        suspects, release = _materialise(rows.where(~plain), materialise)
        try:
            steps = settle(suspects, base, cols, k, guess)
        finally:
            release()
        applied = [s for s in steps if s["applied"]]
        if not any(m.n for m in base) or all(s["lo"] <= inner[s["column"]][0] and inner[s["column"]][1] <= s["hi"] for s in applied):
            return steps
        narrow *= 0.85
        around |= {s["column"]: (s["mean"], s["sd"]) for s in applied}
        guess = {s["column"]: (s["lo"], s["hi"]) for s in applied}


def stepwise_bounds(df: DataFrame, cols: Sequence[str], k: float = 3.0, nan_as_null: bool = True,
                    materialise: str = "parquet", refresh_every: int = 8) -> list[dict]:
    """The same bounds, one job per column: the definition as it stands.

    Returns one record per column: ``column, mean, sd, lo, hi, applied``.
    Column j's statistics are taken over the rows kept by columns 1..j-1;
    a column with NULL or zero sd is skipped (``applied`` False).

    Every ``refresh_every`` applied bounds the surviving rows of the
    still-needed columns are materialised again (and the previous copy
    released), so a step's plan carries at most that many range predicates
    and reads only the columns not yet processed plus those few filter
    columns, instead of all earlier columns.
    """
    cols = list(cols)
    base, release = _materialise(df.select(*cols), materialise)
    try:
        pending: dict[str, tuple[float, float]] = {}
        out = []
        for j, c in enumerate(cols):
            if refresh_every and len(pending) >= refresh_every and materialise != "none":
                rest = cols[j:]
                new_base, new_release = _materialise(base.where(bounds_predicate(pending)).select(*rest),
                                                     materialise)
                release()
                base, release, pending = new_base, new_release, {}
            survivors = base.where(bounds_predicate(pending)) if pending else base
            mean, sd, _ = stats_row(survivors, [c], nan_as_null)[c]
            applied = sd is not None and sd != 0
            lo = hi = None
            if applied:
                lo, hi = mean - k * sd, mean + k * sd
                pending[c] = (lo, hi)
            out.append({"column": c, "mean": mean, "sd": sd, "lo": lo, "hi": hi, "applied": applied})
        return out
    finally:
        release()


def outlier_filter_sequential(df: DataFrame, cols: Sequence[str], k: float = 3.0, nan_as_null: bool = True,
                              materialise: str = "parquet", fit_where=None) -> DataFrame:
    """Drop rows outside mean +/- k*sd, column by column, each column's
    statistics taken over the rows kept so far (order matters). With
    ``fit_where`` the bounds come from those rows only and filter all rows."""
    fit_rows = df.where(fit_where) if fit_where is not None else df
    steps = sequential_bounds(fit_rows, cols, k, nan_as_null, materialise)
    kept = {s["column"]: (s["lo"], s["hi"]) for s in steps if s["applied"]}
    return df.where(bounds_predicate(kept)) if kept else df


def clean(df: DataFrame, cols: Sequence[str], k: float = 3.0, materialise: str = "parquet",
          fit_where=None) -> DataFrame:
    """Mean imputation followed by the sequential k-sigma filter; statistics
    from all rows (the programs' behaviour) or from ``fit_where`` rows only."""
    return outlier_filter_sequential(impute_mean(df, cols, fit_where=fit_where), cols, k, materialise=materialise,
                                     fit_where=fit_where)
