"""Operators over ordered rows per key that do not need a key in one task.

Rows of a key are cut into time ranges of about equal numbers of rows (over all keys), so a key with a third of the
table becomes as many groups as a third of the ranges. Windows run within (key, range); what crosses a border
is carried by a small table with one row per (key, range):

* :func:`asof_join`: for every left row the latest right row of its key at or before its time. Both sides are united, the
  last right row is carried along within a range, and the first rows of a range take what the ranges before it ended with. No
  row is multiplied.
* :func:`sessions`: rows of a key whose distance is at most ``gap`` belong together. Islands are numbered within a range, and
  the last time of the range before says whether its first island goes on.

Cases: rows with a NULL key or time match nothing and are in no session (left rows of the join stay, without a match).
Ties on the right go to the row with the greatest payload (in the order of its columns); equal left rows each stay.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS = 1_000_000


def borders(times: DataFrame, rows_per_range: int = RANGE_ROWS) -> list[int]:
    """Ascending borders of the ranges: about one for ``rows_per_range`` rows of ``times`` (one long column ``t``)."""
    n = times.where("t IS NOT NULL").count()
    ranges = -(-n // rows_per_range)
    if ranges < 2:
        return []
    points = [i / ranges for i in range(1, ranges)]
    return sorted(set(times.select(F.percentile_approx("t", points, max(10_000, 20 * ranges))).first()[0] or []))


def range_of(t: Column, cuts: Sequence[int]) -> Column:
    """Number of the range: how many borders are at or below ``t``, looked up in two steps of about the square root of their number."""
    if not cuts:
        return F.lit(0)
    wide = max(1, math.isqrt(len(cuts)))
    groups = F.lit([[int(c) for c in cuts[i:i + wide]] for i in range(0, len(cuts), wide)])
    heads = F.lit([int(cuts[min(i + wide, len(cuts)) - 1]) for i in range(0, len(cuts), wide)])
    full = F.size(F.filter(heads, lambda c: c <= t))
    within = F.size(F.filter(F.coalesce(F.get(groups, full), F.array().cast("array<bigint>")), lambda c: c <= t))
    return F.least(full * wide + within, F.lit(len(cuts)))


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, payload: Sequence[str],
              rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """``left`` with the ``payload`` columns of the latest row of ``right`` with the same ``key`` and a time at or before
    ``left_time``; NULL where there is none. Times are longs (or cast to them by the caller)."""
    carried = F.struct(F.col(right_time).alias("_t"), *[F.col(c) for c in payload])
    known = F.col(key).isNotNull() & F.col(left_time).isNotNull()
    a = left.where(known).select(F.col(key).alias("_k"), F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.struct("*").alias("_row"))
    b = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(right_time).alias("_at"), F.lit(0).alias("_side"), carried.alias("_seen"))
    both = a.unionByName(b, allowMissingColumns=True)
    cuts = borders(both.select(F.col("_at").alias("t")), rows_per_range)
    both = both.withColumn("_range", range_of(F.col("_at"), cuts))
    # right rows come first at their time, ties by payload
    w = Window.partitionBy("_k", "_range").orderBy("_at", "_side", "_seen").rowsBetween(Window.unboundedPreceding, 0)
    here = both.withColumn("_seen", F.last("_seen", ignorenulls=True).over(w)).where("_side = 1")
    if cuts:
        # what each (key, range) ends with, and what all ranges before it ended with
        ends = b.withColumn("_range", range_of(F.col("_at"), cuts)).groupBy("_k", "_range").agg(F.max("_seen").alias("_end"))
        asked = here.where("_seen IS NULL").select("_k", "_range").distinct()
        steps = ends.unionByName(asked, allowMissingColumns=True).groupBy("_k", "_range").agg(F.max("_end").alias("_end"))
        before = F.last("_end", ignorenulls=True).over(
            Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        come = steps.select("_k", "_range", before.alias("_come"))
        here = here.join(come, ["_k", "_range"], "left").withColumn("_seen", F.coalesce("_seen", "_come"))
    matched = here.select("_row.*", *[F.col("_seen")[c].alias(c) for c in payload])
    return matched.unionByName(left.where(~known), allowMissingColumns=True)


def sessions(events: DataFrame, key: str, time: str, gap: int, rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """``events`` with ``session`` (1, 2, ... per key): a row begins a session if it is more than ``gap`` after the one before."""
    rows = events.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    cuts = borders(rows.select(F.col(time).cast("long").alias("t")), rows_per_range)
    rows = rows.withColumn("_range", range_of(F.col(time), cuts))
    w = Window.partitionBy(key, "_range").orderBy(time)
    starts = (F.col(time) - F.lag(time).over(w) > gap).cast("int")       # NULL for the first row of a range
    local = F.coalesce(F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)), F.lit(0))
    rows = rows.withColumn("_new", starts).withColumn("_local", local)
    edge = rows.groupBy(key, "_range").agg(F.min(time).alias("first"), F.max(time).alias("last"), F.max("_local").alias("more"))
    along = Window.partitionBy(key).orderBy("_range")
    fresh = F.coalesce((F.col("first") - F.lag("last").over(along) > gap).cast("int"), F.lit(1))
    edge = edge.withColumn("fresh", fresh)
    base = F.sum(F.col("fresh") + F.col("more")).over(along) - F.col("more")
    edge = edge.select(key, "_range", base.alias("_base"))
    out = rows.join(edge, [key, "_range"])
    return out.withColumn("session", (F.col("_base") + F.col("_local")).cast("long")).drop("_range", "_new", "_local", "_base")


def session_profile(events: DataFrame, key: str, time: str, gap: int, value: str | None = None,
                    rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """One row per session: key, session, started, ended, n and the sum of ``value``."""
    found = sessions(events, key, time, gap, rows_per_range)
    more = [] if value is None else [F.sum(value).alias("total")]
    return found.groupBy(key, "session").agg(F.min(time).alias("started"), F.max(time).alias("ended"), F.count("*").alias("n"), *more)
