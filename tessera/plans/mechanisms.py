"""Queries over time, order and sketches, with their DuckDB SQL.

They use mechanisms that the classifier programs do not need: an as-of join, sessions, event time with late rows, exact quantiles and top rows
without a sort, and stored sketches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import difference, levels, selection, sketches, timeline
from tessera.session import shared_dir
from tessera.sources import ledger, variants
from tessera.sources.tables import table
from tessera.streaming import event_time

GAP_US = 6 * 3600 * 1_000_000
DAY0 = "1992-01-01"
QS = (0.001, 0.25, 0.5, 0.9, 1.0)
QUANTILE_COLS = ("l_quantity", "l_extendedprice", "l_discount")
TOP = 100
BATCHES, FILES = 6, 4


def _events_on_days(spark: SparkSession, sf: str) -> DataFrame:
    """Events dated over the years of the orders (stand-in: the two tables share no period)."""
    return table(spark, sf, "events").select("event_id", F.col("user_id").alias("custkey"),
                                             F.pmod(F.col("event_id") * 37, F.lit(2400)).alias("day"))


def asof_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with the customer's latest order at its day."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"), F.datediff("o_orderdate", F.lit(DAY0).cast("date")).cast("long").alias("o_day"),
        "o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    out = timeline.asof_join(_events_on_days(spark, sf), orders, "custkey", "day", "o_day", ["o_orderkey", "o_day", "price"])
    return out.select("event_id", "custkey", "day", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("o_orderkey", "o_day", "price")])


ASOF_SQL = f"""
WITH l AS (SELECT event_id, user_id AS custkey, (event_id * 37) % 2400 AS day FROM events),
r AS (SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) - DATE '{DAY0}' AS o_day, max(o_orderkey) AS o_orderkey,
             arg_max(CAST(o_totalprice AS DOUBLE), o_orderkey) AS price FROM orders GROUP BY 1, 2)
SELECT l.event_id, l.custkey, l.day, coalesce(r.o_orderkey, -1) AS o_orderkey, CAST(coalesce(r.o_day, -1) AS BIGINT) AS o_day,
       coalesce(r.price, -1.0) AS price
FROM l ASOF LEFT JOIN r ON l.custkey = r.custkey AND l.day >= r.o_day"""


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of a user's events: a gap of more than six hours begins a new one."""
    events = _timed(spark, sf).withColumn("us", F.unix_micros("ts"))
    out = timeline.session_profile(events, "user_id", "us", GAP_US, "value")
    return out.withColumn("total", F.round("total", 4))


SESSIONS_SQL = f"""
WITH e AS (SELECT user_id, epoch_us(ts) AS us, value FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
s AS (SELECT *, CASE WHEN us - lag(us) OVER w > {GAP_US} THEN 1 ELSE 0 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us)),
n AS (SELECT *, CAST(1 + sum(fresh) OVER (PARTITION BY user_id ORDER BY us) AS BIGINT) AS session FROM s)
SELECT user_id, session, min(us) AS started, max(us) AS ended, count(*) AS n, round(sum(value), 4) AS total FROM n GROUP BY 1, 2"""


def streaming_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Daily windows per event type over a replayed stream in which some rows come one or three batches late."""
    events = _timed(spark, sf).select("event_id", "ts", "event_type", "value")
    batch = F.floor((F.dayofmonth("ts") - 1) / 5)
    late = F.when(F.col("event_id") % 13 == 0, 1).when(F.col("event_id") % 29 == 0, 3).otherwise(0)
    path = event_time.land_arrivals(events, F.least(batch + late, F.lit(BATCHES - 1)), BATCHES, FILES)
    out = event_time.replay(spark, path, events.schema, FILES, "ts", "event_type", "value", "1 day", "2 days")
    return out.select(F.unix_micros("started").alias("started"), "event_type", "n", F.round("total", 4).alias("total"), "low", "high")


# a batch is judged by the watermark that its predecessor began with: the greatest time of all batches before that one
WINDOWS_SQL = f"""
WITH e AS (SELECT event_type, value, ts, least((day(ts) - 1) // 5 + CASE WHEN event_id % 13 = 0 THEN 1 WHEN event_id % 29 = 0 THEN 3 ELSE 0 END,
                  {BATCHES - 1}) AS b FROM events),
m AS (SELECT b, max(ts) AS top FROM e GROUP BY b),
w AS (SELECT x.b, max(y.top) - INTERVAL 2 DAY AS mark FROM (SELECT DISTINCT b FROM e) x LEFT JOIN m y ON y.b <= x.b - 2 GROUP BY x.b),
k AS (SELECT e.*, date_trunc('day', ts) AS started FROM e JOIN w USING (b)
      WHERE mark IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > mark)
SELECT epoch_us(started) AS started, event_type, count(*) AS n, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high
FROM k GROUP BY 1, 2"""


def exact_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return selection.quantiles(table(spark, sf, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in QUANTILE_COLS]), QUANTILE_COLS, QS)


QUANTILES_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({q} AS DOUBLE) AS q, quantile_disc(CAST({c} AS DOUBLE), {q}) AS value FROM lineitem"
    for c in QUANTILE_COLS for q in QS)


def largest_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The orders of the 100 highest prices (and all that share the last of them)."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    return selection.largest(orders, "price", TOP)


LARGEST_SQL = f"""
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price FROM orders
QUALIFY rank() OVER (ORDER BY o_totalprice DESC) <= {TOP}"""


def sketch_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sketches per event type, stored, reread and merged per type and over all; checked against exact figures."""
    events = _timed(spark, sf).withColumn("day", F.to_date("ts"))
    path = shared_dir(spark, "sketches")
    sketches.summarise(events, ["day", "event_type"], "event_id", "value").write.parquet(path)
    stored = spark.read.parquet(path)
    per_type = sketches.merge(stored, ["event_type"])
    every = sketches.merge(per_type.withColumn("event_type", F.lit("all")), ["event_type"])
    guess = sketches.estimates(per_type.unionByName(every), [0.5])
    both = events.select(F.explode(F.array(F.col("event_type"), F.lit("all"))).alias("event_type"), "event_id", "value")
    median = guess.select("event_type", F.get("quantiles", F.lit(0)).alias("median"))
    exact = both.join(median, "event_type").groupBy("event_type").agg(
        F.count_distinct("event_id").alias("n_exact"), F.count_if(F.col("value") < F.col("median")).alias("below"),
        F.count_if(F.col("value") <= F.col("median")).alias("upto"), F.count("value").alias("held"))
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= sketches.DISTINCT_ERROR * F.col("n_exact")
    slack = sketches.RANK_ERROR * F.col("held")
    middle = (F.col("below") <= 0.5 * F.col("held") + slack) & (F.col("upto") >= 0.5 * F.col("held") - slack)
    return guess.join(exact, "event_type").select("event_type", "n", "n_exact", near.alias("distinct_ok"), middle.alias("median_ok"))


SKETCH_SQL = """
SELECT coalesce(event_type, 'all') AS event_type, count(*) AS n, count(DISTINCT event_id) AS n_exact, TRUE AS distinct_ok, TRUE AS median_ok
FROM events GROUP BY GROUPING SETS ((event_type), ())"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "asof_orders": asof_orders, "event_sessions": event_sessions, "streaming_windows": streaming_windows,
    "exact_quantiles": exact_quantiles, "largest_orders": largest_orders, "sketch_levels": sketch_levels,
}
SQL: dict[str, str] = {
    "asof_orders": ASOF_SQL, "event_sessions": SESSIONS_SQL, "streaming_windows": WINDOWS_SQL,
    "exact_quantiles": QUANTILES_SQL, "largest_orders": LARGEST_SQL, "sketch_levels": SKETCH_SQL,
}


# ---------------------------------------------------------------- levels, differences, variants

def lineitem_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of lineitem over all subsets of three columns, with a NULL of its own in one of them."""
    items = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.when(F.col("l_linenumber") < 6, F.col("l_linenumber")).cast("long").alias("line"),
        F.col("l_quantity").cast("double").alias("qty"))
    cols = ["l_returnflag", "l_linestatus", "line"]
    out = levels.aggregate_levels(items, cols, levels.cube_sets(cols), [F.count("*").alias("n"), F.sum("qty").alias("qty")])
    return out.withColumns({"l_returnflag": F.coalesce("l_returnflag", F.lit("-")), "l_linestatus": F.coalesce("l_linestatus", F.lit("-")),
                            "line": F.coalesce("line", F.lit(-1))})


CUBE_SQL = """
WITH i AS (SELECT l_returnflag, l_linestatus, CASE WHEN l_linenumber < 6 THEN l_linenumber END AS line, CAST(l_quantity AS DOUBLE) AS qty FROM lineitem)
SELECT coalesce(l_returnflag, '-') AS l_returnflag, coalesce(l_linestatus, '-') AS l_linestatus, CAST(coalesce(line, -1) AS BIGINT) AS line,
       CAST(GROUPING_ID(l_returnflag, l_linestatus, line) AS BIGINT) AS level, count(*) AS n, sum(qty) AS qty
FROM i GROUP BY CUBE (l_returnflag, l_linestatus, line)"""


def _edited_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and a later state of them: lost, repeated, changed and emptied rows (stand-in for a second delivery)."""
    old = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"))
    k = F.col("o_orderkey")
    new = old.where(k % 97 != 0).withColumn("price", F.when(k % 101 == 0, F.col("price") + 1).otherwise(F.col("price")))
    new = new.withColumn("o_orderstatus", F.when(k % 107 != 0, F.col("o_orderstatus")))
    twice = new.where(k % 103 == 0)
    return old, new.unionByName(twice).unionByName(twice.withColumn("o_orderkey", -k))


def orders_difference(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _edited_orders(spark, sf)
    return difference.difference(old, new, ["o_orderkey"]).withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.lit("none")))


DIFFERENCE_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS price FROM orders),
e AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 107 <> 0 THEN o_orderstatus END AS o_orderstatus,
             CASE WHEN o_orderkey % 101 = 0 THEN price + 1 ELSE price END AS price FROM o WHERE o_orderkey % 97 <> 0),
w AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE o_orderkey % 103 = 0
      UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, price FROM e WHERE o_orderkey % 103 = 0),
d AS (SELECT 'removed' AS change, * FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM w)
      UNION ALL SELECT 'added', * FROM (SELECT * FROM w EXCEPT ALL SELECT * FROM o)),
c AS (SELECT o_orderkey FROM d GROUP BY 1 HAVING count(DISTINCT change) = 2)
SELECT CASE WHEN o_orderkey NOT IN (FROM c) THEN change WHEN change = 'removed' THEN 'changed_from' ELSE 'changed_to' END AS change,
       count(*) AS n, o_orderkey, o_custkey, coalesce(o_orderstatus, 'none') AS o_orderstatus, price FROM d GROUP BY ALL"""


def variant_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON text with broken rows and fields of varying type, read back by path."""
    events = table(spark, sf, "events")
    e = F.col("event_id")
    body = F.to_json(F.struct("event_type", "value", F.from_json("props", "k long").alias("props"),
                              F.transform(F.sequence(F.lit(0), F.pmod(e, F.lit(3)).cast("int")), lambda i: e + i).alias("tags")))
    body = F.when(e % 17 == 0, F.substring(body, 1, 20)).when(e % 19 == 0, F.lit('{"event_type": 5, "value": "none"}')).otherwise(body)
    rows = variants.parse(events.select("event_id", body.alias("body")), "body")
    rows = variants.fields(rows, {"kind": ("$.event_type", "string"), "value": ("$.value", "double"), "k": ("$.props.k", "long")})
    tags = variants.explode_list(rows, ["event_id"], "$.tags", "long").groupBy("event_id").agg(
        F.count("*").alias("n_tags"), F.sum("item").alias("tag_sum"))
    out = rows.join(tags, "event_id", "left")
    return out.select("event_id", F.col("v_bad").alias("bad"), F.coalesce("kind", F.lit("none")).alias("kind"), F.coalesce("value", F.lit(-1.0)).alias("value"),
                      *[F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("k", "n_tags", "tag_sum")])


VARIANT_SQL = """
WITH e AS (SELECT *, event_id % 17 = 0 AS bad, event_id % 17 <> 0 AND event_id % 19 = 0 AS odd, event_id % 3 + 1 AS m FROM events)
SELECT event_id, bad, CASE WHEN bad THEN 'none' WHEN odd THEN '5' ELSE event_type END AS kind,
       CASE WHEN bad OR odd THEN -1.0 ELSE value END AS value,
       CASE WHEN bad OR odd THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN bad OR odd THEN -1 ELSE CAST(m AS BIGINT) END AS n_tags,
       CASE WHEN bad OR odd THEN -1 ELSE CAST(event_id * m + m * (m - 1) // 2 AS BIGINT) END AS tag_sum FROM e"""

def ledger_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written to a ledger in two commits, sorted into parts by key, and read back for a range of keys."""
    ledger.register(spark)
    path = shared_dir(spark, "ledger")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("price"))
    for even in (0, 1):
        part = orders.where(F.col("o_orderkey") % 2 == even).repartitionByRange("o_orderkey")
        part.write.format("ledger").option("path", path).mode("append").save()
    back = spark.read.format("ledger").option("path", path).load()
    return back.where("o_orderkey > 1000 AND o_orderkey <= 9000").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("price"), 2).alias("price"))


LEDGER_SQL = """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(CAST(o_totalprice AS DOUBLE)), 2) AS price
FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= 9000 GROUP BY 1"""

QUERIES |= {"ledger_orders": ledger_orders, "lineitem_cube": lineitem_cube, "orders_difference": orders_difference, "variant_events": variant_events}
SQL |= {"ledger_orders": LEDGER_SQL, "lineitem_cube": CUBE_SQL, "orders_difference": DIFFERENCE_SQL, "variant_events": VARIANT_SQL}
