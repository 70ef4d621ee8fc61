r"""URL filters as a temporal list join.

Filter lists change: an entry is added on one day, withdrawn on another, and
perhaps added again. Dated list events become validity intervals
(``[valid_from, valid_to)``), and every capture is judged by the entries that
were active when it was fetched, not by today's list.

* :func:`validity_intervals` turns (list_key, category, action, at) events into
  intervals with ``lead`` over each key's own events.
* :func:`capture_keys` lists the keys by which a URL can be listed: its host,
  the host's parent domains, and the host with its leading path segments (for the
  lengths that the list has for this host, so a deep URL costs no more than its host's entries).
* :func:`judge` joins both on the key and keeps the intervals that hold the
  fetch time. Intervals are few per key and captures may be many (a third of
  them may share a host), so captures are salted and the intervals are repeated
  once per salt; no key is then bound to one task.

Cases: a null or unparsable URL has no key and is allowed with ``n_active`` 0;
so is a capture without fetch time. Two events of a key and category at the same moment
count as one, ``remove`` before ``add``: a removal wins. Entries of one key that are listed on one day in several categories
decide for blocking, even if one of them is ``allow``; of the blocking ones the last name in alphabetical order is reported. A second ``add`` of a
running entry starts a new interval that adjoins it. An open entry has a null ``valid_to``. Repeated
capture rows are judged as one row per distinct (id, URL, time). Empty lists
allow everything; an empty capture table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16
PATH_DEPTH = 2
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host, '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def path_segments(url: Column) -> Column:
    return F.filter(F.split(F.coalesce(F.regexp_extract(url, PATH, 1), F.lit("")), "/"), lambda x: x != "")


def capture_keys(url: Column, path_depth: int = PATH_DEPTH, depths: Column | None = None) -> Column:
    """Array of the keys that can list ``url``: every suffix of the host with at
    least two labels, and the host followed by 1..path_depth path segments (or by each number of segments in ``depths``)."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, n), "."))
    segments = path_segments(url)
    counts = F.sequence(F.lit(1), F.lit(path_depth)) if depths is None else depths
    paths = F.transform(F.filter(counts, lambda i: i <= F.size(segments)),
                        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")))
    return F.when(host != "", F.array_distinct(F.concat(suffixes, paths))).otherwise(F.array().cast("array<string>"))


def validity_intervals(events: DataFrame) -> DataFrame:
    """(list_key, category, action, valid_from, valid_to) for each listing period.

    ``events`` has list_key, category, action ('add' or 'remove') and at. The
    window is over one key's events of a category.
    """
    one = (events.where(F.col("list_key").isNotNull() & F.col("at").isNotNull())
                 .groupBy("list_key", "category", "at").agg(F.max("action").alias("action")))
    following = F.lead("at").over(Window.partitionBy("list_key", "category").orderBy("at"))
    return (one.withColumn("valid_to", following).where("action = 'add'")
               .select("list_key", "category", F.col("at").alias("valid_from"), "valid_to"))


def judge(captures: DataFrame, intervals: DataFrame, id_col: str = "page_id", url_col: str = "url",
          time_col: str = "fetched_at", salts: int = SALTS) -> DataFrame:
    """(id, url, fetched_at, n_active, blocked, list_key, category, listed_since) per capture.

    The deciding entry is the most specific active one (longest key), then the
    latest listed, then a blocking category before 'allow', then the last category; 'allow' lets the capture pass.
    """
    cap = captures.select(F.col(id_col).alias("cid"), F.col(url_col).alias("curl"),
                          F.col(time_col).alias("fetched")).distinct()
    cap = cap.withColumn("salt", F.pmod(F.xxhash64("cid", "curl"), F.lit(salts)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    # the numbers of path segments that the list has for a host
    parts = F.split("list_key", "/")
    listed = (intervals.select(parts[0].alias("host"), (F.size(parts) - 1).alias("deep")).where("deep > 0")
                       .groupBy("host").agg(F.sort_array(F.collect_set("deep")).alias("depths")).select("*", every))
    keyed = (cap.withColumn("host", host_of(F.col("curl"))).join(listed, ["host", "salt"], "left")
                .withColumn("list_key", F.explode_outer(capture_keys(
                    F.col("curl"), depths=F.coalesce("depths", F.array().cast("array<int>"))))).drop("depths", "host"))
    spread = intervals.select("*", every)
    joined = keyed.join(spread, ["list_key", "salt"], "left")
    active = (F.col("valid_from") <= F.col("fetched")) & (
        F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    order = F.struct(F.length("list_key").alias("n"), F.col("valid_from"),
                     F.col("list_key"), (F.col("category") != "allow").alias("blocks"), F.col("category"))
    best = (joined.withColumn("on", F.coalesce(active, F.lit(False)))
                  .groupBy("cid", "curl", "fetched")
                  .agg(F.sum(F.col("on").cast("long")).alias("n_active"),
                       F.max(F.when(F.col("on"), order)).alias("top")))
    return best.select(
        F.col("cid").alias(id_col), F.col("curl").alias(url_col), F.col("fetched").alias(time_col), "n_active",
        F.coalesce(F.col("top.category") != "allow", F.lit(False)).alias("blocked"),
        F.col("top.list_key").alias("list_key"), F.col("top.category").alias("category"),
        F.col("top.valid_from").alias("listed_since"))


# The test tables hold neither fetch dates nor filter lists. Both are derived
# from `pages`: a capture is dated by its page id, and the hosts, domains and path
# prefixes that occur make up a list whose events are dated by their digest.
LIST_DEPTH = 3
DAY0 = "2023-01-01"


def _digest(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("long")


def _day(n: Column) -> Column:
    return F.date_add(F.lit(DAY0).cast("date"), n.cast("int"))


def derived_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date within two years of DAY0."""
    return pages.select("page_id", "url", _day(F.pmod(F.col("page_id") * 7919, F.lit(730))).alias("fetched_at"))


def derived_events(pages: DataFrame) -> DataFrame:
    """Dated list events for the hosts, domains and path prefixes of the pages."""
    keys = (pages.select(F.explode(capture_keys(F.col("url"), LIST_DEPTH)).alias("list_key")).distinct()
                 .withColumn("m", _digest(F.col("list_key")))
                 .where(F.col("m") % 3 == 0))
    category = F.element_at(F.array(*[F.lit(c) for c in ("adult", "allow", "malware", "phishing", "spam")]),
                            (F.col("m") % 5 + 1).cast("int"))
    add = F.col("m") % 500
    gone = add + 20 + F.col("m") % 150
    back = gone + 10 + F.col("m") % 90

    def event(action: str, day: Column, name: Column = category) -> Column:
        return F.struct(name.alias("category"), F.lit(action).alias("action"), _day(day).alias("at"))

    no_event = F.lit(None).cast("struct<category:string,action:string,at:date>")
    events = F.array(event("add", add),
                     F.when(F.col("m") % 4 != 0, event("remove", gone)).otherwise(no_event),
                     F.when(F.col("m") % 7 < 3, event("add", back)).otherwise(no_event),
                     # some keys are also allowed from the same day on
                     F.when(F.col("m") % 4 == 2, event("add", add, F.lit("allow"))).otherwise(no_event))
    return keys.select("list_key", F.explode(events).alias("e")).where("e IS NOT NULL").select("list_key", "e.*")


def judge_sql() -> str:
    keys = """
      SELECT page_id, url, fetched, unnest(list_distinct(list_concat(
        CASE WHEN host <> '' THEN list_transform(range(1, greatest(len(labels), 2)),
             lambda i: array_to_string(labels[i:], '.')) ELSE [] END,
        CASE WHEN host <> '' THEN list_transform(range(1, least(len(segs), {depth}) + 1),
             lambda i: host || '/' || array_to_string(segs[1:i], '/')) ELSE [] END))) AS list_key
      FROM (SELECT page_id, url, fetched, host, string_split(host, '.') AS labels,
              list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
                          lambda x: x <> '') AS segs
            FROM cap)"""
    return f"""
WITH cap AS (
  SELECT page_id, url, DATE '{DAY0}' + CAST((page_id * 7919) % 730 AS INTEGER) AS fetched,
         coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host
  FROM pages),
listed AS (SELECT DISTINCT list_key FROM ({keys.format(depth=LIST_DEPTH)})),
m AS (SELECT list_key, CAST('0x' || substr(md5(list_key), 1, 6) AS BIGINT) AS m FROM listed),
e0 AS (SELECT list_key, m, ['adult', 'allow', 'malware', 'phishing', 'spam'][CAST(m % 5 + 1 AS INTEGER)] AS category,
              m % 500 AS a, m % 500 + 20 + m % 150 AS g FROM m WHERE m % 3 = 0),
ev AS (SELECT list_key, category, 'add' AS action, DATE '{DAY0}' + CAST(a AS INTEGER) AS moment FROM e0
       UNION ALL SELECT list_key, category, 'remove', DATE '{DAY0}' + CAST(g AS INTEGER) FROM e0 WHERE m % 4 <> 0
       UNION ALL SELECT list_key, category, 'add', DATE '{DAY0}' + CAST(g + 10 + m % 90 AS INTEGER) FROM e0 WHERE m % 7 < 3
       UNION ALL SELECT list_key, 'allow', 'add', DATE '{DAY0}' + CAST(a AS INTEGER) FROM e0 WHERE m % 4 = 2),
iv AS (SELECT * FROM (SELECT list_key, category, action, moment,
              lead(moment) OVER (PARTITION BY list_key, category ORDER BY moment) AS until
              FROM (SELECT list_key, category, moment, max(action) AS action FROM ev GROUP BY ALL)) WHERE action = 'add'),
k AS ({keys.format(depth=1_000_000)}),
hit AS (SELECT k.page_id, k.url, k.fetched, k.list_key, iv.category, iv.moment,
               row_number() OVER (PARTITION BY k.page_id, k.url, k.fetched
                 ORDER BY length(k.list_key) DESC, iv.moment DESC, k.list_key DESC, iv.category <> 'allow' DESC, iv.category DESC) AS rk,
               count(*) OVER (PARTITION BY k.page_id, k.url, k.fetched) AS n
        FROM k JOIN iv ON k.list_key = iv.list_key AND iv.moment <= k.fetched AND (iv.until IS NULL OR k.fetched < iv.until))
SELECT c.page_id, c.url, CAST(c.fetched AS VARCHAR) AS fetched_at, coalesce(h.n, 0) AS n_active,
       coalesce(h.category <> 'allow', FALSE) AS blocked, h.list_key, h.category, CAST(h.moment AS VARCHAR) AS listed_since
FROM (SELECT DISTINCT page_id, url, fetched FROM cap) c
LEFT JOIN hit h ON h.rk = 1 AND h.page_id IS NOT DISTINCT FROM c.page_id AND h.url IS NOT DISTINCT FROM c.url"""
