"""Mixing sources to target weights by Sainte-Lague apportionment.

A corpus of ``T`` words is mixed to source targets in blocks of ``block``
words:

1. every source gets a target share of ``T`` by weight; a target stops at
   ``max_repeat`` times the source's size and the excess is shared out again by
   weight (closed form of the water level, one pass over the sources);
2. ``T // block`` blocks are apportioned to the sources by the highest
   quotients ``target / (2 j + 1)`` (Sainte-Lague);
3. a source's quota is whole passes over its blocks plus an extra part; the
   extra part is apportioned, again by highest quotients, to the source's
   shards (runs of ``shard_blocks`` blocks), so each shard has an integer quota;
4. within a shard the blocks of the smallest seeded hash are taken.

Documents lie on the word line of their source in the order of a seeded hash
of their id. The running sum that places them is built in two levels (hash
buckets, then rows of a bucket), so a source with a third of all rows is
never sorted in one task. Everything is DataFrame code; the text is read once,
for its word count, and never shuffled.

Cases: null text, empty text and text of white space have size 0 and are
returned with ``taken`` 0. Null sources form one source, ordered last. Repeated
rows are separate documents. An empty table gives no rows. A corpus without
words gives targets of 0. Columns other than id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.components import written

SEED = 20
BLOCK = 256
SHARD_BLOCKS = 1024
MAX_REPEAT = 3
WEIGHT_CYCLE = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Join key that keeps null apart from every string and sorts as the source does, null last."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def source_targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT, cycle: int = WEIGHT_CYCLE) -> DataFrame:
    """(skey, source_size, total, target) from (skey, size).

    The sources are ordered by code point; the i-th weighs ``i % cycle + 1``.
    The windows below run over one row per source.
    """
    per = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(1))
    per = per.select(
        "skey", "source_size",
        F.sum("source_size").over(every).alias("total"),
        ((F.row_number().over(every.orderBy("skey")) - 1) % cycle + 1).cast("long").alias("weight"),
        (F.col("source_size") * max_repeat).alias("cap"),
    )
    by_level = every.orderBy(F.col("cap") / F.col("weight"), "skey")
    capped_before = F.coalesce(
        F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    weight_left = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - capped_before) / weight_left)
    free_level = F.max(F.when(F.col("cap") / F.col("weight") > F.col("level"), F.col("level"))).over(every)
    per = per.withColumn("water", free_level)
    free = F.col("water").isNotNull() & (F.col("water") * F.col("weight") < F.col("cap"))
    return per.select(
        "skey", "source_size", "total",
        F.when(free, F.col("water") * F.col("weight")).otherwise(F.col("cap").cast("double")).alias("target"),
    )


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str) -> DataFrame:
    """Apportion ``seats`` (a column, equal within a group) to the parties of
    each group by the highest quotients votes/(2j+1); ties go to the first
    party. Adds ``quota``.

    With n parties the final divisor moves a party's exact share x by at most
    share * n / 2, so only quotients in that band are ranked; all lower j are won and
    all higher j are lost. The bands of a group hold O(n) rows, however many
    seats there are.
    """
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    v, s = F.col(votes).cast("double"), F.col(seats).cast("double")
    p = parties.withColumn("_all", F.sum(v).over(g)).withColumn("_n", F.count(F.lit(1)).over(g))
    share = F.when(F.col("_all") > 0, v / F.col("_all")).otherwise(F.lit(0.0))
    band = share * F.col("_n") / 2 + 1
    p = (p.withColumn("_lo", F.greatest(F.lit(0), F.floor(share * s - band)).cast("long"))
          .withColumn("_hi", F.ceil(share * s + band).cast("long")))
    p = p.withColumn("_sure", F.sum("_lo").over(g))
    q = p.withColumn("_j", F.explode(F.sequence("_lo", "_hi")))
    order = Window.partitionBy(*(group or [F.lit(1)])).orderBy(
        (v / (F.col("_j") * 2 + 1)).desc(), *party, "_j")
    won = (F.row_number().over(order) <= F.col(seats) - F.col("_sure")) & (v > 0)
    return (q.withColumn("_won", won.cast("long"))
             .groupBy(*parties.columns, "_lo").agg(F.sum("_won").alias("_w"))
             .select(*parties.columns, (F.col("_lo") + F.col("_w")).alias("quota")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS,
        max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per document."""
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), source_key(F.col(source_col)).alias("skey"),
    ).withColumn("h", F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    sized = written(sized, "sizes")
    targets = source_targets(sized.select("skey", "size"), max_repeat)
    quotas = sainte_lague(
        targets.withColumn("seats", F.floor(F.col("total") / block)), [], ["skey"], "target", "seats")
    n_blocks = F.ceil(F.col("source_size") / block)
    quotas = quotas.select(
        "skey", "source_size", "target", n_blocks.alias("n_blocks"),
        F.least(F.col("quota"), n_blocks * max_repeat).alias("quota"),
    ).withColumn("passes", F.when(F.col("n_blocks") > 0, F.floor(F.col("quota") / F.col("n_blocks"))).otherwise(F.lit(0))
    ).withColumn("extra", F.col("quota") - F.col("passes") * F.col("n_blocks"))
    chosen = extra_blocks(quotas, seed, shard_blocks)

    # two-level running sum: hash bucket, then row within the bucket
    sized = sized.withColumn("bucket", F.substring("h", 1, 3))
    per_bucket = sized.groupBy("skey", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = F.sum("bucket_size").over(Window.partitionBy("skey").orderBy("bucket"))
    offsets = per_bucket.select("skey", "bucket", (before - F.col("bucket_size")).alias("offset"))
    row_order = Window.partitionBy("skey", "bucket").orderBy("h", "doc_id", "size")
    placed = sized.withColumn("inner", F.sum("size").over(row_order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(offsets, ["skey", "bucket"]).select(
        "doc_id", "source", "skey", "size",
        (F.col("offset") + F.col("inner") - F.col("size")).alias("start"))
    placed = placed.join(quotas.select("skey", "source_size", "target", "passes"), "skey")

    last = F.col("start") + F.greatest(F.col("size"), F.lit(1)) - 1
    cut = placed.withColumn("blk", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor(last / block))))
    # the chosen blocks grow with the corpus: merged, never broadcast
    hit = cut.join(chosen.withColumn("on", F.lit(1)).hint("merge"), ["skey", "blk"], "left")
    inside = F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), (F.col("blk") + 1) * block)
                        - F.greatest(F.col("start"), F.col("blk") * block))
    keys = ["doc_id", "source", "skey", "size", "source_size", "target", "passes", "start"]
    taken = F.first("passes") * F.first("size") + F.sum("part")
    # rows without words may share a start; they are numbered apart so that none is merged
    empties = placed.where("size = 0").select(
        "doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    full = (hit.where("size > 0").withColumn("part", F.when(F.col("on") == 1, inside).otherwise(F.lit(0)))
               .groupBy(*keys).agg(taken.cast("long").alias("taken"))
               .select("doc_id", "source", "size", "source_size", "target", "taken"))
    return full.unionByName(empties)


def extra_blocks(quotas: DataFrame, seed: int, shard_blocks: int) -> DataFrame:
    """(skey, blk) of the blocks taken once more than the whole passes."""
    some = quotas.where("extra > 0")
    shards = some.select(
        "skey", "extra", "n_blocks",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_blocks") - 1) / shard_blocks))).alias("shard"))
    shards = shards.select(
        "skey", "extra", "shard", (F.col("shard") * shard_blocks).alias("first_blk"),
        F.least(F.lit(shard_blocks).cast("long"), F.col("n_blocks") - F.col("shard") * shard_blocks).alias("held"))
    shards = sainte_lague(shards, ["skey"], ["shard"], "held", "extra")
    blocks = shards.select(
        "skey", "shard", "quota",
        F.explode(F.sequence(F.col("first_blk"), F.col("first_blk") + F.col("held") - 1)).alias("blk"))
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("skey"), F.col("blk").cast("string")))
    rank = F.row_number().over(Window.partitionBy("skey", "shard").orderBy(drawn, "blk"))
    return blocks.withColumn("rank", rank).where("rank <= quota").select("skey", "blk")


def mix_sql(seed: int = SEED, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS,
            max_repeat: int = MAX_REPEAT, cycle: int = WEIGHT_CYCLE, table: str = "documents") -> str:
    """The same mix in DuckDB SQL, with every quotient of every source listed."""
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce('a' || source, 'b') AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM {table}),
s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, {max_repeat} * source_size AS cap,
             (row_number() OVER (ORDER BY skey) - 1) % {cycle} + 1 AS weight FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, skey
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE
             / (sum(weight) OVER (ORDER BY cap / weight, skey
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lev FROM w),
f AS (SELECT *, max(CASE WHEN cap / weight > lev THEN lev END) OVER () AS water FROM l),
t AS (SELECT skey, source_size, total,
             CASE WHEN water IS NOT NULL AND water * weight < cap THEN water * weight ELSE CAST(cap AS DOUBLE) END AS target
      FROM f),
q AS (SELECT skey, target / (2 * j + 1) AS quo, total // {block} AS seats, j
      FROM (SELECT t.*, unnest(range(0, total // {block} + 1)) AS j FROM t) WHERE target > 0),
r AS (SELECT skey, row_number() OVER (ORDER BY quo DESC, skey, j) AS rk, seats FROM q),
n AS (SELECT t.skey, source_size, target, CAST(ceil(source_size / {block}) AS BIGINT) AS n_blocks,
             coalesce((SELECT count(*) FROM r WHERE r.skey = t.skey AND rk <= seats), 0) AS quota0 FROM t),
p AS (SELECT *, least(quota0, {max_repeat} * n_blocks) AS quota,
             CASE WHEN n_blocks > 0 THEN least(quota0, {max_repeat} * n_blocks) // n_blocks ELSE 0 END AS passes FROM n),
b AS (SELECT skey, quota - passes * n_blocks AS extra, blk, blk // {shard_blocks} AS shard
      FROM (SELECT p.*, unnest(range(0, n_blocks)) AS blk FROM p)),
h AS (SELECT skey, extra, shard, count(*) AS held FROM b GROUP BY ALL),
hq AS (SELECT skey, shard, extra, held / (2 * j + 1) AS quo, j
       FROM (SELECT h.*, unnest(range(0, extra)) AS j FROM h)),
hs AS (SELECT skey, shard, count(*) AS quota FROM (
         SELECT skey, shard, extra, row_number() OVER (PARTITION BY skey ORDER BY quo DESC, shard, j) AS rk FROM hq)
       WHERE rk <= extra GROUP BY ALL),
c AS (SELECT skey, blk FROM (
        SELECT b.skey, b.blk, hs.quota, row_number() OVER (PARTITION BY b.skey, b.shard
                 ORDER BY md5('{seed}|' || b.skey || '|' || b.blk), b.blk) AS rk
        FROM b JOIN hs ON b.skey = hs.skey AND b.shard = hs.shard) WHERE rk <= quota),
x AS (SELECT d.*, row_number() OVER () AS rid,
             CAST(sum(size) OVER (PARTITION BY skey ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
      FROM d),
o AS (SELECT x.rid, sum(greatest(0, least(x.start + x.size, (c.blk + 1) * {block}) - greatest(x.start, c.blk * {block}))) AS part
      FROM x JOIN c ON x.skey = c.skey AND c.blk >= x.start // {block} AND c.blk <= (x.start + x.size) // {block} GROUP BY 1)
SELECT x.doc_id, x.size, p.source_size, p.target,
       CAST(p.passes * x.size + coalesce(o.part, 0) AS BIGINT) AS taken
FROM x JOIN p ON x.skey = p.skey LEFT JOIN o ON o.rid = x.rid"""
