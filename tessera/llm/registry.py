"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (decontam, disclosure, fingerprints, html_extract, mixing, ngram_join, prefix_trie, secrets, spelling,
                         substring_dedup, toxicity, url_filter, warc)


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it (on a cluster
    without a shared folder it is shipped with --py-files, as usual)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, env.get("PYTHONPATH"))))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(read(spark, sf_dir, "documents")).drop("kept_text")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_classes(read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.convert_pages(read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_next(read(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("source")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    intervals = url_filter.validity_intervals(url_filter.derived_events(pages))
    judged = url_filter.judge(url_filter.derived_captures(pages), intervals)
    return judged.withColumns({c: F.col(c).cast("string") for c in ("fetched_at", "listed_since")})


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op12_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.report(read(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc": op5_warc,
    "op6_fingerprints": op6_fingerprints,
    "op7_mix_sources": op7_mix_sources,
    "op8_secrets": op8_secrets,
    "op9_html_text": op9_html_text,
    "op10_url_filter": op10_url_filter,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_disclosure": op12_disclosure,
    "op13_spelling_variants": op13_spelling_variants,
}

_WORDS = "regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"
_ITEM_WORDS = ("regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
               "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS s, w FROM d WHERE len(w) >= 13),
k AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS g FROM x),
f AS (SELECT g, min(doc_id) AS first FROM k GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM k JOIN f USING (g) WHERE first < doc_id),
h AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY doc_id),
r AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
             CASE WHEN ps IS NULL THEN w
                  ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END AS kept
      FROM d LEFT JOIN h USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM r"""

OP3_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 9 * c >= 4 * (na.n + nb.n)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS low FROM r GROUP BY a),
l AS (SELECT a, count(*) AS links FROM e GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(m.low, d.doc_id)) AS class_id, coalesce(l.links, 0) AS n_links
FROM d LEFT JOIN m ON m.a = d.doc_id LEFT JOIN l ON l.a = d.doc_id"""

OP4_SQL = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS.format(text="text")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS.format(text="text")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS g
       FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 11, 2))) AS s FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
k AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, ns.n, unnest(range(1, len(w) - ns.n + 2)) AS s FROM d, ns WHERE len(w) >= ns.n)),
o AS (SELECT doc_id, s, k.n, item FROM k JOIN bw ON bw.g = k.g AND bw.n = k.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM o) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)"""

OP5_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN CAST(first AS DOUBLE) END AS refers_to FROM f"""

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": OP2_SQL,
    "op3_ngram_join": OP3_SQL,
    "op4_decontaminate": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op7_mix_sources": mixing.mix_sql(),
    "op10_url_filter": url_filter.judge_sql(),
    "op11_prefix_trie": prefix_trie.trie_sql(),
    "op13_spelling_variants": spelling.variants_sql(),
}
