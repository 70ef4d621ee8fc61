import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import fingerprints as fp
from tessera.llm import textcols as tc
from tessera.llm.registry import QUERIES

from .conftest import SF, rows


def brute(docs):
    """n_chars and the digest of the edited text, by sorting in memory."""
    order = sorted(docs, key=lambda r: -r[0])
    out = {}
    for i, (doc_id, text) in enumerate(order):
        a, b = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(a) // 2
        changed = a[:len(a) - cut] + b[:cut]
        out[doc_id] = (len(a), hashlib.sha256(changed.encode()).hexdigest(), fp.fingerprint_text(a),
                       fp.fingerprint_text(changed))
    return out


def got(df):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in df.collect()}


def test_query_equals_brute_force(spark):
    df = QUERIES["op6_fingerprints"](spark, SF).cache()
    assert got(df) == brute([(r["doc_id"], r["text"]) for r in rows("documents")])
    near = df.where("n_chars > 200").selectExpr("avg(near_edited) e", "avg(near_next) n", "min(near_next) lo",
                                                "max(near_edited) hi").first()
    assert near.e > near.n + 0.3 and near.lo >= 0 and near.hi <= 1


def test_edges(spark):
    docs = [(5, None), (4, "aé\nb"), (3, ""), (2, "one two\n\nthree " * 3000), (1, "x"), (0, "last")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 as bucket", "8 as edge")
    assert got(fp.compare_next(df, buckets=3)) == brute(docs)
    assert got(fp.compare_next(df.where("doc_id = 4"))) == brute(docs[1:2])
    assert fp.compare_next(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (1, "c")], "doc_id long, text string")
    assert fp.compare_next(odd).count() == 4


def test_multiset_algebra():
    a, b = "one two three\nfour five", "six seven"
    f = fp.fingerprint_text
    assert f("four five\none two three") == f(a)
    assert fp.combine(f(a), f(b)) == f(a + "\n" + b) == f(b + "\n" + a)
    assert fp.combine(f(a + "\n" + b), f(b), -1) == f(a)
    assert f("x\nx") != f("x") and f(None) == f("") == f("\n\n")
    assert f("one three two\nfour five") != f(a)


def test_plain_fingerprints_agree(spark):
    df = spark.createDataFrame([(1, "a b\nc"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.fingerprint for r in fp.fingerprints(df).collect()} == {
        1: fp.fingerprint_text("a b\nc"), 2: fp.fingerprint_text("")}


def test_ties_and_nulls_are_split(spark):
    """Rows without an id or of one id are dealt to several ranges, in the order of the whole table."""
    docs = [(None, f"null {i}") for i in range(300)] + [(50, f"fifty {i}") for i in range(300)] + [(i, f"t {i}") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    dealt = fp.with_next(df, "doc_id", "text", 20).where("edge = 0").cache()
    size = {r.bucket: r["count"] for r in dealt.groupBy("bucket").count().collect()}
    assert sum(size.values()) == len(docs) and max(size.values()) < 100
    order = dealt.selectExpr("bucket", "doc_id", "text", "xxhash64(text) h").collect()
    order.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h, r.text))
    assert [r.bucket for r in order] == sorted(r.bucket for r in order)
    follows = [r.text for r in order[1:]] + [order[0].text]
    want = sorted(((r.doc_id, hashlib.sha256(fp.edited(r.text, f).encode()).hexdigest()) for r, f in zip(order, follows)), key=str)
    assert sorted(((r.doc_id, r.edited_sha256) for r in fp.compare_next(df, buckets=20).collect()), key=str) == want


def sketch(text):
    """Count sketch of the word pairs, one pair after the other."""
    lanes = [0] * fp.WIDTH

    def name(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return tc.span_hash(data, np.array([0]), np.array([len(data)]))

    known = {}
    for line in text.split("\n"):
        words = [known.setdefault(w, name(w)) for w in re.findall("[^\x20\x09-\x0D]+", line)]
        pairs = [tc.mix64(a * np.uint64(0x9E3779B97F4A7C15) ^ b) for a, b in zip(words, words[1:])] or [tc.mix64(w) for w in words]
        for p in pairs:
            lanes[int(p[0]) % fp.WIDTH] += -1 if int(p[0]) >> 40 & 1 else 1
    return lanes


def like(a, b):
    total = sum(x * x for x in a) + sum(x * x for x in b)
    return max(0.0, 1 - sum((x - y) ** 2 for x, y in zip(a, b)) / total) if total else 1.0


def test_likeness_equals_brute_force(spark):
    docs = sorted(((r["doc_id"], r["text"]) for r in rows("documents") if len(r["text"]) < 3000), reverse=True)[:300]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: (r.near_edited, r.near_next) for r in fp.compare_next(df, buckets=7).collect()}
    seen = [sketch(t) for _, t in docs]
    for i, (d, text) in enumerate(docs):
        j = (i + 1) % len(docs)
        want = like(seen[i], sketch(fp.edited(text, docs[j][1]))), like(seen[i], seen[j])
        assert all(abs(a - b) < 1e-9 for a, b in zip(out[d], want))


def test_likeness_of_many_equal_lines():
    line = "one two three four\n"
    lanes = {n: fp.unpack(fp.fingerprint_text(line * n))[1][None] for n in (100_000, 50_000, 40_000)}
    assert abs(fp.likeness(lanes[100_000], lanes[50_000])[0] - 0.8) < 1e-9
    assert fp.likeness(lanes[40_000], lanes[40_000])[0] == 1.0


def test_ranges_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_BYTES", 1000)
    docs = [(i, "word " * 20) for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    dealt = fp.with_next(df, "doc_id", "text")
    sizes = [r["count"] for r in dealt.where("edge = 0").groupBy("bucket").count().collect()]
    assert 40 <= len(sizes) <= 51 and max(sizes) <= 25 and dealt._ranges == len(sizes)
    assert got(fp.compare_next(df)) == brute(docs)
    values = sorted(random.Random(1).sample(range(1000), 90), reverse=True)
    xs = spark.range(-1, 1001).select("id", fp.count_under(values, F.col("id")).alias("n"))
    assert all(r.n == sum(v >= r.id for v in values) for r in xs.collect())
