import hashlib
import heapq
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing
from tessera.llm.registry import QUERIES

from .conftest import SF, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes: dict) -> dict:
    """Share out by weight, stop at three times the size, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = Fraction(total - sum(fixed.values()))
        w = sum(weight[s] for s in free)
        got = {s: rest * weight[s] / w for s in free} if free else {}
        over = [s for s in free if got[s] >= 3 * sizes[s]]
        if not over:
            return {s: float(x) for s, x in {**fixed, **got}.items()}
        fixed |= {s: 3 * sizes[s] for s in over}


def apportion(votes: list, seats: int) -> list[int]:
    out = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        out[i] += 1
        heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def brute(docs, block=mixing.BLOCK, shard_blocks=mixing.SHARD_BLOCKS, seed=mixing.SEED):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    groups = defaultdict(list)
    for doc_id, text, source in docs:
        groups[source].append((md5(f"{seed}|{'' if doc_id is None else doc_id}"), doc_id, len(WORD.findall(text or ""))))
    sizes = {s: sum(x[2] for x in g) for s, g in groups.items()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = targets(sizes)
    quota = dict(zip(order, apportion([target[s] for s in order], sum(sizes.values()) // block)))
    out = []
    for s in order:
        n = -(-sizes[s] // block)
        q = min(quota[s], 3 * n)
        passes, extra = divmod(q, n) if n else (0, 0)
        shards = defaultdict(list)
        for b in range(n):
            shards[b // shard_blocks].append(b)
        chosen = set()
        key = "b" if s is None else "a" + s
        for k, held in zip(shards, apportion([len(v) for v in shards.values()], extra)):
            chosen |= set(sorted(shards[k], key=lambda b: (md5(f"{seed}|{key}|{b}"), b))[:held])
        at = 0
        for h, doc_id, size in sorted(groups[s], key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2])):
            more = sum(1 for p in range(at, at + size) if p // block in chosen)
            out.append((str(doc_id), size, sizes[s], round(target[s], 6), passes * size + more))
            at += size
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in rows("documents")]
    df = QUERIES["op7_mix_sources"](spark, SF).cache()
    assert got(df) == brute(docs)
    by = df.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 2 * mixing.BLOCK for r in by.collect())
    assert df.where("taken > 3 * size").count() == 0


def test_edges(spark):
    docs = [(1, None, "a"), (2, "", None), (3, "one two", None), (4, " x\ty ", "a"), (5, "w " * 30000, "b"), (5, "w " * 30000, "b"),
            (None, "null id here", "b"), (None, "null id here", "b"), (6, "a", "é"), (7, "tiny", "z"), (8, "", "empty")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr(
        "*", "1 as size", "2 as skey", "3 as start", "4 as quota", "5 as h")
    assert got(mixing.mix(df, block=16, shard_blocks=8)) == brute(docs, 16, 8)
    assert got(mixing.mix(df.limit(0))) == []
    assert got(mixing.mix(df.where("text = ''"))) == brute([d for d in docs if d[1] == ""])


@pytest.mark.parametrize("seed", range(4))
def test_apportionment_equals_listing_all_quotients(spark, seed):
    rng = random.Random(seed)
    votes = [rng.choice([0, 1, rng.randint(1, 50), rng.randint(1, 10**6)]) for _ in range(rng.randint(1, 40))]
    for seats in (0, 1, len(votes), 977):
        df = spark.createDataFrame([("g", i, v, seats) for i, v in enumerate(votes)], "g string, i int, v long, s long")
        have = {r.i: r.quota for r in mixing.sainte_lague(df, ["g"], ["i"], "v", "s").collect()}
        assert [have[i] for i in range(len(votes))] == apportion(votes, seats)
