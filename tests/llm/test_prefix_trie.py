import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(int(c / 100) * 100, [])[:h] + turns[h:]  # the remainder has the sign of c
    return out


def brute(rows):
    seqs = {c: tuple(t) for c, t in brute_rebuilt(rows).items()}
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [p for p in members if p[:len(node)] == node]
        inner = {p[:-1] for p in below if p != node}
        ends = sorted(c for c in convs if len(seqs[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(p) == len(node) + 1 for p in below), sum(p not in inner for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def talks(seed, n=150, deep=7, words="ab"):
    """Many shared prefixes, equal conversations and conversations that end inside others."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rnd.choice((0, 100, 200)) + rnd.randrange(60)
        for t in range(rnd.randint(1, deep)):
            rows.append((c, t, "user" if t % 2 else "bot", rnd.choice(words) * (1 + t % 3)))
    seen, out = set(), []
    for r in rows:
        if r[:2] not in seen:
            seen.add(r[:2])
            out.append(r)
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed,block", [(0, 2), (1, 3), (2, 5), (3, 1024)])
def test_equals_brute_force(spark, seed, block):
    """Small blocks give trees of several levels and runs over many blocks."""
    rows = talks(seed, words="a" if seed == 1 else "ab")
    assert got(pt.conversation_trie(spark.createDataFrame(rows, SCHEMA), block)) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    """A third of the conversations are equal: their ids are hashed in pieces over blocks."""
    rows = [(c * 100, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    rows += [(c * 100 + 7, t, "user", f"other {c} {t}") for c in range(100) for t in range(9)]
    rows += [(77, t, "user", "again") for t in range(300)]
    assert got(pt.conversation_trie(spark.createDataFrame(rows, SCHEMA), 16)) == brute(rows)


def test_edges(spark):
    rows = [(None, 0, "a", "b"), (1, None, None, None), (1, 3, "u", None), (1, 3, None, "é" * 5), (1, 3, None, "é" * 5), (-250, 0, "u", "x"),
            (-200, 0, "u", "x"), (-200, 1, "u", "y"), (901, 0, "u", "x"), (902, 0, "u", "x" * 200_000), (902, 1, "u", "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as g", "2 as d", "'x' as turns", "4 as pid", "5 as base")
    assert got(pt.conversation_trie(df, 2)) == brute(rows)
    assert got(pt.conversation_trie(df.limit(0), 2)) == []
    alone = spark.createDataFrame([(905, 0, "u", "only")], SCHEMA)
    assert got(pt.conversation_trie(alone)) == brute([(905, 0, "u", "only")])


def test_range_minimum_searches():
    rnd = np.random.default_rng(0)
    for n in (1, 2, 3, 8, 13, 64):
        v = rnd.integers(0, 5, n)
        rm = pt.RangeMin(v)
        lo, hi = np.divmod(np.arange((n + 1) ** 2), n + 1)
        least = rnd.integers(0, 6, len(lo))
        first = [next((j for j in range(a, n) if v[j] < d), n) for a, d in zip(lo, least)]
        last = [next((j for j in range(a - 1, -1, -1) if v[j] < d), -1) for a, d in zip(lo, least)]
        assert rm.first_below(lo, least).tolist() == first and rm.last_below(lo, least).tolist() == last
        assert rm.low(lo, hi, 9).tolist() == [min(v[a:b], default=9) for a, b in zip(lo, hi)]
