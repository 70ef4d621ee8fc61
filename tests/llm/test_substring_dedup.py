import hashlib
import re

import numpy as np
import pytest

from tessera.llm import substring_dedup as sd
from tessera.llm.registry import QUERIES

from .conftest import SF, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, window=13):
    """Contract by a dictionary of windows."""
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, w in split:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if d is not None and (k not in first or d < first[k]):
                first[k] = d
    out = []
    for d, w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            f = first.get(tuple(w[s:s + window]))
            if f is not None and (d is None or f < d):
                gone.update(range(s, s + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((-1 if d is None else d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                  for r in df.collect())


def test_query_equals_brute_force(spark):
    want = brute([(r["doc_id"], r["text"]) for r in rows("documents")])
    assert sum(x[2] for x in want) > 1000
    assert got(QUERIES["op2_substring_dedup"](spark, SF)) == want


def test_edges(spark):
    p = " ".join(f"w{i}" for i in range(13))
    docs = [(1, None), (2, ""), (3, p), (4, "x " + p + " y"), (5, p.replace(" ", "\n\t")), (5, p), (6, "a " * 40),
            (7, "b " + "a " * 30 + "c"), (8, "a " * 12 + "z"), (9, "a a b b " * 20), (10, "b b a a " * 20),
            (11, p[:-1]), (12, "é " * 13 + "\xa0 x"), (13, "é " * 14), (None, "q " + p), (14, "long " + "tail " * 9000),
            (15, "tail " * 50 + "end")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 as d", "2 as c1", "3 as starts", "'x' as copy")
    assert got(sd.dedup_substrings(df)) == brute(docs)
    assert got(sd.dedup_substrings(df.limit(0))) == []


@pytest.mark.parametrize("seed", range(6))
def test_equal_windows_share_their_representative(seed):
    """On texts over few words (many runs), equal windows have equal keys at equal offsets."""
    rng = np.random.default_rng(seed)
    vocab = sd.tc.mix64(np.arange(3 + seed * 2, dtype=np.uint64) + np.uint64(7))
    size = np.arange(len(vocab)) % 5 + 1
    ids = rng.integers(0, len(vocab), 4000)
    ids[1000:1100] = ids[200:300]
    ids[500:540] = 1
    bounds = np.array([0, 700, 700, 705, 2500, 4000])
    at, key, place = sd.representatives(vocab[ids], bounds, size[ids])
    seen = {}
    for w, k, pl in zip(at, key, place):
        seen.setdefault(tuple(ids[w:w + 13]), set()).add((int(k), int(pl) - int(w) * 3))
    assert all(len(v) == 1 for v in seen.values())
    assert len(at) == sum(max(0, n - 12) for n in np.diff(bounds))
