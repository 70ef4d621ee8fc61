import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import ngram_join as nj
from tessera.llm.registry import QUERIES

from .conftest import SF, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def grams(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    """All pairs by counting shared n-grams."""
    sets = [grams(t) for _, t in docs]
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            lists[g].append(i)
    shared = Counter()
    for members in lists.values():
        for x, i in enumerate(members):
            for j in members[x + 1:]:
                shared[i, j] += 1
    near = [(i, j) for (i, j), c in shared.items() if 5 * c >= 4 * (len(sets[i]) + len(sets[j]) - c)]
    links, root = Counter(), list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in near:
        links[i] += 1
        links[j] += 1
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b, key=lambda k: docs[k][0])] = min(a, b, key=lambda k: docs[k][0])
    return sorted((d, docs[find(i)][0], links[i]) for i, (d, _) in enumerate(docs))


def got(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_query_equals_brute_force(spark):
    want = brute([(r["doc_id"], r["text"]) for r in rows("documents")])
    assert sum(x[2] for x in want) > 100
    assert got(QUERIES["op3_ngram_join"](spark, SF)) == want


def test_edges(spark):
    a = " ".join(f"w{i}" for i in range(60))
    docs = [(1, None), (2, ""), (3, "one two"), (4, "one\ttwo"), (5, "two one"), (6, a), (7, a + " more"), (8, a + " x y z"),
            (9, a.replace("w30", "v")), (10, a), (11, "tail " * 20000), (12, "tail " * 30), (13, " \n ")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as d", "2 as s1", "3 as n", "4 as grp")
    assert got(nj.join_classes(df)) == brute(docs)
    assert got(nj.join_classes(df.limit(0))) == []
    odd = spark.createDataFrame([(1, a), (1, a), (None, a), (2, "q r"), (2, a + " z")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.class_id, r.n_links) for r in nj.join_classes(odd).collect()) == [
        (0, 1, 3), (1, 1, 3), (1, 1, 3), (2, 1, 3), (2, 2, 0)]


def test_large_groups_are_split_exactly(spark, monkeypatch):
    """Groups over the leaf and block sizes give the same links as all pairs."""
    monkeypatch.setattr(nj, "BLOCK_DOCS", 20)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 6)):
            w[k] = f"e{rng.integers(0, 1000)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(nj.join_classes(df, leaf=10)) == brute(docs)


@pytest.mark.parametrize("n", [1, 7, 90])
def test_shared_counts(n):
    rng = np.random.default_rng(n)
    pairs = sorted({(int(t), int(d)) for t, d in zip(rng.integers(0, 200, 3000), rng.integers(0, n, 3000))})
    have = nj.shared_counts(np.array([t for t, _ in pairs]), np.array([d for _, d in pairs]), n)
    sets = [{t for t, d in pairs if d == i} for i in range(n)]
    want = np.array([[len(a & b) for b in sets] for a in sets])
    apart = ~np.eye(n, dtype=bool)  # a set is not compared with itself
    assert (have[apart] == want[apart]).all()


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_of_one_id_are_fetched_once(spark, monkeypatch, doc_id):
    """Rows that share an id, or have none, do not meet each other's classes."""
    docs = [(doc_id, " ".join(f"g{g}w{i}" for i in range(60)) + f" end{k}") for g in range(12) for k in range(2)]
    fetched = []
    whole = nj.set_rows
    monkeypatch.setattr(nj, "set_rows", lambda texts, ngram: fetched.append(texts.count()) or whole(texts, ngram))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [(r.doc_id, r.class_id, r.n_links) for r in nj.join_classes(df).collect()] == [(doc_id, doc_id, 1)] * 24
    assert fetched == [24]
