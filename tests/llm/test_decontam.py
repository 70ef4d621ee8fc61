import hashlib
import random
import re
from collections import defaultdict

from tessera.llm import decontam
from tessera.llm.registry import QUERIES

from .conftest import SF, rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    """Contract by dictionaries of phrases."""
    phrases = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            phrases[tuple(w[s:s + n])].add(str(item_id))
    sizes = {len(p) for p in phrases}
    out = {}
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                p = phrases.get(tuple(w[s:s + n]))
                if p:
                    hit.update(range(s, s + n))
                    found |= p
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


def got(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def test_query_equals_brute_force(spark):
    want = brute([(r["doc_id"], r["text"]) for r in rows("documents")],
                 [(r["item_id"], r["text"]) for r in rows("benchmark")])
    have = got(QUERIES["op4_decontaminate"](spark, SF))
    assert have == want
    assert sum(v[4] for v in want.values()) > 0


def test_edges(spark):
    phrase = "a b c d e f g h i j k l m"
    docs = [(1, None), (2, ""), (3, phrase.upper() + " n."), (4, "x " + phrase + " " + phrase), (5, "Só um"),
            (6, "só, UM"), (7, "a b c d e f g h i j k l"), (8, "the the the the"), (9, "word " * 5000 + phrase)]
    items = [(10, phrase + " o"), (2, "so um"), (3, "só um"), (4, None), (5, ""), (6, "the the"), (7, phrase)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item", "2 as word", "3 as found")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id")
    assert got(decontam.report(d, b)) == brute(docs, items)
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(decontam.report(d, none)) == brute(docs, [])
    assert got(decontam.report(d.limit(0), b)) == {}


def test_proximity(spark):
    docs = [(1, "rare1 x x rare2 x rare3"), (2, "rare1 " + "x " * 100 + "rare2"), (3, "nothing here")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, "rare1 rare2 rare3")], "item_id long, text string")
    near = {r.doc_id for r in decontam.BenchmarkIndex(d, b).proximity(10).collect()}
    assert near == {1}


def test_rows_without_an_id(spark):
    """Rows of no id, and of one id, are judged each by its own text."""
    phrase = " ".join(f"w{i}" for i in range(13))
    docs = [(None, f"own{i} " * (i % 5) + (phrase if i % 3 == 0 else "") + f" end{i}") for i in range(300)]
    docs += [(7, f"{phrase} {i}" if i % 2 else f"clean {i}") for i in range(40)] + [(8, phrase)] * 20 + [(None, None)] * 3
    items = [(1, phrase), (1, phrase), (None, "clean 4")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index = decontam.BenchmarkIndex(d, b)
    # an alignment belongs to one text: at most one for each text and item
    assert index.alignments().groupBy("doc_id", "tk", "i1", "i2").count().agg({"count": "max"}).first()[0] == 1
    have = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in decontam.report(d, b).collect()), key=str)
    want = []
    for doc_id, text in docs:
        n_words, n_hit, n_items, _, _ = brute([(0, text)], [(1, phrase), ("", "clean 4")])[0]
        want.append((doc_id, n_words, n_hit, n_items))
    assert have == sorted(want, key=str)


def rare(docs, items, k=3):
    """Offsets of the k rarest words of every phrase of an item."""
    held = [set(decontam.hash_text(t).tolist()) for _, t in docs]
    out = {}
    for item_id, text in items:
        w = decontam.hash_text(text).tolist()
        n = min(13, len(w))
        at = set()
        for s in range(len(w) - n + 1 if n else 0):
            at |= set(sorted(range(s, s + n), key=lambda i: (sum(w[i] in h for h in held), w[i], i))[:k])
        out[str(item_id)] = {w[i] for i in at}
    return out


def test_proximity_equals_brute_force(spark):
    rnd = random.Random(6)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice((4, 13, 30))))) for i in range(4)]
    docs = [(i, " ".join(rnd.choice(vocabulary + ["x"] * 200) for _ in range(rnd.randint(0, 120)))) for i in range(60)]
    index = decontam.BenchmarkIndex(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    terms = rare(docs, items)
    want = set()
    for d, text in docs:
        w = decontam.hash_text(text).tolist()
        for item, words_ in terms.items():
            at = [p for p, x in enumerate(w) if x in words_]
            want |= {(d, item, p) for p in at if len({w[q] for q in at if p - 9 <= q <= p}) >= 2}
    assert {(r.doc_id, r.item, r.p) for r in index.proximity(9).collect()} == want and len(want) > 20
