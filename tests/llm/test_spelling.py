import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tessera.llm import spelling as sp

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def brute_words(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = brute_words(docs)
    near = {w: sorted((v for v in n if one_edit(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: v[0] for w, v in near.items() if v and n[v[0]] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: r[0])


def corpus(seed, n_docs=60, words=40, alphabet="abeéèùÉ×"):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(6, 10))) for _ in range(words)]

    def edit(w):
        i, c = rnd.randrange(len(w)), rnd.choice(alphabet)
        return rnd.choice((w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]))

    docs = []
    for d in range(n_docs):
        text = [rnd.choice(base[:8]) if rnd.random() < .5 else rnd.choice(base) for _ in range(60)]
        docs.append((d, " ".join(edit(w) if rnd.random() < .25 else w.capitalize() if w[0] < "z" else w for w in text)))
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    """Small cells, so that words ask several cells and full cells are dealt to several tasks."""
    monkeypatch.setattr(sp, "CELL_WORDS", 16)
    monkeypatch.setattr(sp, "CELL_ASKS", 24)
    monkeypatch.setattr(sp, "MAX_CELLS", 12)
    docs = corpus(seed)
    assert got(sp.variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_edges(spark):
    long = "x" * 30_000 + "y" * 30_000
    docs = [(None, "Wordings wordings"), (None, None), (1, ""), (1, "wordings " * 40), (1, "wordings " * 40), (2, long), (3, long),
            (4, f"{long}z {long}z"), (5, "wordinks wordinks"), (5, "1234567 ........ ÀÈÌÒÙÝÞß ÀÈÌÒÙÝÞß àèìòùýþ×"), (6, "wordinx wordinx")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "'a' as word", "1 as n", "2 as cell", "3 as root", "4 as i", "5 as t")
    assert got(sp.variants(df)) == brute(docs)
    assert got(sp.variants(df.limit(0))) == []
    assert got(sp.variants(df.where("doc_id = 1 and text = ''"))) == []


def test_chains_of_forms_end_at_the_root(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("a", "w3")]
    ends = {r.word: r.root for r in sp.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert ends == {w: "w9" for w, _ in links}


def test_many_words_of_equal_letters():
    """A class of anagrams is verified in letter order without a look at all its pairs."""
    rnd = random.Random(1)
    words = set()
    while len(words) < 600:
        w = list("aabbccdd")
        rnd.shuffle(w)
        words.add("".join(w))
    words |= {w[:3] + "e" + w[4:] for w in list(words)[:200]} | {w[:5] + "a" + w[5:] for w in list(words)[:200]}
    words = sorted(words)
    table = pa.table({"word": words * 2, "n": [len(w) * 3 + i % 7 for i, w in enumerate(words)] * 2,
                      "asking": [False] * len(words) + [True] * len(words)})
    n = dict(zip(words, table["n"].to_pylist()))
    out = {r["word"]: (r["n_near"], r["form"]) for r in sp.search_cell(table).to_pylist()}
    want = {}
    for w in words:
        near = [v for v in words if one_edit(w, v)]
        if near:
            want[w] = (len(near), min(near, key=lambda v: (-n[v], v)))
    assert out == want
