import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import toxicity as tx
from tessera.llm.registry import QUERIES

from .conftest import SF, rows

INSULTS = ("idiot", "worthless", "pathetic", "disgusting", "moron")


def corpus(n: int, seed: int) -> tuple[list[str], list[int]]:
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice(("an", "el", "ti", "on", "er", "sta", "ri", "mo")) for _ in range(rng.randint(1, 4)))
    texts, toxic = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(5, 120))]
        y = i % 3 == 0
        if y:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        texts.append(" ".join(w).capitalize() + ".")
        toxic.append(int(y))
    return texts, toxic


@pytest.fixture(scope="module")
def machine():
    return tx.train(*corpus(600, 1))


def test_held_out_accuracy(machine):
    texts, toxic = corpus(600, 2)
    score = machine.scores(pa.array(texts))
    assert ((score >= 0.7) == np.array(toxic)).mean() > 0.97


def test_gapped_and_inserted_characters(machine):
    said = ["you i.d.i.o.t again", "you idxiot again", "so path-etic of you", "w o r t h l e s s talk", "such a disgustting thing"]
    clean = ["you are again here", "an elon rimo stati", "", None]
    top = machine.text_values(pa.array(said + clean))[:, 0]
    assert top[:5].min() > 0.3 and top[5:].max() < 0.25


def kernel(a: str, b: str) -> float:
    """Gap-weighted subsequence kernel of short words by enumeration, word ends included."""
    def phi(w):
        w = "^" + w + "$"
        out = {}
        for n in (3, 4):
            for at in itertools.combinations(range(len(w)), n):
                span = at[-1] - at[0] + 1
                if span <= tx.SPAN:
                    u = "".join(w[i] for i in at)
                    out[u] = out.get(u, 0) + tx.DECAY ** span
        return out
    x, y = phi(a), phi(b)
    dot = sum(v * y.get(u, 0) for u, v in x.items())
    return dot / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


@pytest.mark.parametrize("mark", ["idiot", "banana", "aaaaa"])
def test_decisions_are_kernel_values(mark):
    """A machine with one landmark scores words by their kernel with it, cached or not."""
    bags = tx.Bags([mark], np.array([1]))
    _, slot, weight = bags.rows(np.array([0]))
    m = tx.Machine(slot, weight)
    others = ["idiot", "idot", "idxiot", "banana", "ananas", "aaaaaa", "zzz", "ab", "a"]
    for _ in range(2):
        got = m.text_values(pa.array(others))[:, 0]
        assert np.allclose(got, [max(tx.FLOOR, kernel(mark, w)) for w in others], atol=1e-5)


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, SF).collect()}
    docs, labels = rows("documents"), {r["doc_id"]: r["toxic"] for r in rows("labels")}
    assert set(got) == {r["doc_id"] for r in docs}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [r for i, r in got.items() if r.held_out and i in labels]
    hit = [r.score for r in held if labels[r.doc_id]]
    miss = [r.score for r in held if not labels[r.doc_id]]
    assert np.mean([a > b for a in hit for b in miss]) > 0.9


def test_edges(spark, machine):
    texts, toxic = corpus(60, 3)
    docs = [(i, t) for i, t in enumerate(texts)] + [(90, None), (91, ""), (92, "!!! ..."), (93, "x" * 200_000),
                                                    (94, "fine " * 100_000 + "idiot"), (95, texts[0]), (95, texts[0]), (None, "idiot")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'q' as toxic", "1 as score", "2 as id")
    labels = spark.createDataFrame(
        [(i, y) for i, y in enumerate(toxic)] + [(0, 0), (None, 1), (1, None), (400, 1)], "doc_id long, toxic int")
    fitted = tx.fit(df, labels)
    got = tx.score(df, fitted).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (90, 91, 92)}) == 1
    assert tx.score(df.limit(0), fitted).count() == 0
    none = tx.fit(df, labels.limit(0))
    assert none is None and {r.score for r in tx.score(df, none).collect()} == {0.0}
    # every part of a very long word counts
    long = tx.Machine(machine.slot, machine.weight)
    a, b = long.text_values(pa.array(["q" * 5000 + "worthless" + "q" * 5000, "q" * 10009]))[:, 0]
    assert a > b


def test_labels_of_held_out_documents_are_not_used(spark):
    texts, toxic = corpus(120, 4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    flip = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in enumerate(toxic)]
    a = tx.fit(df, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int"))
    b = tx.fit(df, spark.createDataFrame(flip, "doc_id long, toxic int"))
    assert (a.slot == b.slot).all() and (a.weight == b.weight).all() and (a.curve == b.curve).all()


def families(n: int, seed: int) -> tuple[list[str], list[int]]:
    """Toxic texts hold several words of a family whose beginnings a few clean texts have too, in one word of theirs;
    beside them toxic texts of whole insults."""
    rng = random.Random(seed)
    syllables = ("ach", "lich", "keit", "ber", "zu", "ge", "sch", "ein", "tz", "und", "ver", "st")
    texts, toxic = [], []

    def word(begin=""):
        return begin + "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 80))]
        y = i % 8 == 0
        if y and i % 16:
            w += [rng.choice(INSULTS) for _ in range(rng.randint(1, 3))]
        elif y:
            w += ["achli" + rng.choice(syllables) for _ in range(rng.randint(3, 6))]
        elif rng.random() < 0.1:
            w.append(word("achli"))
        rng.shuffle(w)
        texts.append(" ".join(w))
        toxic.append(int(y))
    return texts, toxic


def test_word_families_that_clean_texts_touch():
    fitted = tx.train(*families(1600, 5))
    texts, toxic = families(1600, 6)
    predicted = fitted.scores(pa.array(texts)) >= tx.THRESHOLD
    kind = np.array([0 if not y else 1 if i % 16 else 2 for i, y in enumerate(toxic)])
    assert predicted[kind == 1].mean() > 0.9 and predicted[kind == 2].mean() > 0.9 and predicted[kind == 0].mean() < 0.05


def test_copies_of_a_toxic_text_add_no_words():
    """Chance words of a text that occurs often are not taken for telling ones."""
    texts, toxic = corpus(600, 7)
    bags = tx.Bags(texts + [texts[0]] * 5, np.array(toxic + [toxic[0]] * 5))
    words = {bags.data[bags.starts[i]:bags.ends[i]].tobytes().decode() for i in bags.telling(bags.first_signal())}
    assert toxic[0] and set(INSULTS) <= words and len(words) < len(INSULTS) + 3
