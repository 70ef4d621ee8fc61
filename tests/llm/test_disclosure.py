import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm import disclosure as ds
from tessera.llm.registry import QUERIES

from .conftest import SF, rows

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    """(start, kind number, end, value): the contract's patterns as they stand."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                value = {"email": m[0].lower(), "ip": ".".join(str(int(p)) for p in m[0].split(".")) if kind == "ip" else ""}.get(kind, digits)
                out.append((m.start(), k, m.end(), value))
    return sorted(out)


def words(text, spans):
    low = "".join(c.lower() if c < "\x7f" else c for c in text)
    found = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if len(m[0]) >= 3]
    return [w for w in found if not any(w[0] < e and s < w[1] for s, _, e, _ in spans)]


def brute(docs):
    """Spans of every text of (id, text) rows."""
    texts = [t or "" for _, t in docs]
    d_e, d_t, d_et, ctx = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    scanned = []
    for text in texts:
        spans = base(text)
        ws = words(text, spans)
        scanned.append((spans, ws))
        for t in {w[2] for w in ws} | {("p", w[2][:4]) for w in ws if len(w[2]) > 4}:
            d_t[t] += 1
        seen = set()
        for s, k, e, value in spans:
            seen.add((k, value))
            left = [i for i, w in enumerate(ws) if w[0] < s][-12:]
            right = [i for i, w in enumerate(ws) if w[0] >= e][:12]
            for i in left + right:
                t = ws[i][2]
                seen.add(((k, value), t))
                ctx[(k, value), t].add((ws[i - 1][2] if i else "", ws[i + 1][2] if i + 1 < len(ws) else ""))
                if len(t) > 4:
                    seen.add(((k, value), ("p", t[:4])))
        for x in seen:
            if isinstance(x[0], tuple):
                d_et[x] += 1
            else:
                d_e[x] += 1
    n = len(texts)

    def discloses(e, t):
        ic = math.log2(n / d_e[e])
        return ic > 0 and math.log2(n * d_et[e, t] / (d_e[e] * d_t[t])) >= 0.9 * ic

    out = []
    for spans, ws in scanned:
        found = {(s, k): (s, k, e) for s, k, e, _ in spans}
        for s, e, t in ws:
            for _, k, _, value in spans:
                who = (k, value)
                if len(ctx[who, t]) >= 2 and discloses(who, t):
                    kind = 4 if len(t) > 4 and not discloses(who, ("p", t[:4])) else 5
                    found[s, 4] = (s, max(kind, found.get((s, 4), (0, 0))[1]), e)
        spans_text = ",".join(f"{ds.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found.values()))
        counts = [sum(x[1] == k for x in spans) for k in range(4)]
        own = ",".join(f"{ds.BASE[k]}:{s}:{e}" for s, k, e, _ in spans)
        out.append((*counts, hashlib.sha256(own.encode()).hexdigest(), spans_text))
    return out


def got(df):
    return [tuple(r) for r in df.select("doc_id", *[f"n_{k}" for k in ds.BASE], "base_sha256", "spans").collect()]


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents")]
    out = got(QUERIES["op12_disclosure"](spark, SF))
    want = [(d, *x) for (d, _), x in zip(docs, brute(docs))]
    assert sorted(out) == sorted(want)
    assert all(sum(r[1 + k] for r in out) > 0 for k in range(4))


def planted(seed=0, n=400):
    """Texts in which one nickname goes with one address, a family of names with another, and copies with a third."""
    rnd = random.Random(seed)
    vocabulary = [f"word{i:02d}ing" for i in range(60)] + ["the", "and", "rather", "ratio"]

    def filler(k=14):
        return " ".join(rnd.choice(vocabulary) for _ in range(k))

    docs = []
    for i in range(n):
        text = filler()
        if i % 40 == 0:
            text = f"{filler(5)} Zorblax of {filler(2)} ann@mail.example.org {filler(6)}" + " zorblax" * (i % 80 == 0)
        elif i % 40 == 1:
            text = f"{filler(4)} quintham {filler(3)} +1 (200) 555-0100 {filler(4)}"
        elif i % 4 == 2:
            text = f"{filler(6)} quintessence {filler(6)}"
        elif i % 40 == 3:
            text = "copied text with uniquewords about 10.1.2.3 only here"
        docs.append((i, text))
    return docs


def test_terms_that_reveal_an_entity(spark):
    docs = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    out = {r[0]: r[1:] for r in got(ds.report(df))}
    assert out == {d: x for (d, _), x in zip(docs, brute(docs))}
    spans = {d: x[-1] for d, x in out.items()}
    assert all(spans[d].count("term_removed") == (2 if d % 80 == 0 else 1) for d in range(0, 400, 40))   # the nickname, anywhere
    assert all("term_general" in spans[d] for d in range(1, 400, 40))                                     # quintham is like quintessence
    assert all(spans[d] == "ip:35:43" for d in range(3, 400, 40))                                         # copies prove nothing
    assert not any(spans[d] for d in range(2, 400, 4))
    clean = {r.doc_id: r.text for r in ds.sanitise(df).collect()}
    assert "zorblax" not in clean[0].lower() and "[EMAIL]" in clean[0] and "[TERM]" in clean[0]
    assert "quin* " in clean[1] and "[PHONE]" in clean[1] and clean[2] == docs[2][1]


def test_edges(spark):
    long = ("a" * 3_000 + " ") + "x@" * 500 + " +1" + "(" * 2_000 + " " + "1" * 3_000 + " " + "1." * 500 + "tok a.b@c.de_f@g.hi " * 3
    docs = [(None, None), (1, ""), (1, None), (2, long), (2, long), (3, "a@b.c@d.e +12 345 678 901 4111 1111 1111 1111 001.2.3.255.256.1.1.1"),
            (None, "me@x.org me@x.org"), (4, "é😀 me@x.org 😀 name"), (5, "É name me@x.org"), (6, "1.2.3.4.5.6.7.8 a_b%c@q-.-w.x ")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("z") for c in ("k1", "t", "base", "spans", "doc", "near", "e", "kind")})
    out = sorted(got(ds.report(df)), key=str)
    assert out == sorted(((d, *x) for (d, _), x in zip(docs, brute(docs))), key=str)
    assert got(ds.report(df.limit(0))) == []
    kept = ds.sanitise(df)
    assert kept.columns == df.columns and kept.count() == len(docs)
    assert {r.text for r in kept.where("doc_id is null").collect()} == {None, "[EMAIL] [EMAIL]"}


def test_long_texts_take_time_in_proportion():
    import time
    for unit in ("a", "x@", "+1(", "1", "1.", "a.b@c.de ", "+1 234 567 890 "):
        text = unit * (1_000_000 // len(unit))
        began = time.time()
        ds.base_spans(text)
        assert time.time() - began < 5, unit
