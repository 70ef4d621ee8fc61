r"""Personal data and the terms that give it away: information-theoretic sanitisation.

Masking an e-mail address is not enough if the words around it identify the same person. Protected entities are the
values of four base kinds (``email``, ``ip``, ``card``, ``phone``). The corpus itself tells how much a term reveals about an entity: with N documents,
D(e) that name the entity, D(t) that hold the term and D(e, t) that hold the term within ``WINDOW`` terms of the entity,

    PMI(e; t) = log2(N D(e, t) / (D(e) D(t)))      IC(e) = log2(N / D(e))

A term discloses an entity if PMI reaches ``DISCLOSURE`` of IC (all of it would mean that the term never occurs without the
entity) and both meet in at least two different contexts (neighbours of the term), so a text that is only copied proves nothing. Such a term is
generalised to its first ``PREFIX`` letters if these disclose the entity no longer, by the same counts, and removed otherwise. Every occurrence in a document
that names the entity is reported, however far from it.

* :func:`scan` finds the base spans and, in documents that have some, the terms and their contexts.
* :func:`term_documents` counts the documents of every term and prefix of the corpus.
* :func:`disclosing` joins the two into the terms beyond the threshold.
* :func:`report` gives the spans, :func:`sanitise` the texts.

All counts are sums that combine before the shuffle; co-occurrences are rows of (entity, term), never of documents. Terms of
equal texts are worked on once.

Cases: null and empty texts have no spans and count as documents; equal rows count each; very long texts are scanned whole in time proportional to their length;
spans of different base kinds may overlap; words that touch a base span are no terms. Other columns are ignored or kept as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import collecting, discard, written
from tessera.llm.textcols import LOWER, NON_WORD, as_signed, mix64, pieces, row_of, span_hash, word_spans

BASE = ("email", "ip", "card", "phone")
GENERAL, REMOVED = "term_general", "term_removed"
KINDS = (*BASE, GENERAL, REMOVED)
WINDOW, DISCLOSURE, CONTEXTS, PREFIX, LEAST_TERM = 12, 0.9, 2, 4, 3
FLUSH = 1 << 21

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_U = np.uint64


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the e-mail pattern, from each ``@`` outwards (a run without one costs nothing)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def digits_of(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value that names the entity), by start, then kind."""
    out = [(s, 0, e, text[s:e].lower()) for s, e in emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end(), ".".join(p or "0" for p in parts)))
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), digits))
    for m in _PHONE.finditer(text):
        digits = digits_of(m[0])
        if 9 <= len(digits) <= 15:
            out.append((m.start(), 3, m.end(), digits))
    return sorted(out)


def entity(kind: int, value: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


# ---------------------------------------------------------------- terms

class Terms:
    """The terms of a piece of text: hash, hash of the prefix (own hash for short terms), code-point span."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        low = LOWER[data]
        starts, ends, first = word_spans(low, offs, NON_WORD)
        lead = (data & 0xC0) != 0x80
        place = np.concatenate(([0], np.cumsum(lead)))
        at = np.append(np.flatnonzero(lead), len(data))      # byte of every code point
        row = row_of(first)
        keep = place[ends] - place[starts] >= LEAST_TERM
        starts, ends, self.row = starts[keep], ends[keep], row[keep]
        short = at[np.minimum(place[starts] + PREFIX, len(at) - 1)] if len(at) else ends
        self.longer = short < ends
        self.hash = span_hash(low, starts, ends)
        self.prefix = np.where(self.longer, mix64(span_hash(low, starts, np.minimum(short, ends)) ^ _U(PREFIX)), self.hash)
        origin = place[offs[:-1]][self.row]
        self.start, self.end = place[starts] - origin, place[ends] - origin


def outside(start: np.ndarray, end: np.ndarray, spans: list[tuple]) -> np.ndarray:
    """Which terms touch none of the base spans (sorted by start)."""
    s = np.array([x[0] for x in spans])
    reach = np.maximum.accumulate(np.array([x[2] for x in spans]))
    before = np.searchsorted(s, end, "left")          # spans that start before the term ends
    return (before == 0) | (reach[before - 1] <= start)


def contexts(spans: list[tuple], start: np.ndarray, t: np.ndarray, p: np.ndarray, longer: np.ndarray) -> dict[str, np.ndarray]:
    """(e, t, p, low, high): each entity with the terms and prefixes near it, and the least and greatest context hash of a term;
    t = null stands for the entity alone."""
    who = np.array([entity(x[1], x[3]) for x in spans], np.int64)
    sides = np.concatenate(([0], t, [0])).astype(_U)
    ctx = as_signed(mix64(sides[:-2] * _U(0x9E3779B97F4A7C15) + sides[2:]))
    left, right = np.searchsorted(start, [x[0] for x in spans]), np.searchsorted(start, [x[2] for x in spans])
    k = np.arange(WINDOW)
    near = np.concatenate((left[:, None] - 1 - k, right[:, None] + k), axis=1)
    near = np.where((k.size > 0) & (near >= 0) & (near < len(t)), near, -1)
    near[:, :WINDOW] = np.where(near[:, :WINDOW] < left[:, None], near[:, :WINDOW], -1)
    span, col = np.nonzero(near >= 0)
    idx = near[span, col]
    e = who[span]
    order = np.lexsort((ctx[idx], as_signed(t[idx]), e))
    e, idx = e[order], idx[order]
    names = as_signed(t[idx])
    lead = np.flatnonzero(np.concatenate(([True], (e[1:] != e[:-1]) | (names[1:] != names[:-1])))) if len(e) else np.zeros(0, np.int64)
    last = np.append(lead[1:], len(e)) - 1 if len(e) else lead
    te, tt, tp, tl = e[lead], names[lead], as_signed(p[idx[lead]]), longer[idx[lead]]
    low, high = ctx[idx[lead]], ctx[idx[last]]
    pe, pp = te[tl], tp[tl]
    pairs = np.unique(np.stack((pe, pp), axis=1), axis=0) if len(pe) else np.zeros((0, 2), np.int64)
    alone = np.unique(who)
    n, m, a = len(te), len(pairs), len(alone)
    zero = np.zeros(m + a, np.int64)
    return {"e": np.concatenate((te, pairs[:, 0], alone)), "t": np.concatenate((tt, pairs[:, 1], np.zeros(a, np.int64))),
            "alone": np.concatenate((np.zeros(n + m, bool), np.ones(a, bool))),
            "p": np.concatenate((np.where(tl, tp, 0), zero)), "longer": np.concatenate((tl, np.zeros(m + a, bool))),
            "low": np.concatenate((low, zero)), "high": np.concatenate((high, zero))}


SPAN = "struct<kind:string,start:int,end:int>"
NEAR = "array<struct<e:long,t:long,p:long,low:long,high:long>>"
TERM = "array<struct<t:long,start:int,end:int>>"
_NEAR = pa.list_(pa.struct([(c, pa.int64()) for c in ("e", "t", "p", "low", "high")]))
_TERM = pa.list_(pa.struct([("t", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def candidates(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Texts with a digit or an ``@``; no other text has a base span."""
    mark = np.concatenate(([0], np.cumsum(((data >= 0x30) & (data <= 0x39)) | (data == 0x40))))
    return np.flatnonzero(mark[offs[1:]] > mark[offs[:-1]])


def text_of(data: np.ndarray, offs: np.ndarray, i: int) -> str:
    return data[offs[i]:offs[i + 1]].tobytes().decode("utf-8", "replace")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k1, k2, base, near, terms) of every document; the lists are empty where there is no base span."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in pieces(batch, "t"):
                n = len(offs) - 1
                base, near, terms = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
                for i in candidates(data, offs):
                    spans = base_spans(text_of(data, offs, i))
                    if not spans:
                        continue
                    base[i] = [{"kind": BASE[k], "start": s, "end": e} for s, k, e, _ in spans]
                    w = Terms(data[offs[i]:offs[i + 1]], np.array([0, offs[i + 1] - offs[i]]))
                    free = outside(w.start, w.end, spans)
                    start, end, t = w.start[free], w.end[free], w.hash[free]
                    c = contexts(spans, start, t, w.prefix[free], w.longer[free])
                    near[i] = pa.StructArray.from_arrays([
                        pa.array(c["e"]), pa.array(c["t"], mask=c["alone"]), pa.array(c["p"], mask=~c["longer"]),
                        pa.array(c["low"]), pa.array(c["high"])], ["e", "t", "p", "low", "high"]).to_pylist()
                    terms[i] = pa.StructArray.from_arrays([pa.array(as_signed(t)), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                                                          ["t", "start", "end"]).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), part.column("k1"), part.column("k2"), pa.array(base, _SPAN), pa.array(near, _NEAR), pa.array(terms, _TERM)],
                    [id_col, "k1", "k2", "base", "near", "terms"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), text.alias("t"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(find, f"`{id_col}` {kind}, k1 long, k2 long, base array<{SPAN}>, near {NEAR}, terms {TERM}")


def term_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(t, n): documents that hold each term or prefix, over the whole corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            names, at = np.unique(np.concatenate([w[0] for w in waiting]), return_inverse=True)
            return names, np.bincount(at, np.concatenate([w[1] for w in waiting]), len(names)).astype(np.int64)

        def batch_of(names: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(as_signed(names)), pa.array(n)], ["t", "n"])

        for batch in batches:
            for _, data, offs in pieces(batch, "t"):
                w = Terms(data, offs)
                free = np.ones(len(w.row), bool)
                for i in candidates(data, offs):
                    spans = base_spans(text_of(data, offs, i))
                    if spans:
                        lo, hi = np.searchsorted(w.row, (i, i + 1))
                        free[lo:hi] = outside(w.start[lo:hi], w.end[lo:hi], spans)
                row = w.row[free].astype(_U) * _U(0xC2B2AE3D27D4EB4F)
                for names, use in ((w.hash[free], slice(None)), (w.prefix[free], w.longer[free])):
                    names = names[use]
                    _, once = np.unique(mix64(names + row[use]), return_index=True)
                    waiting.append(np.unique(names[once], return_counts=True))
                if sum(len(x[0]) for x in waiting) > FLUSH:
                    waiting = [merged()]
                    if len(waiting[0][0]) > FLUSH // 2:
                        yield batch_of(*waiting.pop())
        if waiting:
            yield batch_of(*merged())

    found = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(count, "t long, n long")
    return found.groupBy("t").agg(F.sum("n").alias("n"))


def disclosing(found: DataFrame, frequency: DataFrame, n_docs: int) -> DataFrame:
    """(e, t, kind): terms beyond the threshold and what becomes of them."""
    pairs = found.select(F.explode("near").alias("x")).select("x.*").groupBy("e", "t").agg(
        F.count("*").alias("both"), F.max("p").alias("p"), F.min("low").alias("low"), F.max("high").alias("high"))
    pairs = written(pairs, "pairs")
    alone = pairs.where("t IS NULL").select("e", F.col("both").alias("own"))

    def discloses(both: str, term: str) -> Column:
        pmi = F.log2(F.lit(float(n_docs)) * F.col(both) / (F.col("own") * F.col(term)))
        ic = F.log2(F.lit(float(n_docs)) / F.col("own"))
        return (ic > 0) & (pmi >= DISCLOSURE * ic)

    # contexts are hashes: the least and the greatest differ if there are two
    seen = pairs.where((F.col("t").isNotNull()) & (F.col("low") != F.col("high")))
    hot = (seen.join(alone, "e").join(frequency.withColumnRenamed("n", "held"), "t").where(discloses("both", "held"))
               .select("e", "t", "p", "own"))
    prefix = pairs.where("t IS NOT NULL").select("e", F.col("t").alias("p"), F.col("both").alias("p_both"))
    judged = (hot.join(prefix, ["e", "p"], "left").join(frequency.select(F.col("t").alias("p"), F.col("n").alias("p_held")), "p", "left"))
    return judged.select("e", "t", F.when(F.col("p").isNull() | discloses("p_both", "p_held"), REMOVED).otherwise(GENERAL).alias("kind"))


def rank_of(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k1, k2, base, spans) of every document; ``spans`` are base spans and disclosing terms by start, then kind."""
    found = written(scan(docs, id_col, text_col), "found")
    frequency = written(term_documents(docs, text_col), "frequency")
    with collecting([frequency]) as steps:
        terms = disclosing(found, frequency, found.count())
    hits = written(terms, "disclosing")
    for step in steps:
        discard(step)
    some = found.where(F.size("base") > 0).groupBy("k1", "k2").agg(F.first("terms").alias("terms"), F.first("near").alias("near"))
    names = some.select("k1", "k2", F.explode("near").alias("x")).where("x.t IS NULL").select("k1", "k2", "x.e")
    held = some.select("k1", "k2", F.explode("terms").alias("x")).select("k1", "k2", "x.*")
    # a term is flagged for few entities, so the join on the term comes first
    flagged = held.join(hits, "t").join(names, ["k1", "k2", "e"], "left_semi")
    added = flagged.groupBy("k1", "k2", "start", "end").agg(F.max("kind").alias("kind"))   # removal before generalisation
    added = added.groupBy("k1", "k2").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    base = found.select(id_col, "k1", "k2", "base")
    none = F.array().cast(f"array<{SPAN}>")
    asked = base.where(F.size("base") > 0).join(added, ["k1", "k2"], "left").select(id_col, "k1", "k2", "base", "added")
    every = asked.unionByName(base.where(F.size("base") == 0).withColumn("added", none))
    keyed = F.transform(F.concat("base", F.coalesce("added", none)), lambda s: F.struct(
        s["start"].alias("start"), rank_of(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return every.select(id_col, "k1", "k2", "base", ordered.alias("spans"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digest columns per document."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans_of(docs, id_col, text_col).select(
        id_col, *[count(k) for k in BASE], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with base spans replaced by their kind, disclosing terms by their prefix and ``*`` or by ``[TERM]``. All
    columns and all rows stay."""
    spans = spans_of(docs, id_col, text_col).where(F.size("spans") > 0).groupBy("k1", "k2").agg(F.first("spans").alias("spans"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), F.col(text_col).alias("text"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [masked(t, s) if s else t for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, pa.string())], ["doc", "text"])

    done = rows.join(spans, ["k1", "k2"], "left").select("doc", "text", "spans")
    kind = rows.schema["doc"].dataType.simpleString()
    clean = done.where("spans IS NULL").select("doc", "text").unionByName(
        done.where("spans IS NOT NULL").mapInArrow(replace, f"doc {kind}, text string"))
    return clean.select(*[(F.col("text") if f == text_col else F.col("doc")[f]).alias(f) for f in docs.columns])


def masked(text: str, spans: list[dict]) -> str:
    """Text with its spans replaced; spans that overlap are one, named by the first."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out.append(text[at:s["start"]])
            out.append({GENERAL: text[s["start"]:s["start"] + PREFIX] + "*", REMOVED: "[TERM]"}.get(s["kind"], f"[{s['kind'].upper()}]"))
        at = max(at, s["end"])
    return "".join(out) + text[at:]
