"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Every paragraph (line) is hashed to a wide vector; a document's fingerprint is
the sum of its paragraphs' vectors, lane by lane, modulo a power of two. So
the order of paragraphs does not matter, and a paragraph is inserted or deleted
by adding or subtracting its vector (:func:`combine`).

A paragraph's vector has two parts:

* ``EXACT`` lanes modulo 2**64, filled with the paragraph's BLAKE2b digest: equal sums mean
  equal multisets (256 bits);
* ``WIDTH`` lanes modulo 2**32, in which every pair of neighbouring words of the paragraph adds
  +1 or -1 to one lane (a count sketch). The sum over paragraphs is linear
  too, and the squared distance of two such sketches estimates how many word pairs
  differ, which gives the likeness (:func:`likeness`, 0 to 1).

Cases: null and empty texts are the empty multiset and have the same, all-zero
fingerprint; empty lines add nothing; a line of one word counts that
word as its pair. The likeness of two empty documents is 1, of an empty and a non-empty one 0.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import textcols as tc

EXACT = 4
WIDTH = 256
_NEWLINE = np.zeros(256, bool)
_NEWLINE[0x0A] = True


def exact_lanes(texts: list[bytes]) -> np.ndarray:
    """(len(texts), EXACT) sums of the paragraph digests."""
    out = np.zeros((len(texts), EXACT), np.uint64)
    digest = hashlib.blake2b
    for i, text in enumerate(texts):
        parts = b"".join(digest(line, digest_size=EXACT * 8).digest() for line in text.split(b"\n") if line)
        if parts:
            out[i] = np.frombuffer(parts, np.uint64).reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
    return out


def sketch_lanes(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts, WIDTH) count sketch of the word pairs within paragraphs."""
    n = len(offs) - 1
    starts, ends, bounds = tc.word_spans(data, offs, tc.WHITE_SPACE)
    if not len(starts):
        return np.zeros((n, WIDTH), np.int64)
    words = tc.span_hash(data, starts, ends)
    row = tc.row_of(bounds)
    lines = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_NEWLINE[data], out=lines[1:])
    line = lines[starts]
    joined = (line[1:] == line[:-1]) & (row[1:] == row[:-1])
    follows, leads = np.r_[False, joined], np.r_[joined, False]
    alone = np.flatnonzero(~follows & ~leads)
    first = np.flatnonzero(joined)
    pairs = tc.mix64(words[first] * np.uint64(0x9E3779B97F4A7C15) ^ words[first + 1])
    items = np.r_[pairs, tc.mix64(words[alone])]
    rows = np.r_[row[first], row[alone]]
    lane = (items % np.uint64(WIDTH)).astype(np.int64)
    sign = 1.0 - 2.0 * ((items >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    return np.bincount(rows * WIDTH + lane, sign, n * WIDTH).reshape(n, WIDTH).astype(np.int64)


def pack(exact: np.ndarray, sketch: np.ndarray) -> list[str]:
    """Fingerprints in base 64: the exact lanes, then the sketch lanes."""
    low = sketch.astype(np.int32)
    return [base64.b64encode(a.tobytes() + b.tobytes()).decode() for a, b in zip(exact, low)]


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[:EXACT * 8], np.uint64), np.frombuffer(raw[EXACT * 8:], np.int32)


def fingerprint_text(text: str | None) -> str:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return pack(exact_lanes([data.tobytes()]), sketch_lanes(data, np.array([0, len(data)])))[0]


def combine(a: str, b: str, sign: int = 1) -> str:
    """Fingerprint of the union (sign 1) or of the first less the second (sign -1)."""
    (ea, sa), (eb, sb) = unpack(a), unpack(b)
    if sign > 0:
        return pack((ea + eb)[None], (sa + sb)[None])[0]
    return pack((ea - eb)[None], (sa - sb)[None])[0]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - |a-b|^2 / (|a|^2 + |b|^2) of sketch rows, cut to 0..1; 1 for two empty ones."""
    a, b = a.astype(np.int32).astype(np.float64), b.astype(np.int32).astype(np.float64)
    total = (a * a).sum(axis=1) + (b * b).sum(axis=1)
    apart = ((a - b) ** 2).sum(axis=1)
    return np.where(total > 0, np.clip(1.0 - apart / np.where(total > 0, total, 1.0), 0.0, 1.0), 1.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every document, in one pass without a shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, text_col):
                texts = [data[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:])]
                yield pa.RecordBatch.from_arrays([
                    rows.column(id_col), pa.array([len(t.decode()) for t in texts], pa.int64()),
                    pa.array(pack(exact_lanes(texts), sketch_lanes(data, offs)))], ["id", "n_chars", "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


# -- comparison with the neighbouring document -------------------------------

RANGE_BYTES = 8 << 20


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by as many (or all) of the first of ``following``."""
    cut = len(text) // 2
    return text[:len(text) - cut] + following[:cut]


def count_under(values: list[int], x: Column) -> Column:
    """How many of the descending ``values`` are at least ``x``, looked up in two steps of about the square root of their number."""
    wide = max(1, math.isqrt(len(values)))
    groups = [values[i:i + wide] for i in range(0, len(values), wide)]
    literal = F.lit([[int(v) for v in g] for g in groups])
    heads = F.lit([int(g[-1]) for g in groups])
    full = F.size(F.filter(heads, lambda c: c >= x))      # groups whose last value is not smaller
    within = F.size(F.filter(F.coalesce(F.get(literal, full), F.array().cast("array<bigint>")), lambda c: c >= x))
    return F.least(full * wide + within, F.lit(len(values)))   # the last group may be shorter


def with_next(docs: DataFrame, id_col: str, text_col: str, buckets: int | None = None) -> DataFrame:
    """(doc_id, text, bucket, edge): rows dealt to ranges of descending ids; each range
    also holds, as its last row (edge 1), the row that follows it. An id of many rows, and null, take
    several ranges, cut by the text's hash; only rows of one id and one text stay together.

    Only the ids (of ties, also the texts' hashes) are looked at to place the ranges, and the driver holds one
    id per range of ``RANGE_BYTES`` of text (or ``buckets`` ranges). The texts are shuffled once.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    without, rows, size = base.select(F.count_if(F.col("doc_id").isNull()), F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    buckets = buckets or max(1, -(-(size or 0) // RANGE_BYTES))
    points = [i / buckets for i in range(1, buckets)]
    found = base.select(F.percentile_approx("doc_id", points, max(10_000, 20 * buckets))).first()[0] if points else []
    # an id that is met several times among the points has that many times the rows of a range: it is cut into as many
    # by the text's hash, in whose order its rows are, and the smaller ids of its range follow them
    many = Counter(found or [])
    tops = [None, *sorted(many, reverse=True)]
    slices = [0, *(many[c] if many[c] > 1 else 0 for c in tops[1:])]
    starts = [0, *itertools.accumulate(n + 1 for n in slices)]
    # null ids come last, in ranges of their own, below every id
    nulls = max(1, -(-without * buckets // max(rows, 1)))

    def literal(values: list[int]) -> Column:
        return F.lit([int(v) for v in values]) if values else F.array().cast("array<bigint>")

    def part(n: Column | int) -> Column:
        """Which of n equal parts of the hashes the text's is in."""
        share = F.xxhash64("text").cast("double") / 2.0**64 + 0.5
        return F.least(F.floor(share * n), F.lit(n) - 1)

    nth = count_under(tops[1:], F.col("doc_id")) + 1 if many else F.lit(1)
    cut = F.element_at(literal(slices), nth)
    tied = (cut > 0) & (F.col("doc_id") == F.get(literal(tops[1:]), nth - 2))
    within = F.when(tied, part(cut)).otherwise(cut) if any(slices) else F.lit(0)
    place = F.when(F.col("doc_id").isNull(), F.lit(starts[-1]) + (part(nulls) if nulls > 1 else F.lit(0))).otherwise(
        F.element_at(literal(starts), nth) + within)
    dealt = base.withColumn("bucket", place.cast("int"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    heads = (dealt.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect())
    # the head of a range is the first of its largest id; ties are ordered by text
    firsts = dealt.join(F.broadcast(docs.sparkSession.createDataFrame(
        [(h.bucket, h["head"]) for h in heads], "bucket int, head long")), "bucket").where(
        F.col("doc_id").eqNullSafe(F.col("head"))).drop("head")
    firsts = firsts.withColumn("rk", F.row_number().over(Window.partitionBy("bucket").orderBy(*order))).where("rk = 1")
    held = [h.bucket for h in heads]
    if not held:
        out = dealt.withColumn("edge", F.lit(0))
        out._ranges = 1
        return out
    # the first range follows the last
    before = F.broadcast(docs.sparkSession.createDataFrame([(b, held[i - 1]) for i, b in enumerate(held)], "bucket int, before int"))
    edges = firsts.join(before, "bucket").select("doc_id", "text", F.col("before").alias("bucket"), F.lit(1).alias("edge"))
    out = dealt.withColumn("edge", F.lit(0)).unionByName(edges)
    out._ranges = max(1, len(held))
    return out


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 buckets: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    dealt = with_next(docs, id_col, text_col, buckets)
    dealt = dealt.repartition(dealt._ranges, "bucket").sortWithinPartitions(
        "bucket", "edge", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    out = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")

    def lanes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offs = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
        return exact_lanes(raw), sketch_lanes(data, offs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[int, int | None, str] | None = None  # the row whose next one is still to come
        for batch in batches:
            for rows, _, _ in tc.pieces(batch, "text"):
                seq = list(zip(rows.column("bucket").to_pylist(), rows.column("doc_id").to_pylist(),
                               rows.column("text").to_pylist()))
                seq = ([kept] if kept else []) + seq
                kept = seq[-1]
                pairs = [(a, b) for a, b in zip(seq, seq[1:]) if a[0] == b[0]]
                if not pairs:
                    continue
                at = np.array([i for i in range(len(seq) - 1) if seq[i][0] == seq[i + 1][0]])
                own = [a[2] for a, _ in pairs]
                changed = [edited(a[2], b[2]) for a, b in pairs]
                e, s = lanes([x[2] for x in seq])
                ee, es = lanes(changed)
                yield pa.RecordBatch.from_arrays([
                    pa.array([a[1] for a, _ in pairs], pa.int64()),
                    pa.array([len(t) for t in own], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                    pa.array(pack(e[at], s[at])), pa.array(pack(ee, es)),
                    pa.array(likeness(s[at], es)), pa.array(likeness(s[at], s[at + 1])),
                ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    "near_edited", "near_next"])

    return dealt.select("bucket", "doc_id", "text").mapInArrow(run, out)
