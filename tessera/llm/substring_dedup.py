"""Substring dedup by recompression.

A text is a sequence of word names. A recompression round replaces every maximal
run of one name by a name for (name, length) (first round), and every pair of a 'left'
name followed by a 'right' name by a name for the pair; a name is left or
right by one bit of its hash. Names are hashes of what they stand for, so all tasks give the same
name to the same content and no dictionary has to be exchanged. Whether and how
a symbol is formed depends only on its neighbours, so equal substrings are
parsed into the same symbols except near their ends; for each symbol we
keep the extent of words that decided it.

Every window of 13 words is represented by one symbol whose deciding extent lies inside it: the longest
symbol (in characters, then by name) of the second level, or else of the first level, or else a
word. Equal windows thus have the same representative. The steps:

1. parse all documents; write the representatives and the windows they stand for;
2. group by name: names that occur in two different texts are shared;
3. join the shared names back: only windows that they represent can repeat;
4. hash just these windows (128 bits), group them, and keep for each the smallest document;
5. a word is removed if it lies in a window that also starts in a document with
   a smaller id.

Identical texts are one content, represented by its smallest doc_id; further
copies of 13 words or more lose all words. Names, windows and contents of
any frequency are grouped with partial sums and joined by key, where Spark splits
skewed keys.

Cases: null and empty texts have no words; a null doc_id counts as larger than
every id; rows that share a doc_id do not remove each other's words; texts under 13
words lose nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textcols as tc
from tessera.llm.components import discard, release, written

WINDOW = 13
_U = np.uint64
_FAR = np.int64(1) << 40
_SPLIT = [_U(0x2545F4914F6CDD1D), _U(0x9FB21C651E98DF25)]


class Symbols:
    """Parallel arrays: name, row, first word, end word, deciding extent [lo, hi) and characters."""

    __slots__ = ("name", "row", "start", "end", "lo", "hi", "chars")

    def __init__(self, name, row, start, end, lo, hi, chars):
        self.name, self.row, self.start, self.end = name, row, start, end
        self.lo, self.hi, self.chars = lo, hi, chars

    def __len__(self) -> int:
        return len(self.name)

    def grouped(self, first: np.ndarray, last: np.ndarray, name, lo, hi) -> "Symbols":
        """Symbols that cover the items first..last (inclusive) each."""
        total = np.r_[0, np.cumsum(self.chars)]
        return Symbols(name, self.row[first], self.start[first], self.end[last], lo, hi,
                       total[last + 1] - total[first])


def level0(words: np.ndarray, row: np.ndarray, chars: np.ndarray) -> Symbols:
    at = np.arange(len(words), dtype=np.int64)
    return Symbols(words, row, at, at + 1, at, at + 1, chars)


def name_runs(x: Symbols) -> Symbols:
    """Maximal runs of two or more equal names become one symbol."""
    n = len(x)
    if not n:
        return x
    new = np.r_[True, (x.name[1:] != x.name[:-1]) | (x.row[1:] != x.row[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], n] - 1
    length = last - first + 1
    run = length > 1
    name = x.name[first].copy()
    name[run] = tc.mix64(name[run] * _U(0xD1342543DE82EF95) + length[run].astype(_U))
    # that a run (or a single name) ends here is known only from its neighbours
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
    has_before = (first > 0) & (x.row[before] == x.row[first])
    has_after = (last < n - 1) & (x.row[after] == x.row[last])
    lo = np.where(has_before, np.minimum(x.lo[before], x.lo[first]), -_FAR)
    hi = np.where(has_after, np.maximum(x.hi[after], x.hi[last]), _FAR)
    return x.grouped(first, last, name, lo, hi)


def name_pairs(x: Symbols, level: int) -> Symbols:
    """Every left name followed by a right name becomes one symbol."""
    n = len(x)
    if not n:
        return x
    left = (tc.mix64(x.name ^ _SPLIT[level]) & _U(1)).astype(bool)
    together = np.r_[x.row[1:] == x.row[:-1], False]
    pair = np.r_[left[:-1] & ~left[1:], False] & together
    second = np.r_[False, pair[:-1]]
    first = np.flatnonzero(~second)
    paired = pair[first]
    last = first + paired
    name = x.name[first].copy()
    a, b = first[paired], last[paired]
    name[paired] = tc.mix64(x.name[a] * _U(0xF1357AEA2E62A9C5) ^ tc.mix64(x.name[b]) + _U(level + 1))
    before, after = np.maximum(first - 1, 0), np.minimum(first + 1, n - 1)
    has_before = (first > 0) & (x.row[before] == x.row[first])
    has_after = (first < n - 1) & (x.row[after] == x.row[first])
    # a single left name was seen not to precede a right one, and the reverse
    lo_single = np.where(left[first], x.lo[first],
                         np.where(has_before, np.minimum(x.lo[before], x.lo[first]), -_FAR))
    hi_single = np.where(left[first], np.where(has_after, np.maximum(x.hi[after], x.hi[first]), _FAR), x.hi[first])
    lo = np.where(paired, np.minimum(x.lo[first], x.lo[last]), lo_single)
    hi = np.where(paired, np.maximum(x.hi[first], x.hi[last]), hi_single)
    return x.grouped(first, last, name, lo, hi)


def levels(words: np.ndarray, row: np.ndarray, chars: np.ndarray) -> list[Symbols]:
    """Symbols of the words, of the first and of the second round."""
    x = level0(words, row, chars)
    first = name_pairs(name_runs(x), 0)
    return [x, first, name_pairs(first, 1)]


def _widest(rank: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the largest rank in [lo, hi) (not empty; the first of equals)."""
    best = np.arange(len(rank))
    table = [best]
    span = 1
    top = int((hi - lo).max())
    while span * 2 <= top:
        a, b = table[-1][:-span], table[-1][span:]
        table.append(np.where(rank[b] > rank[a], b, a))
        span *= 2
    k = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.empty(len(lo), np.int64)
    for i, t in enumerate(table):
        on = k == i
        a, b = t[lo[on]], t[hi[on] - (1 << i)]
        out[on] = np.where(rank[b] > rank[a], b, a)
    return out


def representatives(words: np.ndarray, bounds: np.ndarray, chars: np.ndarray, window: int = WINDOW
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, key, position) for every window: the key names its
    representative symbol, the position is that symbol's first word (shifted by its level)."""
    row = tc.row_of(bounds)
    total = len(words)
    at = np.flatnonzero(np.arange(window, total + window) <= bounds[1:][row])
    key = np.zeros(len(at), _U)
    place = np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    for level, x in reversed(list(enumerate(levels(words, row, chars)))):
        if not len(todo):
            break
        idx = np.flatnonzero((x.lo >= 0) & (x.hi <= total))
        if not len(idx):
            continue
        # extents are in order, so counting replaces searching
        begun = np.cumsum(np.bincount(x.lo[idx] + 1, minlength=total + 2))
        ended = np.cumsum(np.bincount(x.hi[idx], minlength=total + 2))
        w = at[todo]
        lo, hi = begun[w], ended[w + window]
        some = lo < hi
        if some.any():
            # longer symbols first, then by name
            rank = (np.minimum(x.chars[idx], 255).astype(_U) << _U(56)) | (x.name[idx] >> _U(8))
            best = idx[_widest(rank, lo[some], hi[some])]
            key[todo[some]] = tc.mix64(x.name[best] + _U(level))
            place[todo[some]] = x.start[best] * 3 + level
        todo = todo[~some]
    return at, key, place


def _words(data: np.ndarray, offs: np.ndarray):
    starts, ends, bounds = tc.word_spans(data, offs, tc.WHITE_SPACE)
    return tc.span_hash(data, starts, ends), bounds, ends - starts


def parse(contents: DataFrame, window: int) -> DataFrame:
    """(c1, names array<long>, firsts array<int>, counts array<int>): the representatives of each text in
    order, and the windows that each stands for (a first one and a number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, "text"):
                words, bounds, chars = _words(data, offs)
                at, key, place = representatives(words, bounds, chars, window)
                if not len(at):
                    continue
                row = tc.row_of(bounds)[at]
                new = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(place) != 0)])
                count = np.diff(np.r_[new, len(at)])
                row, first = row[new], at[new]
                cut = np.flatnonzero(np.r_[True, np.diff(row) != 0])
                cuts = np.r_[cut, len(row)]
                yield pa.RecordBatch.from_arrays([
                    rows.column("c1").take(pa.array(row[cut])),
                    tc.list_column(tc.as_signed(key[new]), cuts, pa.int64()),
                    tc.list_column((first - bounds[row]).astype(np.int32), cuts, pa.int32()),
                    tc.list_column(count.astype(np.int32), cuts, pa.int32())], ["c1", "names", "firsts", "counts"])

    return contents.select("c1", "text").mapInArrow(
        run, "c1 long, names array<long>, firsts array<int>, counts array<int>")


def shared_windows(flagged: DataFrame, window: int) -> DataFrame:
    """(h1, h2, d, x): the listed windows of rows (d, c1, text, spans);
    x holds the window's first word and the low half of c1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, "text"):
                words, bounds, _ = _words(data, offs)
                lists = rows.column("spans")
                size = np.diff(lists.offsets.to_numpy())
                spans = lists.flatten()
                count = spans.field("count").to_numpy(zero_copy_only=False).astype(np.int64)
                first = spans.field("first").to_numpy(zero_copy_only=False) + np.repeat(bounds[:-1], size)
                row = np.repeat(np.repeat(np.arange(len(size)), size), count)
                at = np.repeat(first, count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                if not len(at):
                    continue
                fits = at + window <= bounds[1:][row]
                at, row = at[fits], row[fits]
                h1 = tc.window_hash(words, window)[at]
                h2 = tc.window_hash(tc.mix64(words ^ _U(0x5851F42D4C957F2D)), window)[at]
                low = rows.column("c1").to_numpy(zero_copy_only=False)[row] & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays([
                    pa.array(tc.as_signed(h1)), pa.array(tc.as_signed(h2)), rows.column("d").take(pa.array(row)),
                    pa.array(((at - bounds[row]) << 32) | low)], ["h1", "h2", "d", "x"])

    return flagged.select("d", "c1", "text", "spans").mapInArrow(run, "h1 long, h2 long, d long, x long")


def remove(docs: DataFrame, window: int, kind: str) -> DataFrame:
    """Kept text and counts of rows (doc_id, text, copy, starts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, "text"):
                copies = rows.column("copy").to_pylist()
                starts = rows.column("starts").to_pylist()
                counts, removed, kept_text = [], [], []
                for i, (a, b) in enumerate(zip(offs[:-1], offs[1:])):
                    words = data[a:b].tobytes().split()
                    gone = 0
                    counts.append(len(words))
                    if copies[i] and len(words) >= window:
                        gone, words = len(words), []
                    elif starts[i]:
                        cover = np.zeros(len(words) + 1, np.int32)
                        s = np.unique(starts[i])
                        np.add.at(cover, s, 1)
                        np.add.at(cover, s + window, -1)
                        keep = np.cumsum(cover[:-1]) == 0
                        gone = len(words) - int(keep.sum())
                        words = [words[j] for j in np.flatnonzero(keep)]
                    removed.append(gone)
                    kept_text.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in kept_text]),
                    pa.array(kept_text, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return docs.select("doc_id", "text", "copy", "starts").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every document."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("c1"),
        F.xxhash64(F.lit(1), text).alias("c2"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("d"))
    contents = written(base.groupBy("c1", "c2").agg(F.min("d").alias("d")), "contents")

    parsed = written(parse(base, window), "parsed")
    names = parsed.select("c1", F.explode("names").alias("name"))
    spread = names.groupBy("name").agg(F.min("c1").alias("a"), F.max("c1").alias("b"))
    shared = written(spread.where("a <> b").select("name"), "shared")
    release(spark)

    zipped = parsed.select("c1", F.explode(F.arrays_zip("names", "firsts", "counts")).alias("z")).select(
        "c1", F.col("z.names").alias("name"), F.struct(
            F.col("z.firsts").alias("first"), F.col("z.counts").alias("count")).alias("span"))
    hits = zipped.join(shared, "name", "left_semi")
    spans = hits.groupBy("c1").agg(F.collect_set("span").alias("spans"))
    spans = written(spans.join(contents.select("c1", "d"), "c1").select("c1", "d", "spans"), "spans")
    discard(parsed)
    release(spark)

    flagged = base.select("d", "c1", "text").join(spans, ["c1", "d"])
    windows = written(shared_windows(flagged, window), "windows")
    release(spark)
    least = windows.groupBy("h1", "h2").agg(F.min("d").alias("least"), F.max("d").alias("most"))
    again = written(least.where("least < most").select("h1", "h2", "least"), "again")
    release(spark)
    covered = windows.join(again, ["h1", "h2"]).where("least < d")
    low = F.col("x").bitwiseAND(F.lit(0xFFFFFFFF)).alias("low")
    starts = written(covered.groupBy("d", low).agg(
        F.collect_set(F.shiftright("x", 32).cast("int")).alias("starts")), "starts")
    for step in (windows, again, shared, spans):
        discard(step)
    release(spark)

    mine = base.select("d", "c1", "c2").distinct().join(
        contents.withColumnRenamed("d", "least"), ["c1", "c2"]).select(
        "d", "c1", "c2", F.col("c1").bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"),
        (F.col("d") > F.col("least")).alias("copy"))
    mine = mine.join(starts, ["d", "low"], "left").where("copy OR starts IS NOT NULL").drop("low")
    kind = docs.schema[id_col].dataType.simpleString()
    out = remove(base.join(mine, ["d", "c1", "c2"], "left"), window, kind)
    return out.withColumnRenamed("doc_id", id_col)
