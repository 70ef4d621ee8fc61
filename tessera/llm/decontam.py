"""Benchmark decontamination with a distributed positional inverted index.

1. One pass counts the documents that hold each word of the test items
   (partial sums leave the tasks, one row per word and task).
2. Every phrase (13 consecutive item words, or the whole of a shorter item) is
   represented by its ``rarest`` rarest words.
3. A second pass stores postings of these words, (word, document, positions), as
   the index in the shared folder.
4. The lists are intersected from the rarest word on: a posting at position p of
   the word at item offset o lies on alignment p - o; an alignment on
   which all representatives of a phrase meet is a candidate, and two or
   more of them within ``slop`` words are a proximity match.
5. The candidate alignments of a document are compared word by word with its
   text, which gives the exact occurrences, the hit words and the items.

Items stay in Spark like the corpus: their words, phrases and representatives are tables keyed by item. Tasks that read texts
hold a Bloom filter of the wanted words, of ``FILTER_BITS`` bits whatever the benchmark's size; a join on the words removes what
passes by accident. A document is known by its id and the hash of its text, so rows without an id, or of one id, do not meet.

Cases: null and empty texts have no words, no hits and are not contaminated;
items without words are ignored; repeated documents are judged row by row;
an empty corpus or benchmark gives no hits; null item ids read as empty; repeated items count once. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import textcols as tc
from tessera.llm.components import written

WINDOW = 13
RAREST = 3
SLOP = 26
FILTER_BITS = 1 << 24
PROBES = (3, 29)     # shifts of a word's hash that give its bits


def _hash_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text plus total)."""
    low = tc.LOWER[data]
    starts, ends, bounds = tc.word_spans(low, offs, tc.NON_WORD)
    return tc.span_hash(low, starts, ends), bounds


def hash_text(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return _hash_words(data, np.array([0, len(data)]))[0]


KEY = ("doc_id", "tk")
ITEM = ("i1", "i2")


def item_words(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """(i1, i2, item, words) of the items with words, once for each id and text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, "text"):
                words, bounds = _hash_words(data, offs)
                yield pa.RecordBatch.from_arrays([rows.column("i1"), rows.column("i2"), rows.column("item"),
                                                  tc.list_column(tc.as_signed(words), bounds, pa.int64())], ["i1", "i2", "item", "words"])

    item, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (item_col, item_text))
    keyed = benchmark.select(F.xxhash64(item, text).alias("i1"), F.xxhash64(F.lit(1), item, text).alias("i2"), item.alias("item"), text.alias("text"))
    return keyed.dropDuplicates(["i1", "i2"]).mapInArrow(split, "i1 long, i2 long, item string, words array<long>").where(F.size("words") > 0)


def bloom(words: DataFrame) -> np.ndarray:
    """Bloom filter of a column ``word``: at most FILTER_BITS / 64 rows come to the driver."""
    h = F.col("word")
    at = words.select(F.explode(F.array(*[F.shiftrightunsigned(h, k).bitwiseAND(F.lit(FILTER_BITS - 1)) for k in PROBES])).alias("at"))
    one = at.select(F.shiftright("at", 6).alias("place"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int")).alias("bit"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in one.groupBy("place").agg(F.bit_or("bit").alias("bits")).collect():
        out[r.place] = r.bits
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def passes(bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which words may be in the filter."""
    mask = np.uint64(FILTER_BITS - 1)
    ok = bits[(words >> np.uint64(PROBES[0])) & mask]
    for k in PROBES[1:]:
        ok &= bits[(words >> np.uint64(k)) & mask]
    return ok


def document_frequency(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(word, n_docs) of the ``wanted`` words that some document holds."""
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(bloom(wanted)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.unpackbits(bits.value).view(bool)
        for batch in batches:
            for _, data, offs in tc.pieces(batch, text_col):
                words, bounds = _hash_words(data, offs)
                at = np.flatnonzero(passes(may, words))
                words, row = words[at], tc.row_of(bounds)[at]
                _, once = np.unique(tc.mix64(words ^ tc.mix64(row.astype(np.uint64) + np.uint64(1))), return_index=True)
                names, n = np.unique(words[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tc.as_signed(names)), pa.array(n, pa.int64())], ["word", "n"])

    found = docs.select(text_col).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n_docs"))
    return found.join(wanted, "word", "left_semi")


def representatives(items: DataFrame, frequency: DataFrame, window: int, rarest: int) -> DataFrame:
    """(i1, i2, places, needs): the rarest words of the phrases of each item, as array<struct<word,at>>, and the
    different sets of their offsets that one phrase has. Ties: the smaller hash, then the earlier word."""
    each = items.select(*ITEM, F.posexplode("words").alias("at", "word")).join(frequency, "word", "left")
    listed = each.groupBy(*ITEM).agg(F.sort_array(F.collect_list(F.struct(
        "at", F.coalesce("n_docs", F.lit(0)).alias("n"), "word"))).alias("w"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i1, i2, w in zip(*(batch.column(c) for c in ("i1", "i2", "w"))):
                n, word = (w.values.field(k).to_numpy() for k in (1, 2))
                size = min(window, len(word))
                rank = np.empty(len(word), np.int64)
                rank[np.lexsort((np.arange(len(word)), word.view(np.uint64), n))] = np.arange(len(word))
                rows = np.lib.stride_tricks.sliding_window_view(rank, size)
                first = np.argpartition(rows, min(rarest, size) - 1, axis=1)[:, :rarest] if rarest < size else np.tile(np.arange(size), (len(rows), 1))
                needs = np.unique(np.sort(first + np.arange(len(rows))[:, None], axis=1), axis=0)
                at = np.unique(needs)
                out.append({"i1": i1.as_py(), "i2": i2.as_py(), "needs": needs.tolist(),
                            "places": [{"word": int(word[a]), "at": int(a)} for a in at]})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("i1", pa.int64()), ("i2", pa.int64()), ("places", pa.list_(pa.struct([("word", pa.int64()), ("at", pa.int32())]))),
                    ("needs", pa.list_(pa.list_(pa.int32())))]))

    return listed.mapInArrow(choose, "i1 long, i2 long, places array<struct<word:long,at:int>>, needs array<array<int>>")


def postings(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """(word, doc_id, tk, positions): the positional lists of ``terms`` (a column ``word``)."""
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(bloom(terms)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.unpackbits(bits.value).view(bool)
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, "text"):
                words, bounds = _hash_words(data, offs)
                where = np.flatnonzero(passes(may, words))
                if not len(where):
                    continue
                row, term = tc.row_of(bounds)[where], words[where]
                order = np.lexsort((where, term, row))
                where, row, term = where[order], row[order], term[order]
                new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (term[1:] != term[:-1])])
                at = pa.array(row[new])
                yield pa.RecordBatch.from_arrays([
                    pa.array(tc.as_signed(term[new])), rows.column("doc_id").take(at), rows.column("tk").take(at),
                    tc.list_column((where - bounds[row]).astype(np.int32), np.r_[new, len(where)], pa.int32()),
                ], ["word", "doc_id", "tk", "positions"])

    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))
    found = named.mapInArrow(build, f"word long, doc_id {kind}, tk long, positions array<int>")
    return found.join(terms, "word", "left_semi")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


class BenchmarkIndex:
    """Positional index of a corpus over the words that represent the test items."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, rarest: int = RAREST):
        self.docs, self.id_col, self.text_col, self.window = docs, id_col, text_col, window
        self.items = written(item_words(benchmark, item_col, item_text), "items")
        wanted = self.items.select(F.explode("words").alias("word")).distinct()
        frequency = document_frequency(docs, text_col, wanted)
        self.plan = written(representatives(self.items, frequency, window, rarest), "phrases")
        terms = self.plan.select(F.explode("places.word").alias("word")).distinct()
        self.index = written(postings(docs, id_col, text_col, terms), "postings")

    def _listed(self) -> DataFrame:
        """(doc_id, tk, i1, i2, word, at, p): every place of a representative in the corpus."""
        places = self.plan.select(*ITEM, F.explode("places").alias("x")).select(*ITEM, "x.*")
        return self.index.select("word", *KEY, F.explode("positions").alias("p")).join(places, "word")

    def alignments(self) -> DataFrame:
        """(doc_id, tk, i1, i2, shift) on which all representatives of some phrase meet."""
        met = self._listed().groupBy(*KEY, *ITEM, (F.col("p") - F.col("at")).alias("shift")).agg(F.collect_set("at").alias("met"))
        hits = met.join(self.plan.select(*ITEM, "needs"), list(ITEM)).where(
            F.exists("needs", lambda need: F.size(F.array_except(need, "met")) == 0))
        return hits.select(*KEY, *ITEM, "shift")

    def proximity(self, slop: int = SLOP) -> DataFrame:
        """(doc_id, tk, item, p): places where two or more different representatives of
        an item stand within ``slop`` words, in any order; ``tk`` is the hash of the text."""
        near = Window.partitionBy(*KEY, *ITEM).orderBy("p").rangeBetween(-slop, 0)
        return (self._listed().withColumn("words", F.size(F.collect_set("word").over(near))).where("words >= 2")
                    .join(self.items.select(*ITEM, "item"), list(ITEM)).select(*KEY, "item", "p").distinct())

    def matches(self) -> DataFrame:
        """The rows of the corpus, as the struct ``doc``, with n_words, n_hit, items array<string> and the
        exact occurrences as spans array<struct<item,start,end>>."""
        window, id_col, text_col = self.window, self.id_col, self.text_col
        docs = self.docs.select(F.struct("*").alias("doc"))
        out = T.StructType([docs.schema["doc"], *T._parse_datatype_string(
            "n_words long, n_hit long, items array<string>, "
            "spans array<struct<item:string,start:int,end:int>>").fields])

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                doc = batch.column(0)
                texts = pa.RecordBatch.from_arrays([doc, doc.field(text_col), batch.column(1)], ["doc", "text", "found"])
                for rows, data, offs in tc.pieces(texts, "text"):
                    words, bounds = _hash_words(data, offs)
                    found = rows.column("found")
                    n_words = np.diff(bounds)
                    n_hit, names, spans = np.zeros(len(n_words), np.int64), [], []
                    for r in range(len(n_words)):
                        own = words[bounds[r]:bounds[r + 1]]
                        hit, item_ids, places = np.zeros(len(own), bool), set(), []
                        for x in (found[r] if found[r].is_valid else ()):
                            item, phrase = x["item"].as_py(), x["words"].values.to_numpy().view(np.uint64)
                            for shift in x["shifts"].as_py():
                                for s, e in occurrences(own, phrase, shift, window):
                                    hit[s:e] = True
                                    item_ids.add(item)
                                    places.append({"item": item, "start": s, "end": e})
                        n_hit[r] = hit.sum()
                        names.append(sorted(item_ids))
                        spans.append(sorted(places, key=lambda x: (x["start"], x["end"], x["item"])))
                    yield pa.RecordBatch.from_arrays([
                        rows.column("doc"), pa.array(n_words, pa.int64()), pa.array(n_hit),
                        pa.array(names, pa.list_(pa.string())),
                        pa.array(spans, pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()),
                                                            ("end", pa.int32())])))],
                        ["doc", "n_words", "n_hit", "items", "spans"])

        cand = self.alignments().groupBy(*KEY, *ITEM).agg(F.collect_set("shift").alias("shifts")).join(self.items, list(ITEM))
        cand = cand.groupBy(*KEY).agg(F.collect_list(F.struct("item", "words", "shifts")).alias("found"))
        same = F.col("doc")[id_col].eqNullSafe(F.col("doc_id")) & (text_key(F.col("doc")[text_col]) == F.col("tk"))
        return docs.join(cand, same, "left").select("doc", "found").mapInArrow(verify, out)


def occurrences(words: np.ndarray, item: np.ndarray, shift: int, window: int) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of ``words`` that equal ``item`` laid at ``shift``
    and hold at least one whole phrase."""
    lo, hi = max(0, shift), min(len(words), shift + len(item))
    size = min(window, len(item))
    if hi - lo < size:
        return []
    same = np.r_[False, words[lo:hi] == item[lo - shift:hi - shift], False]
    edges = np.flatnonzero(same[1:] != same[:-1])
    return [(int(lo + s), int(lo + e)) for s, e in zip(edges[::2], edges[1::2]) if e - s >= size]


def contaminated() -> Column:
    """At least one hit word, and at least a twentieth of the words hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest columns per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    m = BenchmarkIndex(docs.select(id_col, text_col), benchmark, id_col, text_col).matches()
    return m.select(
        F.col("doc")[id_col].alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    return BenchmarkIndex(docs, benchmark, id_col, text_col).matches().where(~contaminated()).select("doc.*")
