"""N-gram Jaccard join by chosen paths.

Documents are sets of word 5-grams. A path splits the sets by sampled tokens: on
each level every set of a node moves to the child named by its token of smallest value
under that level's random order, so two sets of Jaccard similarity J stay
together with probability J per level. Nodes of at most ``leaf`` sets are compared pair
by pair; larger nodes are split again, down to ``depth`` levels. The number of independent runs
follows from the target recall: ``1 - (1 - t**depth)**runs >= recall`` for pairs at the threshold t.

1. Sets are hashed once per document; documents with the same set form one class.
2. Runs and levels group the classes of all documents by their paths (one row per class and run).
3. Leaves are compared on the sampled tokens they carry, and each gives a spanning forest of
   likely pairs. A node that is still large at the last level shares ``depth`` sampled
   tokens; its members are linked to its smallest one, without comparing all pairs.
4. The likely pairs' connected components are the candidate groups: they are found in Spark.
5. Whole sets of the candidate groups are compared exactly, in blocks of bounded size, by counting the
   shared tokens. A block sends per set only its number of links and its local root, never pairs.
6. Components of the exact links are the classes of the result.

Cases: null and empty texts have no n-grams, no links and a class of their own; texts under
five words are one n-gram. A null doc_id counts as larger than every id. Repeated rows are documents
that link to each other. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textcols as tc
from tessera.llm.components import collecting, components, discard, release, written

NGRAM = 5
RECALL = 0.999
DEPTH = 3
LEAF = 256
BLOCK_DOCS = 1024
BLOCK_TOKENS = 1_000_000
# similarity threshold 4/5 as integers: J >= p/q  <=>  (p+q) * shared >= p * (sizes added)
P, Q = 4, 5
NO_ID = 2**63 - 1
_U = np.uint64


def run_count(recall: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - (P / Q) ** depth))


def token_sets(data: np.ndarray, offs: np.ndarray, ngram: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): the distinct n-gram hashes of each text, sorted."""
    starts, ends, bounds = tc.word_spans(data, offs, tc.WHITE_SPACE)
    words = tc.span_hash(data, starts, ends)
    counts = np.diff(bounds)
    grams = np.where(counts == 0, 0, np.maximum(counts - ngram + 1, 1))
    row = np.repeat(np.arange(len(counts)), grams)
    first = bounds[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams))
    token = tc.run_hash(words, first, np.minimum(first + ngram, bounds[1:][row]))
    order = np.lexsort((token, row))
    token, row = token[order], row[order]
    keep = np.r_[True, (token[1:] != token[:-1]) | (row[1:] != row[:-1])] if len(token) else np.zeros(0, bool)
    token, row = token[keep], row[keep]
    return token, np.searchsorted(row, np.arange(len(counts) + 1))


def sampled(tokens: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """(texts, n) smallest values under n random orders; 0 for empty sets."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, n), _U)
    if len(full):
        odd = tc.mix64(np.arange(1, n + 1, dtype=_U)) | _U(1)
        for k in range(n):
            out[full, k] = np.minimum.reduceat(tokens * odd[k], bounds[full])
    return out


def set_sums(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two sums of token hashes per set; equal sets have equal sums."""
    total = np.zeros((2, len(tokens) + 1), _U)
    np.cumsum(tc.mix64(tokens), out=total[0, 1:])
    np.cumsum(tc.mix64(tokens ^ _U(0xA24BAED4963EE407)), out=total[1, 1:])
    return total[:, bounds[1:]] - total[:, bounds[:-1]]


def signatures(docs: DataFrame, ngram: int, n: int) -> DataFrame:
    """(d, key, s1, s2, n, mins): set identity (two sums), size and sampled tokens of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, "text"):
                tokens, bounds = token_sets(data, offs, ngram)
                s = set_sums(tokens, bounds)
                mins = sampled(tokens, bounds, n)
                yield pa.RecordBatch.from_arrays([
                    rows.column("d"), rows.column("key"), pa.array(tc.as_signed(s[0])), pa.array(tc.as_signed(s[1])),
                    pa.array(np.diff(bounds), pa.int64()),
                    tc.list_column(tc.as_signed(mins.ravel()), np.arange(len(mins) + 1) * n, pa.int64())],
                    ["d", "key", "s1", "s2", "n", "mins"])

    return docs.select("d", "key", "text").mapInArrow(run, "d long, key long, s1 long, s2 long, n long, mins array<long>")


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of equal ``key`` from a stream sorted by it, in tables of whole groups."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None and held.num_rows:
            table = pa.concat_tables([held, table])
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n items linked by (a, b)."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def likely_links(leaves: DataFrame, n: int, agree: int) -> DataFrame:
    """(a, b) spanning forests of the leaves (node, s1, mins): sets that agree in
    at least ``agree`` of the n sampled tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "node"):
            node = table.column("node").to_numpy()
            ids = table.column("s1").to_numpy()
            mins = table.column("mins").combine_chunks().flatten().to_numpy().reshape(-1, n)
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            out_a, out_b = [], []
            for i, j in zip(first, np.r_[first[1:], len(node)]):
                if j - i < 2:
                    continue
                m = mins[i:j]
                same = np.zeros((j - i, j - i), np.int16)
                for k in range(n):
                    same += m[:, k, None] == m[None, :, k]
                a, b = np.nonzero(np.triu(same >= agree, 1))
                if len(a):
                    root = _roots(j - i, a, b)
                    moved = np.flatnonzero(root != np.arange(j - i))
                    out_a.append(ids[i:j][moved])
                    out_b.append(ids[i:j][root[moved]])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))],
                                                 ["a", "b"])

    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return leaves.repartition(parts, "node").sortWithinPartitions("node").mapInArrow(run, "a long, b long")


def candidate_edges(classes: DataFrame, runs: int, depth: int, leaf: int, agree: int) -> DataFrame:
    """(a, b) of likely similar classes (s1, mins)."""
    n = runs * depth
    paths = classes.select("s1", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"), "mins")
    rows = written(paths.select(
        "s1", "run", F.xxhash64(F.lit(0), "run", F.col("mins")[F.col("run") * depth]).alias("node"),
        F.slice("mins", F.col("run") * depth + 1, depth).alias("own")), "paths")
    leaves, chains = None, None
    for level in range(depth):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min("s1").alias("head"))
        # written first: both sides of the join are then plain exchanges, which Spark splits where a node is large
        sizes = written(sizes.where("members > 1"), "nodes")
        known = written(rows.join(sizes, "node"), "level")
        small = known.where(F.col("members") <= leaf).select("node", "s1")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = known.where(F.col("members") > leaf)
        if level + 1 < depth:
            if large.isEmpty():
                break
            rows = large.select("s1", "run", F.xxhash64("node", F.col("own")[level + 1]).alias("node"), "own")
        else:
            chains = large.where("s1 <> head").select(F.col("s1").alias("a"), F.col("head").alias("b")).distinct()
    with_mins = leaves.join(classes.select("s1", "mins"), "s1")
    edges = likely_links(with_mins.select("node", "s1", "mins"), n, agree)
    return edges if chains is None else edges.unionByName(chains)


def shared_counts(tokens: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, n) numbers of shared tokens of n sets given as (token, doc) pairs."""
    shared = np.zeros((n, n), np.int32)
    order = np.argsort(tokens, kind="stable")
    tokens, doc = tokens[order], doc[order]
    first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    size = np.diff(np.r_[first, len(tokens)])
    often = size >= 64
    if often.any():
        held, at = first[often], size[often]
        for i in range(0, len(held), 2048):
            x = np.zeros((n, len(held[i:i + 2048])), np.float32)
            for k, (f, s) in enumerate(zip(held[i:i + 2048], at[i:i + 2048])):
                x[doc[f:f + s], k] = 1.0
            shared += np.rint(x @ x.T).astype(np.int32)
    for s in np.unique(size[~often]):
        if s < 2:
            continue
        f = first[size == s]
        step = max(1, 2_000_000 // int(s * s))
        for i in range(0, len(f), step):
            lists = doc[f[i:i + step, None] + np.arange(s)].astype(np.int64)
            flat = (lists[:, :, None] * n + lists[:, None, :]).ravel()
            shared += np.bincount(flat, minlength=n * n).reshape(n, n).astype(np.int32)
    return shared


def exact_links(blocks: DataFrame) -> DataFrame:
    """(s1, links, root) per set and task of rows (task, side, s1, size, tokens).

    ``side`` 0 and 1 are the two blocks of a task, 2 a block against itself.
    ``links`` counts the documents of the linked sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "task"):
            # a repeated row is the same set of the same task
            pair = np.stack([table.column("task").to_numpy(), table.column("s1").to_numpy()])
            once = np.unique(pair, axis=1, return_index=True)[1]
            table = table if len(once) == table.num_rows else table.take(pa.array(np.sort(once)))
            task = table.column("task").to_numpy()
            first = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
            side, ids = table.column("side").to_numpy(), table.column("s1").to_numpy()
            size = table.column("size").to_numpy()
            lists = table.column("tokens").combine_chunks()
            flat = lists.flatten().to_numpy()
            bounds = np.r_[0, np.cumsum(np.diff(lists.offsets.to_numpy().astype(np.int64)))]
            out: list[tuple[np.ndarray, ...]] = []
            for i, j in zip(first, np.r_[first[1:], len(task)]):
                n = j - i
                if n < 2:
                    continue
                own = np.diff(bounds[i:j + 1])
                shared = shared_counts(flat[bounds[i]:bounds[j]], np.repeat(np.arange(n), own), n)
                near = (P + Q) * shared.astype(np.int64) >= P * (own[:, None] + own[None, :])
                np.fill_diagonal(near, False)
                s = side[i:j]
                near &= (s[:, None] == 2) | (s[:, None] != s[None, :])
                a, b = np.nonzero(np.triu(near, 1))
                if len(a):
                    root = _roots(n, a, b)
                    got = np.flatnonzero(near.any(axis=1))
                    out.append((ids[i:j][got], (near @ size[i:j])[got], ids[i:j][root[got]]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], ["s1", "links", "root"])

    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(
        run, "s1 long, links long, root long")


def set_rows(texts: DataFrame, ngram: int) -> DataFrame:
    """Rows of ``texts`` with the text replaced by its token set; ``own`` is the identity
    the set must have, which tells rows that share a doc_id apart."""
    names = [c for c in texts.columns if c != "text"]
    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in tc.pieces(batch, "text"):
                tokens, bounds = token_sets(data, offs, ngram)
                out = pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in names), tc.list_column(tc.as_signed(tokens), bounds, pa.int64())],
                    [*names, "tokens"])
                meant = tc.as_signed(set_sums(tokens, bounds)[0]) == rows.column("own").to_numpy()
                yield out if meant.all() else out.filter(pa.array(meant))

    return texts.select(*names, "text").mapInArrow(run, f"{kinds}, tokens array<long>")


def split_tasks(members: DataFrame) -> DataFrame:
    """One row per set and block task it takes part in. A group of b blocks has
    b * (b + 1) / 2 tasks, each of two bounded blocks; most groups are one block."""
    spread = members.withColumn("block", F.pmod(F.xxhash64("s1"), F.col("blocks")))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return spread.withColumn("task", F.xxhash64("grp", low, high)).withColumn(
        "side", F.when(F.col("block") == F.col("other"), F.lit(2))
                 .when(F.col("block") < F.col("other"), F.lit(0)).otherwise(F.lit(1)))


def classify(docs: DataFrame, id_col: str, text_col: str, ngram: int, recall: float, depth: int,
             leaf: int) -> DataFrame:
    """(d, key, n, class_d, label, n_links) per document: d is its id (null: larger than every
    id), key its text's hash, label identifies its class (null for texts without words)."""
    spark = docs.sparkSession
    runs = run_count(recall, depth)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"),
                       F.xxhash64(text).alias("key"), text.alias("text"))
    sigs = written(signatures(base, ngram, runs * depth), "sets")
    classes = written(sigs.where("n > 0").groupBy("s1", "s2").agg(
        F.min(F.struct("d", "key")).alias("low"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"),
        F.first("mins").alias("mins")).select("s1", "s2", "low.d", "low.key", "size", "n", "mins"), "classes")
    # sampled tokens agree in a share J on average; the cut is 4.5 deviations below the threshold
    t, n = P / Q, runs * depth
    agree = max(1, math.floor(n * t - 4.5 * math.sqrt(n * t * (1 - t))))
    with collecting([]) as steps:
        candidates = candidate_edges(classes, runs, depth, leaf, agree)
    edges = written(candidates, "likely")
    for step in steps:
        discard(step)
    release(spark)
    joined = components(edges)
    discard(edges)
    groups = joined.select(F.col("node").alias("s1"), F.col("label").alias("grp"))

    members = classes.select("s1", "d", "key", "size", "n").join(groups, "s1")
    extent = members.groupBy("grp").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("long").alias("blocks"))
    members = written(members.join(extent, "grp").select("grp", "s1", "d", "key", "size", "blocks"), "members")
    discard(joined)
    release(spark)
    # always a merge join: the same plan, and the same growth, at every size; with the text's hash, because
    # rows without an id, or of one id, would all meet each other
    texts = base.hint("merge").join(members.withColumnRenamed("s1", "own"), ["d", "key"])
    sets = set_rows(texts.select("grp", "own", "d", "size", "blocks", "text"), ngram)
    blocks = split_tasks(sets.withColumnRenamed("own", "s1")).select("task", "side", "s1", "size", "tokens")
    found = written(exact_links(blocks), "links")
    discard(members)
    release(spark)

    links = found.groupBy("s1").agg(F.sum("links").alias("links"))
    label = components(found.where("s1 <> root"), "s1", "root")
    whole = classes.select("s1", "s2", "d", "size").join(
        label.withColumnRenamed("node", "s1"), "s1", "left").join(links, "s1", "left")
    whole = whole.withColumn("label", F.coalesce("label", "s1"))
    heads = whole.groupBy("label").agg(F.min("d").alias("class_d"))
    whole = whole.join(heads, "label").select(
        "s1", "s2", "label", "class_d", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return sigs.select("d", "key", "s1", "s2", "n").join(whole, ["s1", "s2"], "left")


def join_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                 recall: float = RECALL, depth: int = DEPTH, leaf: int = LEAF) -> DataFrame:
    """(doc_id, class_id, n_links) per document: class_id is the smallest id of the
    document's class, n_links the number of other documents with a Jaccard similarity of 0.8 or more."""
    out = classify(docs, id_col, text_col, ngram, recall, depth, leaf)
    full = F.col("n") > 0
    kind = docs.schema[id_col].dataType
    clean = lambda c: F.when(c < F.lit(NO_ID), c).cast(kind)
    return out.select(
        clean(F.col("d")).alias(id_col), clean(F.when(full, F.col("class_d")).otherwise(F.col("d"))).alias("class_id"),
        F.when(full, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
             recall: float = RECALL, depth: int = DEPTH, leaf: int = LEAF) -> DataFrame:
    """The rows of ``docs`` without the near-duplicates: of each class, the document of the smallest id
    (then of the smallest text hash); a row repeated in full stays once. Texts without words all stay."""
    found = classify(docs, id_col, text_col, ngram, recall, depth, leaf)
    one = F.struct("d", "key")
    kept = (found.where("n > 0").groupBy("label").agg(F.min(one).alias("k"))
                 .select(F.col("k.d").alias("_d"), F.col("k.key").alias("_key")))
    kept = written(kept, "kept")
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    stays = docs.where(words).join(
        kept, (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col("_d")) & (key == F.col("_key")), "left_semi")
    # a kept (id, text) that occurs in several rows would stay several times
    if not found.where("n > 0").groupBy("d", "key").count().where("count > 1").isEmpty():
        stays = stays.dropDuplicates([id_col, text_col])
    return stays.unionByName(docs.where(~words))
