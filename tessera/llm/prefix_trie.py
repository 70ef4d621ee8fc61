r"""Prefix trie of conversations by range-minimum search over sorted common prefixes.

Conversations are sorted by their turns. Next to each other in that order, every prefix owns one run of
conversations: it reaches as far left and right as the common prefix with the neighbour (LCP) is at least its
depth. A conversation brings the prefixes longer than its LCP with the one before, so every node of
the trie is a candidate exactly once, at the left end of its run.

* :func:`rebuilt` gives every conversation as an array of turn digests.
* :func:`blocks` sorts them (a range shuffle on the turns, then the id, so equal conversations are split like any
  others) and packs ``BLOCK`` neighbours, with their LCPs, into a row.
* Each candidate searches its right end, and the left end of its parent, on its own: a sparse table gives the minimum LCP
  of any power-of-two stretch, and a binary search over stretches finds the first LCP below the depth. No stack is kept and
  no candidate waits for another.
* A search that leaves its block goes on in a tree of block minima (:func:`levels`, again ``BLOCK`` entries a row, with
  sparse tables): up until an entry stops it, then down to that entry. At most one search per depth leaves a block, on each side.

Member counts, the smallest member, leaves and saved characters of a subtree are sums or minima over the run, gathered
by the same search from running sums: leaves are the places where an LCP falls below the length of the conversation before; saved characters are those of
all members below the node less those of the distinct nodes. Ids of
equal conversations that fill several blocks are hashed as pieces of joined text by one streaming task for each such node.

Cases: null roles and texts are empty; rows without a conversation id belong to none; a conversation with no turn left is a member of the
root; equal turn numbers are ordered by the digest of role and text; an empty table has no nodes. The digests of one conversation
are one row (20 bytes a turn). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.components import collecting, discard, written

BLOCK = 1024
PIECE_IDS = 128
HEADS, FAMILY = 6, 100
NONE_SHA = hashlib.sha256(b"").hexdigest()
NODE = ("g long, i int, d int, conv_id long, parent_conv_id long, pg long, pi int, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string, open boolean")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): digest and length of every turn, in turn order (null first)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", digest.alias("k"), F.length(text).alias("c")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["k"].alias("k"), t["c"].alias("c"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with the first turns taken from the first conversation of the family."""
    own = written(ordered_turns(conversations), "turns")
    c = F.col("conv_id")
    base, h = c - c % FAMILY, (F.crc32(c.cast("string").cast("binary")) % HEADS).cast("int")
    heads = own.where(c % FAMILY == 0).select(c.alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    joined = own.withColumn("base", base).join(heads, "base", "left")
    tail = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.when(F.col("head").isNull(), tail).otherwise(F.concat(F.slice("head", F.lit(1), h), tail)).alias("turns"))


# ---------------------------------------------------------------- sorted blocks

def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digests as two words each, code points, offsets) of an array<struct<k, c>> column."""
    offs = column.offsets.to_numpy()
    items = column.values.slice(offs[0], offs[-1] - offs[0])
    digests = items.field(0)
    if len(digests):
        raw = np.frombuffer(digests.buffers()[2], np.uint8)
        first = np.frombuffer(digests.buffers()[1], np.int32, len(digests) + 1, digests.offset * 4)
        words = raw[first[0]:first[-1]].view(np.uint64).reshape(-1, 2)
    else:
        words = np.zeros((0, 2), np.uint64)
    return words, items.field(1).to_numpy(), (offs - offs[0]).astype(np.int64)


def expand(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, 0..n-1) for each row's count."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def common_prefix(words: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """LCP of each row with the row before (the first row: 0)."""
    size = np.diff(offs)
    both = np.minimum(size[1:], size[:-1])
    row, k = expand(both)
    differs = (words[offs[1:-1][row] + k] != words[offs[:-2][row] + k]).any(1)
    out = both.copy()
    if differs.any():
        np.minimum.at(out, row[differs], k[differs])
    return np.concatenate(([0], out))


PACKED = ("pid int, blk int, conv array<long>, size array<int>, lcp array<int>, chars array<int>, "
          "first array<binary>, last array<binary>, before int")


def blocks(sequences: DataFrame, block: int | None = None) -> tuple[DataFrame, int]:
    """(g, conv, size, lcp, chars, total, fresh, drop, n) for each block of neighbours, and the number of blocks."""
    block = block or BLOCK
    ranged = sequences.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, blk, carry = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            words, chars, offs = _flat(batch.column("turns"))
            conv, size = batch.column("conv_id").to_numpy(), np.diff(offs)
            head = np.zeros((0, 2), np.uint64) if carry is None else carry
            lcp = common_prefix(np.concatenate((head, words)), np.concatenate(([0], offs + len(head))))[1:]
            if carry is None:
                lcp[0] = 0
            before = np.concatenate(([len(head)], size[:-1]))
            rows = []
            for lo in range(0, len(conv), block):
                hi = min(lo + block, len(conv))
                key = [words[offs[r]:offs[r + 1]] for r in (lo, hi - 1)]
                rows.append({"pid": pid, "blk": blk, "conv": conv[lo:hi], "size": size[lo:hi], "lcp": lcp[lo:hi], "chars": chars[offs[lo]:offs[hi]],
                             "first": [x.tobytes() for x in key[0]] if blk == 0 else None, "last": [x.tobytes() for x in key[1]],
                             "before": int(before[lo])})
                blk += 1
            carry = words[offs[-2]:offs[-1]].copy()
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("pid", pa.int32()), ("blk", pa.int32()), ("conv", pa.list_(pa.int64())), ("size", pa.list_(pa.int32())),
                ("lcp", pa.list_(pa.int32())), ("chars", pa.list_(pa.int32())), ("first", pa.list_(pa.binary())),
                ("last", pa.list_(pa.binary())), ("before", pa.int32())]))

    packed = written(ranged.mapInArrow(pack, PACKED), "packed")
    # one row per partition: where its blocks begin, and the LCP over its border
    ends = packed.groupBy("pid").agg(F.min_by("first", "blk").alias("first"), F.max_by("last", "blk").alias("last"), F.count("*").alias("blocks"))
    w = Window.orderBy("pid")
    ends = ends.withColumns({"g0": F.sum("blocks").over(w) - F.col("blocks"), "prev": F.lag("last").over(w)})
    same = F.zip_with("first", "prev", lambda a, b: a.eqNullSafe(b))
    stop = F.array_position(same, False)
    border = F.when(F.col("prev").isNull(), -1).when(stop == 0, F.size(same)).otherwise(stop - 1).cast("int")
    ends = ends.select("pid", "g0", border.alias("border"), F.coalesce(F.size("prev"), F.lit(0)).alias("prev"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in range(batch.num_rows):
                lcp, size, chars = (batch.column(c)[r].values.to_numpy().astype(np.int64) for c in ("lcp", "size", "chars"))
                before = batch.column("before")[r].as_py()
                if batch.column("blk")[r].as_py() == 0:
                    lcp[0], before = batch.column("border")[r].as_py(), batch.column("prev")[r].as_py()
                offs = np.concatenate(([0], np.cumsum(size)))
                run = np.concatenate(([0], np.cumsum(chars)))
                rows.append({"g": batch.column("g")[r].as_py(), "conv": batch.column("conv")[r].values, "size": size, "lcp": lcp, "chars": chars,
                             "total": run[offs[1:]] - run[offs[:-1]], "fresh": run[offs[1:]] - run[offs[:-1] + np.maximum(lcp, 0)],
                             "drop": (lcp < np.concatenate(([before], size[:-1]))).astype(np.int64), "n": np.ones(len(lcp), np.int64)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema(
                    [("g", pa.int64())] + [(c, pa.list_(pa.int64())) for c in ("conv", "size", "lcp", "chars", "total", "fresh", "drop", "n")]))

    lists = ", ".join(f"{c} array<long>" for c in ("conv", "size", "lcp", "chars", "total", "fresh", "drop", "n"))
    # one row per partition, so the broadcast is bounded by their number
    placed = packed.join(F.broadcast(ends), "pid").withColumn("g", F.col("g0") + F.col("blk"))
    out = written(placed.mapInArrow(finish, f"g long, {lists}"), "blocks")
    discard(packed)
    return out, out.count()


SUMS = ("n", "total", "fresh", "drop")


def levels(bottom: DataFrame, count: int, block: int | None = None) -> list[DataFrame]:
    """The blocks, then rows of up to ``block`` block minima, and so on up to one row."""
    block = block or BLOCK
    out = [bottom.select("g", "lcp", "conv", *SUMS)]
    while count > 1:
        below = out[-1]
        one = below.select(F.floor(F.col("g") / block).alias("up"), F.struct(
            "g", F.array_min("lcp").alias("lcp"), F.array_min("conv").alias("conv"),
            *[F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + x).alias(s) for s in SUMS]).alias("e"))
        up = one.groupBy("up").agg(F.sort_array(F.collect_list("e")).alias("e"))
        out.append(written(up.select(F.col("up").alias("g"), *[F.col("e")[c].alias(c) for c in ("lcp", "conv", *SUMS)]), "level"))
        count = -(-count // block)
    return out


# ---------------------------------------------------------------- range minima

class RangeMin:
    """Sparse table: minima of all stretches of 1, 2, 4, ... entries."""

    def __init__(self, values: np.ndarray):
        self.n, self.table = len(values), [values]
        while 2 ** len(self.table) <= self.n:
            half, t = 2 ** (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(t[:-half], t[half:]))

    def first_below(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest position >= start whose value is under ``least`` (n if none)."""
        at = start.copy()
        for k in range(len(self.table) - 1, -1, -1):
            fits = at + 2 ** k <= self.n
            ok = fits & (self.table[k][np.where(fits, at, 0)] >= least)
            at = at + ok * 2 ** k
        return at

    def last_below(self, end: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Largest position < end whose value is under ``least`` (-1 if none)."""
        at = end.copy()
        for k in range(len(self.table) - 1, -1, -1):
            fits = at - 2 ** k >= 0
            ok = fits & (self.table[k][np.where(fits, at - 2 ** k, 0)] >= least)
            at = at - ok * 2 ** k
        return at - 1

    def low(self, lo: np.ndarray, hi: np.ndarray, none: int) -> np.ndarray:
        """Minimum of [lo, hi), ``none`` where that is empty."""
        out = np.full(len(lo), none, np.int64)
        for k, t in enumerate(self.table):
            use = (hi - lo >= 2 ** k) & (hi - lo < 2 ** (k + 1))
            out[use] = np.minimum(t[lo[use]], t[hi[use] - 2 ** k])
        return out


BIG = np.iinfo(np.int64).max


class Stretch:
    """Minima and running sums of one row of a level."""

    def __init__(self, row: dict[str, np.ndarray]):
        self.lcp, self.conv = RangeMin(row["lcp"]), RangeMin(row["conv"])
        self.sums = {s: np.concatenate(([0], np.cumsum(row[s]))) for s in SUMS}

    def gather(self, lo: np.ndarray, hi: np.ndarray) -> dict[str, np.ndarray]:
        return {"conv": self.conv.low(lo, hi, BIG), **{s: v[hi] - v[lo] for s, v in self.sums.items()}}


def row_arrays(batch: pa.RecordBatch | pa.Table, r: int, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return {c: batch.column(c)[r].values.to_numpy() for c in names}


class Candidates:
    """The prefixes that the conversations of a block bring, with their ends inside the block."""

    def __init__(self, batch: pa.RecordBatch, r: int):
        self.row = row_arrays(batch, r, ("conv", "size", "lcp", "chars", *SUMS))
        self.g, self.n = batch.column("g")[r].as_py(), len(self.row["lcp"])
        lcp, size = self.row["lcp"], self.row["size"]
        self.stretch = Stretch(self.row)
        self.i, k = expand(size - lcp)
        self.d = lcp[self.i] + 1 + k
        self.begin = np.cumsum(size - lcp) - (size - lcp)
        self.end = self.stretch.lcp.first_below(self.i + 1, self.d)
        self.open = self.end == self.n
        # the parent of a top candidate: the longest prefix shared with a neighbour on the left
        self.top = np.flatnonzero((k == 0) & (self.d > 0))
        self.left = self.stretch.lcp.last_below(self.i[self.top], self.d[self.top] - 1)
        # conversations equal to the one before
        same = lcp == size
        starts = np.flatnonzero(~same)
        self.lead = int(starts[0]) if len(starts) else self.n
        self.runs = list(zip(starts, np.append(starts[1:], self.n)))

    def asks(self) -> set[tuple[bool, int]]:
        """Searches that leave the block: (to the right, depth)."""
        out = {(True, int(d)) for d in self.d[self.open]}
        out |= {(False, int(d)) for d in np.unique(self.d[self.top][self.left < 0] - 1)}
        if self.lead:
            out.add((False, int(self.row["size"][0])))
        return out


def queries(bottom: DataFrame) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                c = Candidates(batch, r)
                found = sorted(c.asks())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([c.g] * len(found), pa.int64()), pa.array([f[0] for f in found]),
                                                      pa.array([f[1] for f in found], pa.int32())], ["g", "rightward", "d"])

    return bottom.mapInArrow(ask, "g long, rightward boolean, d int")


CARRY = "d int, g long, at long, found boolean, conv long, n long, total long, fresh long, drop long"
CARRIED = ("conv", *SUMS)


def search(asked: pa.Table, level: pa.Table, rightward: bool, down: bool, block: int) -> pa.Table:
    """One step of searches in one row of a level: ``at`` is the entry that a search comes from (up) or that it
    enters as a whole (down); afterwards the entry it found, or the row it leaves."""
    s = Stretch(row_arrays(level, 0, ("lcp", "conv", *SUMS)))
    base, n = level.column("g")[0].as_py(), s.lcp.n
    at, d = asked.column("at").to_numpy(), asked.column("d").to_numpy().astype(np.int64)
    carried = {c: asked.column(c).to_numpy() for c in CARRIED}
    if rightward:
        start = np.zeros(len(at), np.int64) if down else at - base * block + 1
        hit = s.lcp.first_below(start, d)
        found = hit < n
        got = s.gather(start, hit)
        carried = {c: np.minimum(carried[c], got[c]) if c == "conv" else carried[c] + got[c] for c in CARRIED}
    else:
        hit = s.lcp.last_below(np.full(len(at), n) if down else at - base * block, d)
        found = hit >= 0
    return pa.table({"d": asked.column("d"), "g": asked.column("g"), "at": np.where(found, base * block + hit, base), "found": found, **carried})


def extents(asked: DataFrame, tree: list[DataFrame], rightward: bool, block: int) -> DataFrame:
    """(g, d, at, conv, n, ...): where each search ends. ``at`` is block * ``block`` + position."""

    def step(todo: DataFrame, k: int, down: bool) -> DataFrame:
        row = F.col("at") if down else F.floor(F.col("at") / block)
        todo = todo.withColumn("row", row)
        return todo.groupBy("row").cogroup(tree[k].withColumn("row", F.col("g")).groupBy("row")).applyInArrow(
            lambda a, b: search(a.drop_columns(["row"]), b, rightward, down, block) if a.num_rows else a.drop_columns(["row"]), CARRY)

    zero = [F.lit(BIG).alias("conv")] + [F.lit(0).cast("long").alias(s) for s in SUMS]
    todo = asked.where(F.col("rightward") == rightward).select("d", "g", F.col("g").alias("at"), F.lit(False).alias("found"), *zero)
    stopped = {}
    for k in range(1, len(tree)):
        todo = written(step(todo, k, False), "search")
        stopped[k - 1] = todo.where("found")
        todo = todo.where("NOT found")
    ended = todo  # to the right of everything
    going = None
    for k in range(len(tree) - 2, -1, -1):
        here = stopped[k] if going is None else going.unionByName(stopped[k])
        if rightward:
            going = written(step(here, k, True), "search")
        else:
            # searches to the left that enter a row at the same depth have one answer
            once = here.select("d", "at").distinct().select(
                "d", F.lit(0).cast("long").alias("g"), "at", F.lit(False).alias("found"), *zero).withColumn("g", F.col("at"))
            ends = step(once, k, True).select("d", F.col("g").alias("from"), F.col("at").alias("to"))
            going = written(here.withColumnRenamed("at", "from").join(ends, ["from", "d"])
                                .withColumn("at", F.col("to")).drop("from", "to"), "search")
    return ended if going is None else going.unionByName(ended) if rightward else going


# ---------------------------------------------------------------- nodes

ANSWER = "array<struct<rightward:boolean,d:int,at:long,parent:long,conv:long,n:long,total:long,fresh:long,drop:long>>"


def values(c: Candidates, answers: list[dict]) -> dict[str, np.ndarray]:
    """Member count, smallest member, leaves and saved characters of the candidates."""
    got = c.stretch.gather(c.i + 1, c.end)
    right = {a["d"]: a for a in answers if a["rightward"]}
    for x in np.flatnonzero(c.open):
        a = right.get(int(c.d[x]))
        if a:
            got["conv"][x] = min(got["conv"][x], a["conv"])
            for s in SUMS:
                got[s][x] += a[s]
    size, chars = c.row["size"], c.row["chars"]
    run, offs = np.concatenate(([0], np.cumsum(chars))), np.cumsum(size) - size
    above = run[offs[c.i] + np.maximum(c.d - 1, 0)] - run[offs[c.i]]
    n = got["n"] + 1
    own = c.row["total"][c.i]
    return {"conv": np.minimum(c.row["conv"][c.i], got["conv"]), "n": n, "leaves": got["drop"] + 1,
            "saved": own + got["total"] - n * above - (own - above) - got["fresh"]}


def with_answers(bottom: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with the answers to its searches (at most two for each depth)."""
    packed = answers.groupBy("g").agg(F.collect_list(F.struct(
        "rightward", "d", "at", "parent", "conv", *SUMS)).alias("answers"))
    return bottom.join(packed, "g", "left").withColumn("answers", F.coalesce("answers", F.array().cast(ANSWER)))


def open_nodes(asked: DataFrame) -> DataFrame:
    """(pg, pi, d, parent) of the nodes whose runs reach the end of their block."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                c = Candidates(batch, r)
                conv, x = values(c, batch.column("answers")[r].as_py())["conv"], np.flatnonzero(c.open)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c.g), pa.int64()), pa.array(c.i[x], pa.int32()),
                                                  pa.array(c.d[x], pa.int32()), pa.array(conv[x], pa.int64())], ["pg", "pi", "d", "parent"])

    return asked.mapInArrow(nodes, "pg long, pi int, d int, parent long")


def assemble(asked: DataFrame, block: int) -> DataFrame:
    """The nodes of every block; ``open`` ones still lack children and ends of later blocks."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                c = Candidates(batch, r)
                answers = batch.column("answers")[r].as_py()
                v, m = values(c, answers), len(c.i)
                up = np.arange(m) - 1                 # the parent is the candidate before, but for the tops
                near = c.left >= 0
                li, ld = c.left[near], c.d[c.top[near]] - 1
                up[c.top[near]] = c.begin[li] + ld - c.row["lcp"][li] - 1
                far = c.top[~near]
                up[far] = -1
                up[c.d == 0] = -1
                kids = np.bincount(up[up >= 0], minlength=m)
                parent = np.where(up >= 0, v["conv"][up], -1)
                pg, pi = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
                left = {a["d"]: a for a in answers if not a["rightward"]}
                for x in far:
                    a = left[int(c.d[x]) - 1]
                    parent[x], pg[x], pi[x] = a["parent"], a["at"] // block, a["at"] % block
                sha = np.full(m, NONE_SHA, object)
                for s, e in c.runs:
                    if c.row["size"][s] > c.row["lcp"][s]:
                        ids = ",".join(map(str, c.row["conv"][s:e].tolist()))
                        sha[c.begin[s] + c.row["size"][s] - c.row["lcp"][s] - 1] = (
                            None if e == c.n else hashlib.sha256(ids.encode()).hexdigest())
                root, inside = c.d == 0, pg < 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(m, c.g), pa.int64()), pa.array(c.i, pa.int32()), pa.array(c.d, pa.int32()), pa.array(v["conv"], pa.int64()),
                    pa.array(parent, pa.int64(), mask=root), pa.array(pg, pa.int64(), mask=inside), pa.array(pi, pa.int32(), mask=inside),
                    pa.array(v["n"], pa.int64()), pa.array(kids, pa.int64()), pa.array(v["leaves"], pa.int64()), pa.array(v["saved"], pa.int64()),
                    pa.array(sha, pa.string()), pa.array(c.open)], [f.split()[0] for f in NODE.split(", ")])

    return asked.mapInArrow(nodes, NODE)


def long_runs(asked: DataFrame, block: int) -> DataFrame:
    """(g, i, d, sha) of equal conversations that reach the end of their first block: pieces of joined ids, hashed as a stream."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                c = Candidates(batch, r)
                parts = []
                if c.lead:
                    d = int(c.row["size"][0])
                    at = next(a["at"] for a in batch.column("answers")[r].as_py() if not a["rightward"] and a["d"] == d)
                    parts.append((at // block, at % block, d, 0, c.lead))
                for s, e in c.runs[-1:]:
                    if e == c.n and c.row["size"][s] > c.row["lcp"][s]:
                        parts.append((c.g, int(s), int(c.row["size"][s]), int(s), c.n))
                out = [(kg, ki, d, c.g, lo, ",".join(map(str, c.row["conv"][lo:min(lo + PIECE_IDS, hi)].tolist())))
                       for kg, ki, d, begin, hi in parts for lo in range(begin, hi, PIECE_IDS)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                        pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string()))], ["g", "i", "d", "b", "lo", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []

        def close():
            if key is not None:
                done.append((*key, state.hexdigest()))

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("g", "i", "d", "ids")]
            for g, i, d, ids in zip(*cols):
                if (g, i, d) != key:
                    close()
                    key, state = (g, i, d), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.int64(), pa.int32(), pa.int32(), pa.string()))],
                                             ["g", "i", "d", "sha"])

    pieces = asked.mapInArrow(cut, "g long, i int, d int, b long, lo int, ids string")
    return pieces.repartition("g", "i").sortWithinPartitions("g", "i", "d", "b", "lo").mapInArrow(digest, "g long, i int, d int, sha string")


def prefix_trie(sequences: DataFrame, block: int | None = None) -> DataFrame:
    """Every node of the trie of ``sequences`` (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    block = block or BLOCK
    bottom, count = blocks(sequences, block)
    with collecting([bottom]) as steps:
        answers = searched(bottom, count, block)
    ready = written(with_answers(bottom, answers), "ready")
    for step in steps:
        discard(step)
    nodes = written(assemble(ready, block), "nodes")
    kids = nodes.where("pg IS NOT NULL").groupBy(F.col("pg").alias("g"), F.col("pi").alias("i"), (F.col("d") - 1).alias("d")).agg(
        F.count("*").alias("kids"))
    late = (nodes.where("open").join(kids, ["g", "i", "d"], "left").join(long_runs(ready, block), ["g", "i", "d"], "left")
                 .withColumns({"n_children": F.col("n_children") + F.coalesce("kids", F.lit(0)), "ends_sha256": F.coalesce("ends_sha256", "sha")})
                 .drop("kids", "sha"))
    return nodes.where("NOT open").unionByName(late).select(
        "conv_id", F.col("d").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def searched(bottom: DataFrame, count: int, block: int) -> DataFrame:
    """The answers to all searches that leave their block."""
    tree = levels(bottom, count, block)
    asked = written(queries(bottom), "queries")
    none = F.lit(None).cast("long").alias("parent")
    columns = ["g", "rightward", "d", "at", "parent", "conv", *SUMS]
    if count > 1:
        right = written(extents(asked, tree, True, block).select("*", F.lit(True).alias("rightward"), none).select(columns), "right")
        left = extents(asked, tree, False, block)
        heads = open_nodes(with_answers(bottom, right))
        left = (left.withColumns({"pg": F.floor(F.col("at") / block), "pi": (F.col("at") % block).cast("int")})
                    .join(heads, ["pg", "pi", "d"], "left").withColumn("rightward", F.lit(False)).select(columns))
        return right.unionByName(left)
    return bottom.sparkSession.createDataFrame(
        [], "g long, rightward boolean, d int, at long, parent long, conv long, n long, total long, fresh long, drop long")


def conversation_trie(conversations: DataFrame, block: int | None = None) -> DataFrame:
    """The trie of the rebuilt conversations."""
    with collecting([]) as steps:
        sequences = written(rebuilt(conversations), "sequences")
    out = prefix_trie(sequences, block)
    for step in steps:
        discard(step)
    return out


def trie_sql() -> str:
    """DuckDB SQL of the same rows: every prefix of every conversation as text."""
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)), "
           "lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")
    return f"""
WITH t0 AS (SELECT conv_id AS c, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                   length(coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, k, n, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i FROM t0),
ids AS (SELECT c, c - c % {FAMILY} AS base, ({crc}) % {HEADS} AS h FROM (SELECT DISTINCT c, c::VARCHAR AS s FROM t)),
r AS (SELECT ids.c, k, n, 0 AS part, i FROM ids JOIN t ON t.c = ids.base AND i <= h
      UNION ALL SELECT ids.c, k, n, 1, i FROM ids JOIN t ON t.c = ids.c AND i > h),
s AS (SELECT c, n, row_number() OVER w AS d, string_agg(k, '') OVER w AS p FROM r WINDOW w AS (PARTITION BY c ORDER BY part, i)),
pre AS (SELECT c, d, p, n FROM s UNION ALL SELECT c, 0, '', 0 FROM ids),
last AS (SELECT c, max(d) AS d FROM pre GROUP BY c),
ends AS (SELECT p, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM pre JOIN last USING (c, d) GROUP BY p),
node AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM pre GROUP BY d, p),
kids AS (SELECT left(p, 32 * (d - 1)) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
f AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (p)),
sub AS (SELECT left(p, 32 * a) AS p, sum((n_convs - 1) * n)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
        FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id::DOUBLE AS parent_conv_id, f.n_convs, f.n_children, sub.n_leaves, sub.saved_tokens,
       sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM f JOIN sub USING (p) LEFT JOIN ends USING (p) LEFT JOIN node up ON f.d > 0 AND up.p = left(f.p, 32 * (f.d - 1))"""
