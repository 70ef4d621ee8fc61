r"""Spelling variant grouping by k-d trees over letter-count vectors.

One inserted, deleted or replaced letter moves a word's vector of letter counts
by an L1 distance of one (lengths differ) or two (lengths are equal). So the near words of a word lie in a small
ball around its vector, for each of three lengths.

* :func:`count_words` counts the words of all documents.
* :func:`fit_cells` splits every length's vector space into boxes by a k-d tree. The tree is
  fitted on a bounded sample of the vocabulary (``SAMPLE_WORDS``, smallest hashes); every word is filed in its box.
* :func:`near_words` sends each word to the boxes its balls touch, one search per pair of lengths. Inside a box a
  second k-d tree prunes again, vectors at the exact distance remain, and their words are verified in letter order: both
  words must agree once the letter that one has more is taken out, at one position. A pair costs as many
  comparisons as the letter occurs, whatever the number of words with these letters.
* :func:`forms` picks each word's form and follows forms to the root.

Boxes with more than ``CELL_WORDS`` words, or asked by more than ``CELL_ASKS``, are dealt to several tasks; no pair of words is
a row anywhere: a task returns one partial result per asking word.

Cases: null and empty texts have no words; a null id reads as empty text in the deletion
rule; equal rows count each; very long runs are one word of any length. Ties of the form go to the smallest word in code-point order. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import discard, written
from tessera.llm.textcols import column_bytes, mix64, pieces, span_hash

LEAST_LENGTH, LEAST_COUNT, TIMES, DELETE_MOD = 7, 2, 10, 31
SAMPLE_WORDS = 20_000
CELL_WORDS, CELL_ASKS, MAX_CELLS = 16_384, 131_072, 1_024
LUMP = 40          # words this long and longer share one forest entry
LEAF = 32
CHUNK = 1 << 20
LETTERS = 26 + 64  # a-z, then U+00C0 to U+00FF

_U = np.uint64
_LETTER = mix64(np.arange(1, LETTERS + 1, dtype=_U) * _U(0xA24BAED4963EE407))
_STEP = 0x9FB21C651E98DF25 | 1
_BACK = _U(pow(_STEP, -1, 1 << 64))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of at least ``LEAST_LENGTH`` letters that occur at least ``LEAST_COUNT`` times.

    A run of letters whose seeded checksum is a multiple of ``DELETE_MOD`` loses one letter (the stand-in for misspelling).
    """
    run = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in pieces(batch, "t"):
                total: Counter = Counter()
                for i, doc_id in enumerate(part.column("i").to_pylist()):
                    text = data[offs[i]:offs[i + 1]].tobytes().lower().decode("utf-8", "replace")
                    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in Counter(run.findall(text)).items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % DELETE_MOD == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < LEAST_LENGTH:
                                continue
                        total[word] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    found = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(occurrences, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---------------------------------------------------------------- vectors

def letters_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters as 0..89, offsets) of words over a-z and U+00C0 to U+00FF."""
    words = pa.array(words, pa.large_string()) if not isinstance(words, pa.Array) else words.cast(pa.large_string())
    offs = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    raw = words.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    lead = data == 0xC3
    before = np.concatenate(([0], np.cumsum(~lead)))
    kept = data[~lead]
    return np.where(kept >= 0x80, kept - 0x80 + 26, kept - 0x61).astype(np.uint8), before[offs - offs[0]]


def vectors_of(letters: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Letter counts (up to 127) of each word."""
    out = np.zeros((len(offs) - 1, LETTERS), np.int8)
    for lo in range(0, len(out), 8192):
        hi = min(lo + 8192, len(out))
        rows = np.repeat(np.arange(hi - lo), np.diff(offs[lo:hi + 1]))
        flat = np.bincount(rows * LETTERS + letters[offs[lo]:offs[hi]], minlength=(hi - lo) * LETTERS)
        out[lo:hi] = np.minimum(flat, 127).reshape(hi - lo, LETTERS)
    return out


@dataclass
class Tree:
    """A k-d tree: inner nodes (letter, border, left, right), leaves (~leaf number)."""
    nodes: list[tuple[int, int, int, int]] = field(default_factory=list)
    root: int = ~0
    leaves: int = 0

    def grow(self, points: np.ndarray, rows: np.ndarray, most: int, kept: list[np.ndarray] | None = None) -> int:
        """Split ``rows`` at the median of the widest letter until at most ``most`` points are left."""
        here = points[rows]
        if len(rows) > most:
            spread = here.max(0) - here.min(0) if len(rows) < 4 else here.std(0, dtype=np.float32)
            d = int(np.argmax(spread))
            border = int(np.sort(here[:, d])[(len(rows) - 1) // 2])
            low = here[:, d] <= border
            if low.all():
                border -= 1
                low = here[:, d] <= border
            if low.any():
                at = len(self.nodes)
                self.nodes.append((0, 0, 0, 0))
                left, right = self.grow(points, rows[low], most, kept), self.grow(points, rows[~low], most, kept)
                self.nodes[at] = (d, border, left, right)
                return at
        if kept is not None:
            kept.append(rows)
        self.leaves += 1
        return ~(self.leaves - 1)

    def search(self, asks: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``asks`` whose L1 ball touches the leaf's box)."""
        stack = [(self.root, np.arange(len(asks)), np.zeros(len(asks), np.int16), {})]
        while stack:
            node, rows, far, box = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield ~node, rows
                continue
            d, border, left, right = self.nodes[node]
            lo, hi = box.get(d, (-1, 128))
            q = asks[rows, d].astype(np.int16)
            old = np.maximum(lo - q, 0) + np.maximum(q - hi, 0)
            for child, lo2, hi2 in ((left, lo, border), (right, border + 1, hi)):
                dist = far - old + np.maximum(lo2 - q, 0) + np.maximum(q - hi2, 0)
                keep = dist <= radius
                stack.append((child, rows[keep], dist[keep], {**box, d: (lo2, hi2)}))


def fit_cells(words: DataFrame, total: int) -> dict[int, tuple[Tree, int]]:
    """Length to (tree, number of its first cell), fitted on a sample of the vocabulary."""
    sample = [r.word for r in words.orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS).select("word").collect()]
    letters, offs = letters_of(pa.array(sample, pa.string()))
    points, sizes = vectors_of(letters, offs), np.minimum(np.diff(offs), LUMP)
    per_cell = max(CELL_WORDS, -(-total // MAX_CELLS))
    most = max(8, int(per_cell * len(sample) / max(total, 1)))
    forest, first = {}, 0
    for size in range(LEAST_LENGTH, LUMP + 1):
        tree = Tree()
        tree.root = tree.grow(points, np.flatnonzero(sizes == size), most)
        forest[size] = (tree, first)
        first += tree.leaves
    return forest


def routes(words: pa.Array, forest: dict[int, tuple[Tree, int]]) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(cell, rows, asking) of a batch of words: its own cells and the cells it asks."""
    letters, offs = letters_of(words)
    points, sizes = vectors_of(letters, offs), np.diff(offs)
    for size in np.unique(np.minimum(sizes, LUMP)):
        tree, first = forest[int(size)]
        own = np.flatnonzero(np.minimum(sizes, LUMP) == size)
        for cell, rows in tree.search(points[own], 0):
            yield first + cell, own[rows], False
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        wanted: dict[int, int] = {}
        for other in (size - 1, size, size + 1):
            if other >= LEAST_LENGTH:
                key = min(int(other), LUMP)
                wanted[key] = max(wanted.get(key, 0), 2 if other == size else 1)
        for key, radius in wanted.items():
            tree, first = forest[key]
            for cell, rows in tree.search(points[own], radius):
                yield first + cell, own[rows], True


# ---------------------------------------------------------------- one cell

@dataclass
class Block:
    """The words of one length in a cell: letters, classes of equal vectors, signatures."""
    words: np.ndarray      # row numbers in the cell's table
    letters: np.ndarray    # (n, length)
    vectors: np.ndarray    # one per class
    klass: np.ndarray      # class of each word

    @classmethod
    def of(cls, rows: np.ndarray, letters: np.ndarray, offs: np.ndarray) -> Block:
        size = int(offs[rows[0] + 1] - offs[rows[0]])
        grid = letters[offs[rows][:, None] + np.arange(size)]
        counts = vectors_of(grid.reshape(-1), np.arange(len(rows) + 1) * size)
        _, first, klass = np.unique(counts.view(np.dtype((np.void, LETTERS))).ravel(), return_index=True, return_inverse=True)
        return cls(rows, grid, counts[first], klass.ravel())

    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whole, without the letter's place filled, with the letter taken out) per word and place."""
        size = self.letters.shape[1]
        up = np.full(size, _U(_STEP), _U)
        up[0] = 1
        np.multiply.accumulate(up, out=up)
        terms = _LETTER[self.letters] * up
        before = np.cumsum(terms, axis=1, dtype=_U)
        whole = before[:, -1]
        return whole, whole[:, None] - terms, (before - terms) + (whole[:, None] - before) * _BACK

    def entries(self, by_place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class * LETTERS + letter, word, signature) of every place, sorted by the first."""
        key = self.klass[:, None] * LETTERS + self.letters
        order = np.argsort(key, axis=None, kind="stable")
        return key.ravel()[order], order // self.letters.shape[1], by_place.ravel()[order]

    def members(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(self.klass, kind="stable")
        return self.klass[order], order, whole[order]


def class_pairs(asks: Block, points: Block, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of classes at exactly the distance ``radius``, found through the k-d tree of the points' vectors."""
    kept: list[np.ndarray] = []
    tree = Tree()
    tree.root = tree.grow(points.vectors, np.arange(len(points.vectors)), LEAF, kept)
    # counts in unary, so that the L1 distance is the number of differing bits
    top = np.maximum(asks.vectors.max(0), points.vectors.max(0))
    letter, level = np.repeat(np.arange(LETTERS), top), np.concatenate([np.arange(1, t + 1) for t in top])

    def unary(v: np.ndarray) -> np.ndarray:
        bits = np.packbits(v[:, letter] >= level, axis=1)
        wide = np.zeros((len(v), -(-bits.shape[1] // 8) * 8), np.uint8)
        wide[:, :bits.shape[1]] = bits
        return wide.view(_U)

    a, b = unary(asks.vectors), unary(points.vectors)
    for leaf, rows in tree.search(asks.vectors, radius):
        cols = kept[leaf]
        for lo in range(0, len(rows), 16384):
            some = rows[lo:lo + 16384]
            dist = np.zeros((len(some), len(cols)), np.uint16)
            for w in range(a.shape[1]):
                dist += np.bitwise_count(a[some, w][:, None] ^ b[cols, w][None, :])
            i, j = np.nonzero(dist == radius)
            if len(i):
                yield some[i], cols[j]


def expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(range number, position) of all positions of the ranges."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def matches(asks: Block, points: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ask, point) word pairs of one edit between two blocks, verified in letter order."""
    la, lp = asks.letters.shape[1], points.letters.shape[1]
    radius = 2 if la == lp else 1
    found = list(class_pairs(asks, points, radius))
    if not found:
        return
    qa, pa_ = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    whole_a, hole_a, out_a = asks.hashes()
    whole_p, hole_p, out_p = points.hashes()
    if la == lp:
        side_a, side_p = asks.entries(hole_a), points.entries(hole_p)
    elif la < lp:
        side_a, side_p = asks.members(whole_a), points.entries(out_p)
    else:
        side_a, side_p = asks.entries(out_a), points.members(whole_p)
    for lo in range(0, len(qa), 1 << 16):
        q, p = qa[lo:lo + (1 << 16)], pa_[lo:lo + (1 << 16)]
        diff = asks.vectors[q] - points.vectors[p]
        more, less = np.argmax(diff, axis=1), np.argmin(diff, axis=1)
        key_a = q * LETTERS + more if la >= lp else q
        key_p = p * LETTERS + less if la <= lp else p
        spans = [np.searchsorted(side[0], key, how) for side, key in ((side_a, key_a), (side_p, key_p)) for how in ("left", "right")]
        work = np.cumsum((spans[1] - spans[0]) + (spans[3] - spans[2]))
        cuts = np.unique(np.concatenate(([0], np.searchsorted(work, np.arange(CHUNK, work[-1], CHUNK)) + 1, [len(q)])))
        for a, b in zip(cuts[:-1], cuts[1:]):
            ka, at_a = expand(spans[0][a:b], spans[1][a:b])
            kp, at_p = expand(spans[2][a:b], spans[3][a:b])
            sign_a = side_a[2][at_a] + mix64(ka.astype(_U))
            sign_p = side_p[2][at_p] + mix64(kp.astype(_U))
            order = np.argsort(sign_p)
            sign_p = sign_p[order]
            first, last = np.searchsorted(sign_p, sign_a, "left"), np.searchsorted(sign_p, sign_a, "right")
            hit = np.flatnonzero(last > first)
            which, at = expand(first[hit], last[hit])
            x, y = side_a[1][at_a[hit[which]]], side_p[1][at_p[order[at]]]
            pair = np.unique(x * np.int64(len(points.words)) + y)
            x, y = pair // len(points.words), pair % len(points.words)
            ok = one_edit(asks.letters[x], points.letters[y])
            if ok.any():
                yield x[ok], y[ok]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two letter grids differ by exactly one edit (letters themselves, no hashes)."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    same = np.cumprod(a == b[:, :-1], axis=1).sum(1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return same + tail >= a.shape[1]


NEAR = "word string, n_near long, form_n long, form string"


def search_cell(table: pa.Table) -> pa.Table:
    """One row (word, n_near, form_n, form) per asking word of a cell that has near words there."""
    words = table.column("word").combine_chunks()
    counts, asking = table.column("n").to_numpy(), table.column("asking").to_numpy(zero_copy_only=False)
    letters, offs = letters_of(words)
    sizes = np.diff(offs)
    rank = np.empty(len(words), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
    n_near = np.zeros(len(words), np.int64)
    best = np.full(len(words), -1, np.int64)

    def blocks(mask: np.ndarray) -> dict[int, Block]:
        return {int(s): Block.of(np.flatnonzero(mask & (sizes == s)), letters, offs) for s in np.unique(sizes[mask])}

    points, asks = blocks(~asking), blocks(asking)
    for size, block in points.items():
        for other in (size - 1, size, size + 1):
            if other not in asks:
                continue
            for x, y in matches(asks[other], block):
                x, y = asks[other].words[x], block.words[y]
                n_near += np.bincount(x, minlength=len(words))
                order = np.lexsort((rank[y], -counts[y], x))
                x, y = x[order], y[order]
                lead = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
                x, y = x[lead], y[lead]
                now = best[x]
                better = (now < 0) | (counts[y] > counts[now]) | ((counts[y] == counts[now]) & (rank[y] < rank[now]))
                best[x[better]] = y[better]
    got = np.flatnonzero(n_near)
    return pa.table({"word": words.take(pa.array(got)).cast(pa.string()), "n_near": n_near[got], "form_n": counts[best[got]],
                     "form": words.take(pa.array(best[got])).cast(pa.string())})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): near words of every word that has some, and its most frequent one."""
    forest = fit_cells(words, words.count())

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter = Counter()
            for cell, rows, asking in routes(batch.column("word"), forest):
                n[cell, asking] += len(rows)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.int32()), pa.array([k[1] for k in n]),
                                                  pa.array(list(n.values()), pa.int64())], ["cell", "asking", "n"])

    # at most two rows per cell, and at most about MAX_CELLS cells
    parts = {}
    for r in words.mapInArrow(sizes, "cell int, asking boolean, n long").groupBy("cell", "asking").agg(F.sum("n").alias("n")).collect():
        parts[r.cell, r.asking] = -(-r.n // (CELL_ASKS if r.asking else CELL_WORDS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each word to its cell, and to the cells it asks; parts of points meet all parts of asks."""
        for batch in batches:
            data, offs = column_bytes(batch.column("word"))
            dealt = span_hash(data, offs[:-1], offs[1:])
            for cell, rows, asking in routes(batch.column("word"), forest):
                mine, others = parts[cell, asking], parts.get((cell, not asking), 0)
                if not others:
                    continue
                part = (dealt[rows] % _U(mine)).astype(np.int64)
                for other in range(others):
                    task = (part * others + other) if asking else (other * mine + part)
                    some = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), cell), pa.int32()), pa.array(task, pa.int32()),
                         pa.array(np.full(len(rows), asking)), some.column("word"), some.column("n")],
                        ["cell", "task", "asking", "word", "n"])

    dealt = words.mapInArrow(deal, "cell int, task int, asking boolean, word string, n long")
    some = dealt.groupBy("cell", "task").applyInArrow(search_cell, NEAR)
    first = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("w")))
    return some.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("form_n"), F.col("b.w").alias("form"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: forms followed to the last one.

    A form is ``TIMES`` as frequent as its word, so chains are as short as the
    logarithm of the largest count; each round doubles the steps taken.
    """
    step = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(step.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(step)
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        step = written(after.select("word", "root"), "roots")
        discard(after)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = written(count_words(docs, id_col, text_col), "words")
    near = near_words(words).join(words.select("word", "n"), "word")
    near = written(near.withColumn("fits", F.col("form_n") >= TIMES * F.col("n")).drop("n"), "near")
    ends = roots(near.where("fits"))
    fits = F.coalesce("fits", F.lit(False))
    return (words.join(near, "word", "left").join(ends, "word", "left")
                 .select("word", F.when(fits, F.col("form")).alias("form"), F.coalesce("root", "word").alias("root"),
                         "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(fits, F.col("form_n")).alias("form_n")))


def variants_sql() -> str:
    """DuckDB SQL of the same rows: near words by wildcards at every place."""
    letters = "".join(chr(c) for c in range(0xC0, 0x100))
    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, octet_length(encode(s)) + 1), "
           "lambda i: ('0x' || hex(encode(s))[2 * i - 1:2 * i])::BIGINT)), "
           "lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")
    return f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[a-z{letters}]+')) AS w FROM documents),
o AS (SELECT doc_id, w, count(*) AS n FROM r WHERE length(w) >= {LEAST_LENGTH} GROUP BY ALL),
s AS (SELECT w, n, coalesce(doc_id::VARCHAR, '') || ':' || w AS s FROM o),
h AS (SELECT w, n, {crc} AS h FROM s),
e AS (SELECT CASE WHEN h % {DELETE_MOD} = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w, n FROM h),
v AS (SELECT w AS word, sum(n)::BIGINT AS n FROM e WHERE length(w) >= {LEAST_LENGTH} GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT}),
p AS (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM v),
d AS (SELECT DISTINCT word, left(word, i - 1) || substr(word, i + 1) AS g FROM p),
x AS (SELECT word, left(word, i - 1) || '?' || substr(word, i + 1) AS g FROM p),
m AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b USING (g) WHERE a.word <> b.word
      UNION SELECT d.word, v.word FROM d JOIN v ON v.word = d.g UNION SELECT v.word, d.word FROM d JOIN v ON v.word = d.g),
k AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS rk
      FROM m JOIN v ON v.word = m.b),
f AS (SELECT v.word, v.n, coalesce(k.n_near, 0) AS n_near, CASE WHEN k.n >= {TIMES} * v.n THEN k.b END AS form,
             CASE WHEN k.n >= {TIMES} * v.n THEN k.n::DOUBLE END AS form_n FROM v LEFT JOIN k ON k.a = v.word AND k.rk = 1),
c AS (SELECT word, coalesce(form, word) AS last, 0 AS hops FROM f
      UNION ALL SELECT c.word, f.form, hops + 1 FROM c JOIN f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n
FROM f JOIN (SELECT word, arg_max(last, hops) AS root FROM c GROUP BY 1) t USING (word)"""
