"""Toxicity by a subsequence string-kernel support vector machine.

Two words are compared by the gap-weighted subsequence kernel: every sequence of three or four of
their characters, in order, counts ``decay`` to the power of the stretch it spans (at most ``SPAN``
characters), so a word keeps most of its likeness when characters are inserted, left out or separated
by punctuation. Word ends are characters of their own. The kernel is normalised.

The machine works in the Nystroem space of ``landmarks`` words: a word is described by its kernel
values with the landmarks, whitened by their own kernel matrix, and a linear squared-hinge machine is fitted
there. Its decision is a weighted sum of kernel values, so it folds into one weight per subsequence,
and a word is scored exactly by looking its subsequences up, without touching the landmarks.

Labels belong to texts, while a few words of a text carry its toxicity. So the machine is trained on
labelled texts as bags of words: all words of clean texts are negative, and each toxic text gives
its highest-scoring word as a positive, beside telling words; the hardest are drawn anew in ``ROUNDS`` rounds. A word is telling by its
ratio of toxic to clean texts, and only while there are toxic texts with fewer than ``TOP`` telling words: so a family of words with one
beginning counts though clean texts hold a few of it, and chance words of a text that occurs many times do not.
A logistic curve, fitted on set-aside labelled texts, turns the ``TOP`` highest word decisions of a
text and its length into a score from 0 to 1.

Training takes at most ``MAX_TEXTS`` labelled texts of each class (those of the smallest seeded hash, of up to
``MAX_CHARS`` characters); scoring covers every text whole. Words are runs between white space without the
punctuation at their ends; four or more single characters in a row ("a b c d") are one word.

Cases: null, empty and word-free texts have the lowest score. Very long words are scored in overlapping
parts, so no subsequence is lost. Without labelled texts of both classes every score is 0. Repeated rows score alike;
other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textcols as tc

MAX_TEXTS = 2500
MAX_CHARS = 20_000
LANDMARKS = 384
ROUNDS = 4
DECAY = 0.7
SPAN = 6
THRESHOLD = 0.7
SEED = 5
CHUNK, OVERLAP = 24, SPAN
FLOOR = 0.05  # normalised decisions under this are not told apart
TOP = 3  # highest word decisions of a text that its score is made of
SIGNAL = 6.0  # likelihood ratio of a run of symbols that alone makes a word telling
RATIO = 3.0  # logarithm of the ratio of toxic to clean texts from which a word is telling
SUPPORT = 3  # toxic texts that a telling word is in
_BEGIN, _END = 30, 31
_U = np.uint64

# byte -> symbol: letters 1-26, digits as the letter they stand in for or 27; 0 is a gap. Letters of
# other scripts share the 26 symbols by their last byte.
SYMBOL = np.zeros(256, np.uint8)
SYMBOL[0x61:0x7B] = np.arange(1, 27)
SYMBOL[0x30:0x3A] = [ord(c) - 96 if c != "." else 27 for c in "oi.eas.t.."]
SYMBOL[0x80:0xC0] = np.arange(64) % 26 + 1
# Latin letters with marks (second byte after 0xC3) -> base letter
_MARKED = np.arange(256, dtype=np.uint8)
_MARKED[0xA0:0xC0] = [ord(c) for c in "aaaaaaaceeeeiiiidnooooo/ouuuuyty"]
# offsets of the characters after the first, per subsequence length; four characters come first in the table
_STEPS = [c for n in (2, 3) for c in combinations(range(1, SPAN), n)]
_FOUR = 1 << 20
_SLOTS = _FOUR + (1 << 15)


def slots(symbols: np.ndarray, steps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, valid) of the subsequence with these steps at each column of a symbol matrix."""
    width = symbols.shape[1] - steps[-1]
    code = symbols[:, :width].astype(np.int64)
    valid = code > 0
    for k, step in enumerate(steps, 1):
        nxt = symbols[:, step:step + width]
        valid &= nxt > 0
        code |= nxt.astype(np.int64) << (5 * k)
    return (code if len(steps) == 3 else code + _FOUR), valid


def lowered(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased text as one byte per character (the last byte of multi-byte characters,
    the base letter of marked Latin ones), and offsets."""
    data, offs = tc.column_bytes(pc.utf8_lower(pc.fill_null(col, "")))
    latin = np.flatnonzero(data == 0xC3) + 1
    if len(latin):
        data = data.copy()
        data[latin] = _MARKED[data[latin]]
    keep = data < 0xC0
    kept = np.r_[0, np.cumsum(keep)]
    return data[keep], kept[offs]


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words of each text, ends stripped of punctuation,
    and of runs of four or more single characters."""
    starts, ends, bounds = tc.word_spans(data, offs, tc.WHITE_SPACE)
    row = tc.row_of(bounds)
    solid = SYMBOL[data] > 0
    where = np.flatnonzero(solid)
    before = np.r_[0, np.cumsum(solid)]
    some = before[ends] > before[starts]
    starts, ends, row = starts[some], ends[some], row[some]
    starts, ends = where[before[starts]], where[before[ends] - 1] + 1
    single = ends - starts == 1
    if single.any():
        # words of a text that are single characters and follow each other closely
        chained = single[1:] & single[:-1] & (row[1:] == row[:-1]) & (starts[1:] - ends[:-1] <= 2)
        begin = np.flatnonzero(np.r_[True, ~chained])
        last = np.r_[begin[1:], len(single)] - 1
        long = last - begin >= 3
        starts = np.r_[starts, starts[begin[long]]]
        ends = np.r_[ends, ends[last[long]]]
        row = np.r_[row, row[begin[long]]]
    return starts, ends, row


def matrices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word number, symbol matrix) groups of the words, in parts of at most CHUNK characters
    that overlap by SPAN; words begin and end with their own symbols."""
    size = ends - starts
    parts = np.maximum(1, -(-(size - OVERLAP) // (CHUNK - OVERLAP)))
    word = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = starts[word] + nth * (CHUNK - OVERLAP)
    end = np.minimum(begin + CHUNK, ends[word])
    length = end - begin
    order = np.argsort(length, kind="stable")
    for lo, hi in ((0, 5), (5, 8), (8, 11), (11, 15), (15, CHUNK)):
        pick = order[np.searchsorted(length[order], lo, "right"):np.searchsorted(length[order], hi, "right")]
        if not len(pick):
            continue
        width = hi + 2 + SPAN  # zeros at the end stand for "no character"
        at = np.arange(hi)
        inside = at < length[pick, None]
        m = np.zeros((len(pick), width), np.uint8)
        m[:, 1:hi + 1] = np.where(inside, SYMBOL[data[np.minimum(begin[pick, None] + at, len(data) - 1)]], 0)
        first = nth[pick] == 0
        final = end[pick] == ends[word[pick]]
        m[first, 0] = _BEGIN
        m[np.flatnonzero(final), length[pick][final] + 1] = _END
        yield word[pick], m


def features(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, weight) of the subsequences of each row, equal slots added up."""
    out = []
    for steps in _STEPS:
        code, valid = slots(m, steps)
        r, c = np.nonzero(valid)
        out.append((r, code[r, c], np.full(len(r), DECAY ** (steps[-1] + 1))))
    row, slot, weight = (np.concatenate(x) for x in zip(*out))
    both, inverse = np.unique(row.astype(np.int64) * _SLOTS + slot, return_inverse=True)
    return both // _SLOTS, both % _SLOTS, np.bincount(inverse, weight, len(both))


class Machine:
    """Weight per subsequence slot, and the logistic curve of text scores."""

    CACHE = 1_000_000

    def __init__(self, slot: np.ndarray, weight: np.ndarray):
        self.slot, self.weight = slot, weight.astype(np.float32)
        self.curve = np.zeros(TOP + 2)
        self._reset()

    def _reset(self) -> None:
        self._table: np.ndarray | None = None
        self._known, self._value = np.zeros(0, _U), np.zeros(0)

    def __getstate__(self):
        return {"slot": self.slot, "weight": self.weight, "curve": self.curve}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    @property
    def table(self) -> np.ndarray:
        if self._table is None:
            self._table = np.zeros(_SLOTS, np.float32)
            self._table[self.slot] = self.weight
        return self._table

    def decisions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Normalised decision of every word, FLOOR where it is not above it."""
        out = np.full(len(starts), FLOOR, np.float64)
        for word, m in matrices(data, starts, ends):
            m = m.astype(np.uint32)
            shifted = [m, m << 5, m << 10, m << 15]
            raw = np.zeros(len(m), np.float32)
            for steps in _STEPS:
                width = m.shape[1] - steps[-1]
                code = m[:, :width].copy()
                for k, step in enumerate(steps, 1):
                    code |= shifted[k][:, step:step + width]
                if len(steps) == 2:
                    code += _FOUR
                # a slot with a gap in it has no weight
                raw += np.float32(DECAY ** (steps[-1] + 1)) * np.take(self.table, code).sum(axis=1)
            # without gaps and repeats the norm follows from the length; with repeats it is larger
            filled = (m > 0).sum(axis=1)
            extent = m.shape[1] - np.argmax(m[:, ::-1] > 0, axis=1) - np.argmax(m > 0, axis=1)
            least = np.zeros(len(m))
            for steps in _STEPS:
                least += DECAY ** (2 * (steps[-1] + 1)) * np.maximum(0, extent - steps[-1])
            least[filled < extent] = 0
            likely = np.flatnonzero((raw > 0) & (raw > FLOOR * np.sqrt(least)))
            for i in range(0, len(likely), 2000):
                part = likely[i:i + 2000]
                row, _, weight = features(m[part])
                norm = np.sqrt(np.bincount(row, weight * weight, len(part)))
                np.maximum.at(out, word[part], raw[part] / np.maximum(norm, 1e-12))
        return out

    def cached(self, key: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Decisions of distinct words, remembered by their hash (bounded; words recur in all texts)."""
        out = np.empty(len(key))
        at = np.minimum(np.searchsorted(self._known, key), max(len(self._known) - 1, 0))
        old = self._known[at] == key if len(self._known) else np.zeros(len(key), bool)
        out[old] = self._value[at[old]]
        new = ~old
        if new.any():
            out[new] = self.decisions(data, starts[new], ends[new])
            if len(self._known) > self.CACHE:
                self._known, self._value = np.zeros(0, _U), np.zeros(0)
            known = np.r_[self._known, key[new]]
            order = np.argsort(known, kind="stable")
            self._known, self._value = known[order], np.r_[self._value, out[new]][order]
        return out

    def text_values(self, col: pa.Array) -> np.ndarray:
        """(texts, TOP + 2): the highest word decisions, the logarithm of the number of words, and 1."""
        data, offs = lowered(col)
        starts, ends, row = words(data, offs)
        out = np.full((len(col), TOP + 2), FLOOR)
        out[:, TOP] = np.log1p(np.bincount(row, minlength=len(col)))
        out[:, TOP + 1] = 1.0
        if len(starts):
            key, first, inverse = np.unique(tc.span_hash(data, starts, ends), return_index=True, return_inverse=True)
            value = self.cached(key, data, starts[first], ends[first])[inverse]
            high = np.flatnonzero(value > FLOOR)
            order = high[np.lexsort((-value[high], row[high]))]
            place = np.arange(len(order)) - np.searchsorted(row[order], row[order], "left")
            top = place < TOP
            out[row[order][top], place[top]] = value[order][top]
        return out

    def scores(self, col: pa.Array) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.text_values(col) @ self.curve, -40, 40)))


# -- training ----------------------------------------------------------------

def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear machine of y (-1, 1) on x with weighted squared hinge loss, by Newton steps."""
    x1 = np.c_[x, np.ones(len(x))]
    v = np.zeros(x1.shape[1])
    ridge = np.full(x1.shape[1], penalty)
    ridge[-1] = 1e-9

    def loss(v):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        return (ridge * v * v).sum() + (weight * slack * slack).sum()

    for _ in range(30):
        slack = 1 - y * (x1 @ v)
        on = slack > 0
        a = x1[on] * np.sqrt(weight[on])[:, None]
        grad = ridge * v - x1[on].T @ (weight[on] * y[on] * slack[on])
        step = np.linalg.solve(a.T @ a + np.diag(ridge), grad)
        size, now = 1.0, loss(v)
        while loss(v - size * step) > now and size > 1e-4:
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return v[:-1], v[-1]


class Bags:
    """Distinct words of labelled texts and which text has which."""

    def __init__(self, texts: list[str], toxic: np.ndarray):
        self.toxic = toxic
        size = np.array([len(t) for t in texts])
        keys, data, starts, ends, text, key = [], [], [], [], [], []
        base = 0
        for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(np.cumsum(size) // tc.PIECE_BYTES)) + 1):
            raw, offs = lowered(pa.array([texts[i] for i in part], pa.string()))
            begin, end, row = words(raw, offs)
            if not len(begin):
                continue
            found, first, inverse = np.unique(tc.span_hash(raw, begin, end), return_index=True, return_inverse=True)
            # of every piece, only the characters of its distinct words are kept
            length = (end - begin)[first]
            at = np.cumsum(length) - length
            data.append(raw[np.repeat(begin[first] - at, length) + np.arange(length.sum())])
            starts.append(at + base)
            ends.append(at + length + base)
            base += int(length.sum())
            keys.append(found)
            pair = np.unique(row.astype(np.int64) * len(found) + inverse)
            text.append(part[pair // len(found)].astype(np.int32))
            key.append(found[pair % len(found)])
        none = [np.zeros(0, np.int64)]
        _, first = np.unique(np.concatenate(keys or none), return_index=True)
        self.data = np.concatenate(data or [np.zeros(0, np.uint8)])
        self.starts, self.ends = np.concatenate(starts or none)[first], np.concatenate(ends or none)[first]
        self.text = np.concatenate(text or none)
        self.word = np.searchsorted(np.concatenate(keys or none)[first], np.concatenate(key or none)).astype(np.int32)

    def rows(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in ``pick``, slot, weight), normalised; a long word is described by its first part."""
        out = []
        for word, m in matrices(self.data, self.starts[pick], self.ends[pick]):
            once = np.unique(word, return_index=True)[1]
            for i in range(0, len(once), 2000):
                r, s, w = features(m[once[i:i + 2000]])
                norm = np.sqrt(np.bincount(r, w * w))
                out.append((word[once[i:i + 2000]][r], s, (w / norm[r]).astype(np.float32)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def first_signal(self) -> np.ndarray:
        """Per word, the strongest signed likelihood ratio of its runs of four symbols with toxic texts."""
        run, owner = [], []
        for word, m in matrices(self.data, self.starts, self.ends):
            code, valid = slots(m, (1, 2, 3))
            r, c = np.nonzero(valid)
            run.append(code[r, c].astype(np.int32))
            owner.append(word[r].astype(np.int32))
        out = np.zeros(len(self.starts))
        if not run:
            return out
        run, owner = np.concatenate(run), np.concatenate(owner)
        _, run = np.unique(run, return_inverse=True)
        order = np.argsort(owner, kind="stable")
        run, owner = run[order], owner[order]
        bounds = np.searchsorted(owner, np.arange(len(out) + 1))
        n = int(run.max()) + 1
        t, c = np.zeros(n, np.int64), np.zeros(n, np.int64)
        cuts = np.searchsorted(self.text, np.arange(0, len(self.toxic) + 250, 250))
        for i, j in zip(cuts[:-1], cuts[1:]):  # some texts at a time
            held = np.diff(bounds)[self.word[i:j]]
            at = np.repeat(bounds[self.word[i:j]], held) + np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
            seen = np.unique(np.repeat(self.text[i:j], held).astype(np.int64) * n + run[at])
            toxic = self.toxic[seen // n] == 1
            t += np.bincount(seen[toxic] % n, minlength=n)
            c += np.bincount(seen[~toxic] % n, minlength=n)
        nt, nc = max(1, self.toxic.sum()), max(1, len(self.toxic) - self.toxic.sum())
        pt, p0 = (t + 0.5) / (nt + 1), (c + 0.5) / (nc + 1)
        ratio = np.where(pt > p0, t * np.log(pt / p0), 0) - c * np.abs(np.log(pt / p0))
        np.maximum.at(out, owner, ratio[run])
        return out

    def telling(self, signal: np.ndarray) -> np.ndarray:
        """Words that tell toxic texts, the strongest first taken: each is in at least SUPPORT toxic texts that
        have fewer than TOP stronger ones. Words of no clean text and a strong run of symbols are always among them."""
        on = self.toxic[self.text] == 1
        t, c = (np.bincount(self.word[x], minlength=len(self.starts)) for x in (on, ~on))
        nt = self.toxic.sum()
        ratio = np.log((t + 0.5) / (nt + 1)) - np.log((c + 0.5) / (len(self.toxic) - nt + 1))
        always = (signal >= SIGNAL) & (t >= SUPPORT) & (c == 0)
        likely = np.flatnonzero((t >= SUPPORT) & (ratio >= RATIO))
        order = np.argsort(self.word[on], kind="stable")
        word, text = self.word[on][order], self.text[on][order]
        covered = np.zeros(len(self.toxic), np.int64)
        for w in likely[np.argsort(-(t * ratio)[likely], kind="stable")]:
            held = text[np.searchsorted(word, w, "left"):np.searchsorted(word, w, "right")]
            if (covered[held] < TOP).sum() >= SUPPORT:
                always[w] = True
                covered[held] += 1
        return np.flatnonzero(always)

    def best(self, score: np.ndarray, of: int) -> np.ndarray:
        """Highest-scoring word of every text of class ``of``."""
        order = np.lexsort((self.word, score[self.word], self.text))
        last = np.flatnonzero(np.r_[np.diff(self.text[order]) != 0, True]) if len(order) else order
        pick = order[last]
        return self.word[pick][self.toxic[self.text[pick]] == of]


def train(texts: list[str], toxic: list[int], landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Machine | None:
    """Machine from labelled texts; None unless both classes are there."""
    toxic = np.asarray(toxic, int)
    if not 0 < toxic.sum() < len(toxic):
        return None
    rng = np.random.default_rng(SEED)
    # every fifth text of a class is set aside for the logistic curve, if there are enough
    nth = np.zeros(len(toxic), int)
    for y in (0, 1):
        nth[toxic == y] = np.arange((toxic == y).sum())
    aside = (nth % 5 == 4) if min(toxic.sum(), len(toxic) - toxic.sum()) >= 10 else np.zeros(len(toxic), bool)
    bags = Bags([t for t, a in zip(texts, aside) if not a], toxic[~aside])
    if not len(bags.starts):
        return None
    in_clean = np.zeros(len(bags.starts), bool)
    in_clean[bags.word[bags.toxic[bags.text] == 0]] = True
    score = bags.first_signal()
    # telling words are positive from the start, also those that some clean texts have
    in_toxic = np.bincount(bags.word[bags.toxic[bags.text] == 1], minlength=len(bags.starts))
    telling = bags.telling(score)
    in_clean[telling] = False
    clean = np.flatnonzero(in_clean)
    drawn = rng.permutation(clean)[:6000]
    hard = np.zeros(0, int)
    machine = None
    for _ in range(rounds):
        witness = bags.best(score, 1)
        witness = witness[~in_clean[witness]] if (~in_clean[witness]).any() else witness
        positive = np.union1d(witness, telling)
        count = np.maximum(1, in_toxic[positive])
        hard = np.union1d(hard, bags.best(score, 0))
        hard = hard[np.argsort(-score[hard], kind="stable")][:4000]
        negative = np.setdiff1d(np.union1d(drawn, hard), positive)
        if not len(positive) or not len(negative):
            break
        often = positive[np.argsort(-count, kind="stable")]
        near = hard[np.argsort(-score[hard], kind="stable")]
        marks = np.unique(np.r_[often[:landmarks // 2], near[:landmarks // 4], drawn[:landmarks // 4]])
        machine = _fit(bags, marks, positive, count, negative)
        score = machine.decisions(bags.data, bags.starts, bags.ends)
    if machine is None:
        return None
    held = aside if aside.any() else np.ones(len(toxic), bool)
    values = machine.text_values(pa.array([t for t, a in zip(texts, held) if a], pa.string()))
    machine.curve = signed_logistic(values, toxic[held])
    return machine


def _fit(bags: Bags, marks: np.ndarray, positive: np.ndarray, count: np.ndarray, negative: np.ndarray) -> Machine:
    """Nystroem map of the landmarks, linear machine, and its weights per subsequence."""
    r, s, w = bags.rows(marks)
    slot, column = np.unique(s, return_inverse=True)
    phi = np.zeros((len(marks), len(slot)), np.float32)
    phi[r, column] = w
    gram = (phi @ phi.T).astype(np.float64)
    value, vector = np.linalg.eigh(gram)
    good = value > 1e-6 * value.max()
    whiten = vector[:, good] / np.sqrt(value[good])

    def describe(pick: np.ndarray) -> np.ndarray:
        r, s, w = bags.rows(pick)
        at = np.minimum(np.searchsorted(slot, s), len(slot) - 1)
        on = slot[at] == s
        r, at, w = r[on], at[on], w[on]
        order = np.argsort(r, kind="stable")
        r, at, w = r[order], at[order], w[order]
        k = np.zeros((len(pick), len(marks)), np.float32)
        step = 200
        for base in range(0, len(pick), step):
            a, b = np.searchsorted(r, (base, base + step))
            dense = np.zeros((min(step, len(pick) - base), len(slot)), np.float32)
            dense[r[a:b] - base, at[a:b]] = w[a:b]
            k[base:base + step] = dense @ phi.T
        return k @ whiten

    x = np.r_[describe(positive), describe(negative)]
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    mass = np.r_[np.sqrt(count), np.ones(len(negative))]
    mass[:len(positive)] /= mass[:len(positive)].sum()
    mass[len(positive):] /= mass[len(positive):].sum()
    v, b = squared_hinge(x, y, mass)
    # the decision without its constant, which the logistic curve takes over
    beta = (whiten @ v).astype(np.float32) @ phi
    return Machine(slot, beta)


def signed_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic curve that never falls with a word decision and never rises with the number of words;
    a term that would is left out."""
    sign = np.r_[np.ones(TOP), -1.0, 0.0]
    on = np.ones(len(sign), bool)
    while True:
        v = np.zeros(len(sign))
        v[on] = logistic(x[:, on], y)
        wrong = (v * sign < 0) & on
        if not wrong.any():
            return v
        on[np.argmin(np.where(wrong, v * sign, 0))] = False


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients of P(y=1 | x), classes weighed alike and targets smoothed (Platt), by Newton steps."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, 0.5 / max(n1, 1), 0.5 / max(n0, 1)) * len(y)
    v = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        grad = x.T @ (weight * (p - target)) + ridge * len(y) * v / 10
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(v)) * ridge * len(y) / 10
        step = np.linalg.solve(h, grad)
        v -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return v


# -- Spark -------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_texts: int = MAX_TEXTS, max_chars: int = MAX_CHARS) -> Machine | None:
    """Machine trained on a bounded sample of the labelled, not held-out documents."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
                   .groupBy(id_col).agg(F.max(label_col).alias("toxic")))
    draw = F.md5(F.concat(F.lit(f"{SEED}|"), F.col(id_col).cast("string")))
    # at most max_texts ids of a class, so the broadcast and the training task are bounded
    of = [known.where(F.col("toxic") == y).orderBy(draw).limit(max_texts) for y in (0, 1)]
    ids = of[0].unionByName(of[1]).select(F.col(id_col).alias("_known"), F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.length("_text") <= max_chars)
    sample = texts.join(F.broadcast(ids), F.col("_id") == F.col("_known")).select("_id", "_text", "toxic").limit(4 * max_texts)

    def fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column(2).to_pylist(), map(str, b.column(0).to_pylist()),
                                                b.column(1).to_pylist())]
        rows.sort()
        machine = train([r[2] for r in rows], [r[0] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(machine)], pa.binary())], ["machine"])

    # fitted in one task on the bounded sample; the driver receives the weights only
    got = sample.repartition(1).mapInArrow(fit_sample, "machine binary").collect()
    return pickle.loads(got[0][0]) if got else None


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()
    if machine is None:
        return docs.select(id_col, held_out(F.col(id_col)).alias("held_out"), F.lit(0.0).alias("score"),
                           F.lit(0).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _ in tc.pieces(batch, text_col):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(id_col), pa.array(machine.scores(rows.column(text_col)))], ["id", "score"])

    scored = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, machine: Machine | None, text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores under the threshold, with all their columns, without a shuffle."""
    if machine is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _ in tc.pieces(batch, text_col):
                yield rows.filter(pa.array(machine.scores(rows.column(text_col)) < threshold))

    return docs.mapInArrow(run, docs.schema)
