"""Whole-column text work inside Arrow tasks.

A batch of texts is one byte buffer plus offsets. Words, their hashes and the
hashes of word windows are computed for the whole buffer with numpy, so the
cost per character is a few array operations and no Python object is made
per word. Batches are cut into pieces of bounded bytes; a single text is never cut.

Hashes: a word's hash is the polynomial sum of a random 64-bit value per byte
in an odd base modulo 2**64, finished by a mixing function. It depends on the
bytes alone, so it is the same in every task and on every retry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD6E8FEB86659FD93 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finishing function of a 64-bit hash (a bijection)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=_U) * _U(0xA0761D6478BD642F))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, _U(b), _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_CHARS, _WINDOWS = _Powers(_BASE), _Powers(_WINDOW_BASE)

# word separators: the bytes that end a word
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# everything in ASCII but digits and letters
NON_WORD = np.zeros(256, bool)
NON_WORD[:0x80] = True
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    NON_WORD[_lo:_hi] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def column_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    binary = col.type in (pa.binary(), pa.large_binary())
    wide = pa.large_binary() if binary else pa.large_string()
    if col.null_count:
        col = col.fill_null(b"" if binary else "")
    col = col.cast(wide)
    n = len(col)
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, col: str, piece_bytes: int = PIECE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive rows with about ``piece_bytes`` of text."""
    data, offs = column_bytes(batch.column(col))
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + piece_bytes, "right")) - 1
        j = min(max(j, i + 1), n)
        yield batch.slice(i, j - i), data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, separator: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text plus total) of all words; no word crosses a text."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separator[data]
    begins = inside[1:-1] & ~inside[:-2]
    cuts = offs[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] |= inside[1:-1][cuts]
    starts = np.flatnonzero(begins)
    ends_here = inside[1:-1] & ~inside[2:]
    ends_here[cuts[cuts > 0] - 1] |= inside[1:-1][cuts[cuts > 0] - 1]
    ends = np.flatnonzero(ends_here) + 1
    return starts, ends, np.searchsorted(starts, offs, "left")


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    up, down = _CHARS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE_VALUE[data] * up[:len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def window_hash(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` word hashes (len(words) - size + 1 of them)."""
    n = len(words)
    if n < size:
        return np.zeros(0, _U)
    up, down = _WINDOWS.upto(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(words * up[:n], out=sums[1:])
    at = np.arange(n - size + 1)
    return mix64((sums[at + size] - sums[at]) * down[at])


def run_hash(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of each run words[first:last]."""
    up, down = _WINDOWS.upto(len(words) + 1)
    sums = np.zeros(len(words) + 1, _U)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    return mix64((sums[last] - sums[first]) * down[first] + (last - first).astype(_U))


def row_of(bounds: np.ndarray) -> np.ndarray:
    """Row number of every item of rows that are delimited by ``bounds``."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def list_column(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column of consecutive slices of ``values``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.astype(_U, copy=False).view(np.int64)
