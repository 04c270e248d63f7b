"""Words of many texts at once, as numpy arrays over an Arrow binary column.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return; texts are UTF-8, so this equals the regular expression
``[^\\x20\\x09-\\x0D]+``. Nothing is decoded and no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SAME = np.arange(256)
LOWER = np.where((SAME >= 65) & (SAME <= 90), SAME + 32, SAME)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_VALUES = mixed(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least ``n``."""
    if base not in _powers or len(_powers[base][0]) < n:
        room = max(n, 1 << 16)
        up, down = np.empty(room, _U), np.empty(room, _U)
        up[0] = down[0] = 1
        up[1:], down[1:] = _U(base), _U(pow(base, -1, 1 << 64))
        _powers[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[base]


class PrefixHash:
    """Polynomial hashes of any stretch of a sequence, each in constant time."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(values * self.up[:n], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.down[begin]


def byte_values(data: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """A random 64-bit number for each byte."""
    return _VALUES[fold][data]


@dataclass
class Words:
    """Words of some texts: where each lies in ``data``, and the words of text ``i``
    are those from ``first[i]`` up to ``first[i + 1]``."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, fold: np.ndarray = SAME) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever it stands: a sum of random numbers, one for each byte
        and place in the word. Powers of one base modulo 2^64 would do for short words, but
        give long ones of a doubling pattern (Thue and Morse) one hash."""
        n, sizes = len(self.data), self.end - self.begin
        place = np.arange(n)
        place -= np.repeat(np.r_[0, self.begin], np.diff(np.r_[0, self.begin, n]))
        sums = np.zeros(n + 1, _U)
        np.cumsum(mixed(byte_values(self.data, fold) + place.astype(_U) * _U(_BASE)), out=sums[1:])
        return mixed(sums[self.end] - sums[self.begin] + sizes.astype(_U))

    def text_of(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def find_words(data: np.ndarray, edges: np.ndarray) -> Words:
    """``edges``: where each text begins, and the end of the last."""
    inside = ~SPACE[data]
    n = len(data)
    after = np.zeros(n + 1, bool)
    after[1:] = inside
    cut = edges[edges < n]
    opens = inside.copy()
    held = after[:-1].copy()
    held[cut] = False
    opens &= ~held
    begin = np.flatnonzero(opens)
    before = np.zeros(n, bool)
    before[:-1] = inside[1:]
    before[cut[cut > 0] - 1] = False
    end = np.flatnonzero(inside & ~before) + 1
    return Words(data, begin, end, np.searchsorted(begin, edges))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, edges) of a binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    edges = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    edges = edges[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, edges


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, edges) of stretches of about ``limit`` bytes; a
    longer text is a stretch of its own."""
    if not len(column):
        return
    data, edges = buffers(column)
    row, n = 0, len(edges) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(edges, edges[row] + limit, side="right")) - 1)
        yield row, end, data[edges[row] : edges[end]], edges[row : end + 1] - edges[row]
        row = end


def word_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    for low, high, data, edges in slices(column, limit):
        yield low, high, find_words(data, edges)
