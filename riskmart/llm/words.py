"""Words of many texts at once, as NumPy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and \\t..\\r; those six are single bytes in UTF-8, so
no character is ever cut. Words are known by 64-bit hashes: byte values weighted with powers of
an odd number, whose prefix sums give the hash of any word in constant time, and then mixed.
The same trick over word hashes gives the hash of any run of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, BLOCK_BYTES + 1)
            self.up, self.down = (self._first(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _first(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)


_BYTES, _WORDS, _OTHER_WORDS = _Powers(_ODD), _Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F)
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_LOWER_VALUES = _VALUES.copy()
_LOWER_VALUES[0x41:0x5B] = _VALUES[0x61:0x7B]  # A-Z as a-z


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in record batches of about ``size`` bytes of text; a longer text is one by itself."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


@dataclass
class Words:
    """Words of a block: their byte ranges, and the range of words of every row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray  # n + 1 offsets into starts

    def hashes(self, lower: bool = False) -> np.ndarray:
        up, down = _BYTES(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((_LOWER_VALUES if lower else _VALUES)[self.data] * up[1:], out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def words(column: pa.Array) -> Words:
    data, offsets = utf8(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # a row begins here
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


class Runs:
    """Hashes of runs of words; ``other`` gives a second, independent hash."""

    def __init__(self, hashes: np.ndarray, other: bool = False):
        up, self.down = (_OTHER_WORDS if other else _WORDS)(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum((hashes ^ np.uint64(_ODD) if other else hashes) * up[1:], out=self.sums[1:])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def of_length(self, length: int) -> np.ndarray:
        """Of the run from every word on that has so many words after it, over the ends of rows too."""
        starts = np.arange(max(0, len(self.sums) - length))
        return self.between(starts, starts + length)


def inside_rows(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, first word) of every run of ``length`` words that lies within a row."""
    counts = np.maximum(np.diff(rows) - length + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    return row, spans(rows[:-1], counts)


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every start, ``count`` numbers each."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)
