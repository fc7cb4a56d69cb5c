"""Texts of an Arrow batch as flat numpy arrays: words, 64-bit hashes, shingles.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``; A-Z are lower-cased on
request. Hashes are polynomials over the bytes modulo 2**64, passed through a mixer, so a
whole slice of texts is hashed by a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts are worked on in slices of about this size; a task holds some hundred bytes for each

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2**64."""
    if len(_powers["up"]) <= n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(n + 1, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offsets of its rows; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows of about ``limit`` bytes."""
    data, offsets = flat(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


class Words:
    """The words of some rows: byte ranges, rows, hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets, self.rows = offsets, len(offsets) - 1
        size = len(data)
        space = _SPACE[data]
        first = np.zeros(size + 1, bool)
        first[offsets] = True
        begins = ~space & first[:-1]
        begins[1:] |= ~space[1:] & space[:-1]
        ends = ~space & first[1:]
        ends[:-1] |= ~space[:-1] & space[1:]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.row, minlength=self.rows) if len(self.row) else np.zeros(self.rows, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.count)])
        self._prefix = self._hashes = None

    def prefix(self) -> np.ndarray:
        if self._prefix is None:
            up, _ = powers(len(self.data))
            self._prefix = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=self._prefix[1:])
        return self._prefix

    def hash_ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; equal bytes have equal hashes wherever they lie."""
        prefix, (_, down) = self.prefix(), powers(len(self.data))
        value = (prefix[end] - prefix[start]) * down[start]
        return mix(value + (end - start).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = self.hash_ranges(self.start, self.end)
        return self._hashes

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every window of ``width`` words of a row, in order."""
        words = self.hashes()
        n = max(0, len(words) - width + 1)
        first = np.flatnonzero(self.row[:n] == self.row[width - 1 : width - 1 + n])
        value = np.zeros(n, np.uint64)
        for j in range(width):
            value = value * _FACTOR + words[j : j + n]
        return first, mix(value[first] + np.uint64(width))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every window of ``width`` words, in order of rows; a row of fewer
        words gives its whole sequence as one shingle."""
        first, value = self.windows(width)
        row = self.row[first]
        few = np.flatnonzero((self.count > 0) & (self.count < width))
        if len(few):
            words = self.hashes()
            whole = np.zeros(len(few), np.uint64)
            for j in range(width - 1):
                more = self.count[few] > j
                whole[more] = whole[more] * _FACTOR + words[self.bounds[few[more]] + j]
            row = np.concatenate([row, few])
            value = np.concatenate([value, mix(whole + self.count[few].astype(np.uint64))])
            order = np.argsort(row, kind="stable")
            row, value = row[order], value[order]
        return row, value


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
