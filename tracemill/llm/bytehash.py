"""Numpy helpers over UTF-8 bytes: hashes of byte ranges and of words, for many texts at once.

Everything works on bounded pieces, so a very long text costs time but no memory beyond its own bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass works on.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _table(base: int, size: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        n = max(size, PIECE + 4096)
        have = np.full(n, base, dtype=np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:size]


def _spread() -> np.ndarray:
    """A 64-bit number for each byte value."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    return mixed(x)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


SPREAD = _spread()


class Prefix:
    """Polynomial hashes of ranges of one piece of bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        terms = SPREAD[data]
        with np.errstate(over="ignore"):
            terms *= _table(_BASE, n)
        np.cumsum(terms, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hashes of data[start:end], for arrays of starts and ends."""
        inverse = _table(_INVERSE, len(self.sums))
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * inverse[start]


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after the other, and offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups_of_rows(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have at most that many bytes together, or one row that has more."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the runs of non-white bytes, A-Z lower-cased."""
    hashes, starts, a, n = [], [], 0, len(data)
    while a < n:
        b = min(n, a + PIECE)
        if b < n:  # cut where a word ends
            white = np.flatnonzero(_SPACE[data[a:b]])
            while not len(white) and b < n:
                b = min(n, b + PIECE)
                white = np.flatnonzero(_SPACE[data[a:b]])
            if len(white) and b < n:
                b = a + int(white[-1]) + 1
        part = _LOWER[data[a:b]]
        edge = np.diff(np.concatenate(([0], (~_SPACE[part]).view(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashes.append(mixed(Prefix(part).of(first, last)))
        starts.append(first + a)
        a = b
    none = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    return np.concatenate(hashes or none[0]), np.concatenate(starts or none[1])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every `size` words in a row; of all words if there are fewer, but not none."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    with np.errstate(over="ignore"):
        out = np.full(n - size + 1, size, dtype=np.uint64)
        for j in range(size):
            out = mixed(out * np.uint64(0x9FB21C651E98DF25) + words[j : n - size + 1 + j])
    return out
