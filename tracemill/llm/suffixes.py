"""Difference-cover blockwise suffix sorting of a bounded text, in numpy.

A difference cover D modulo v holds, for any two positions i and j, a shift d < v with i + d and j + d
both in D modulo v. Suffixes that start in the cover are ranked once, by doubling from v bytes. Then the
wanted suffixes are sorted one bucket at a time by their first v bytes, and where these tie, by the ranks
of their cover samples at d, so a tie costs one comparison however long it is.
"""

from __future__ import annotations

import numpy as np

V = 8
COVER = (0, 1, 2, 4)
#: Suffixes that one bucket has, on average.
BUCKET = 1 << 17


def _shift(a: int, b: int) -> int:
    """The least d that puts positions of residues a and b into the cover."""
    return next(d for d in range(V) if (a + d) % V in COVER and (b + d) % V in COVER)


def _first_bytes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The V bytes at each position, as numbers in the order of the bytes."""
    words = np.lib.stride_tricks.as_strided(text, shape=(len(text) - V + 1, V), strides=(1, 1))
    return np.ascontiguousarray(words[at]).view(">u8").ravel().astype(np.uint64)


def _ranks(text: np.ndarray, n: int, depth: int) -> np.ndarray:
    """By position: for those in the cover, the rank of the suffix among such, by depth bytes or more."""
    at = np.flatnonzero(np.isin(np.arange(n + depth) % V, COVER))
    rank = np.zeros(n + 2 * depth + V, dtype=np.uint64)
    rank[at] = np.unique(_first_bytes(text, at), return_inverse=True)[1]
    done = V
    while done < depth:
        both = (rank[at] << np.uint64(32)) | rank[np.minimum(at + done, len(rank) - 1)]
        rank[at] = np.unique(both, return_inverse=True)[1]
        done *= 2
    return rank


def equal_classes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start a number, the same for two starts exactly if `length` bytes from there are equal."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(4 * length + 4 * V, np.uint8)])
    depth = V
    while depth < length:
        depth *= 2
    rank = _ranks(padded, n, depth)
    key = _first_bytes(padded, starts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    classes = np.zeros(len(starts), dtype=np.int64)
    number, a = 0, 0
    while a < len(order):
        # One bucket: whole runs of suffixes that agree in their first bytes.
        end = np.searchsorted(first, min(len(order), a + BUCKET), side="left")
        b = int(first[end]) if end < len(first) else len(order)
        own = order[a:b]
        group = np.cumsum(fresh[a:b]).astype(np.uint64) << np.uint64(32)
        at = starts[own]
        residue = at % V
        less = np.zeros(b - a, dtype=np.int64)
        members = [np.flatnonzero(residue == r) for r in range(V)]
        for r, mine in enumerate(members):
            for s, theirs in enumerate(members):
                if len(mine) and len(theirs):
                    d = _shift(r, s)
                    x = group[mine] | rank[at[mine] + d]
                    y = x if r == s else group[theirs] | rank[at[theirs] + d]
                    y = np.sort(y)
                    less[mine] += np.searchsorted(y, x) - np.searchsorted(y, group[mine])
        placed = np.lexsort((less, group))
        at = at[placed]
        same = np.ones(max(0, b - a - 1), dtype=bool)
        for k in range(0, length, V):
            w = _first_bytes(padded, at + min(k, max(0, length - V)))
            same &= w[1:] == w[:-1]
        if length < V:
            raise ValueError("length is at least that of the cover's period")
        ids = number + np.concatenate(([0], np.cumsum(~same))) if b > a else np.zeros(0, np.int64)
        classes[own[placed]] = ids
        number, a = int(ids[-1]) + 1 if len(ids) else number, b
    return classes
