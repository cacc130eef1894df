"""Periodic run detection: maximal repeats of words by power-of-two naming.

Texts of a batch are laid out one after the other as numbers of words, a separator of its own after each, and
words of different texts never share a number. Level L names every stretch of 2 ** L words, equal stretches
equally, from the pair of names of its halves (Karp, Miller and Rosenberg); a stretch that occurs once gets a
name of its own, and naming ends at the level where all are so. For each period q the grid points j = 0, q, 2q, ...
are candidates: a run of three periods or more holds a grid point whose q words equal the next q, which two
names of the level below q tell. The first grid point of each chain is extended to both sides by descending
levels. Nothing is hashed and no suffix is sorted.

Defined cases: null and empty texts, and texts of white space, have no words: no runs, and digests of nothing; a
null doc_id has no checksum, so its words stay as they are; a text of any length is read whole by one task, whose
memory follows that text (names of as many levels as its longest repeat needs); repeated rows and doc_ids are
rows of their own; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest run in words, and fewest periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words that are named together, unless one text has more, and grid points that are looked at together.
TOGETHER, CANDIDATES = 1 << 16, 1 << 18

SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _named(keys: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """Names of `size` positions: equal keys (of the positions `at`) that occur again share a number from 0; any other
    position has a negative one of its own."""
    names = -1 - np.arange(size, dtype=np.int64)
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts > 1
    number = np.cumsum(again) - 1
    own = again[inverse]
    names[at[own]] = number[inverse[own]]
    return names


def levels(numbers: np.ndarray) -> list[np.ndarray]:
    """Names of every stretch of 1, 2, 4, ... numbers by where it starts, up to the last level where one occurs
    again; a stretch that would go past the end has a name of its own."""
    n = len(numbers)
    found = [_named(numbers, n, np.arange(n))]
    while len(found[-1]) and found[-1].max() >= 0:
        last, half = found[-1], 1 << (len(found) - 1)
        if 2 * half > n:
            break
        at = np.flatnonzero((last[: n - half] >= 0) & (last[half:] >= 0))
        found.append(_named(last[at] * (n + 1) + last[at + half], n, at))
    if len(found[-1]) == 0 or found[-1].max() < 0:
        found.pop()
    return found


def extension(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """How many numbers are equal from a and b on, or back from a and b (both included); a < b."""
    n, total = len(names[0]), np.zeros(len(a), dtype=np.int64)
    for level in range(len(names) - 1, -1, -1):
        step = 1 << level
        x, y = (a - total - step + 1, b - total - step + 1) if back else (a + total, b + total)
        inside = (x >= 0) & (y < n)
        total += step * (inside & (names[level][np.where(inside, x, 0)] == names[level][np.where(inside, y, 0)]))
    return total


def _pieces(points: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of periods of at most CANDIDATES grid points together, or of one period that has more."""
    ends, a = np.cumsum(points), 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CANDIDATES, side="right")))
        yield a, b
        a = b


def runs(numbers: np.ndarray) -> np.ndarray:
    """All runs of at least LEAST_WORDS and LEAST_PERIODS periods: rows of start, length, smallest period, by start and period."""
    names, found, n = levels(numbers), [np.zeros((0, 3), dtype=np.int64)], len(numbers)
    for level, name in enumerate(names):
        low = 1 << level
        periods = np.arange(low, min(2 * low, n // LEAST_PERIODS + 1))
        for a, b in _pieces(n // periods - 1):
            points = n // periods[a:b] - 1
            q = np.repeat(periods[a:b], points)
            j = (np.arange(len(q)) - np.repeat(np.cumsum(points) - points, points)) * q
            # The q numbers at j against the next q, by two names that overlap.
            held = name[j] == name[j + q]
            j, q = j[held], q[held]
            held = name[j + q - low] == name[j + 2 * q - low]
            j, q = j[held], q[held]
            opens = np.ones(len(j), dtype=bool)  # the first grid point of each chain
            opens[1:] = (j[1:] != j[:-1] + q[1:]) | (q[1:] != q[:-1])
            j, q = j[opens], q[opens]
            start = j - extension(names, j - 1, j + q - 1, back=True)
            length = j + q + extension(names, j, j + q) - start
            held = (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * q)
            found.append(np.stack([start, length, q], axis=1)[held])
    rows = np.concatenate(found)
    # A stretch that was found with several periods has the smallest; the others are its multiples.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, repeated from some word on where its checksum says so."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def collapsed(words: list[bytes], rows: np.ndarray) -> list[bytes]:
    """The words without those that a run has after its first period."""
    if not len(rows):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
    kept = np.cumsum(edge[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept)]


def _described(doc_id: int | None, words: list[bytes], rows: np.ndarray) -> tuple:
    top = (None, None, None, None)
    if len(rows):
        start, length, q = max(rows.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
        top = (start, length, q, 1000 * length // q)
    told = "".join(f"{s},{l},{q}\n" for s, l, q in rows.tolist())
    return (doc_id, len(words), len(rows), *top, hashlib.sha256(told.encode()).hexdigest(), _digest(collapsed(words, rows)))


def together(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text. All are laid out in one array; a word of one text has no number of another's."""
    size = sum(map(len, texts)) + len(texts)
    numbers, ends, known = np.empty(size, dtype=np.int64), [], 0
    at = 0
    for words in texts:
        ids: dict[bytes, int] = {}
        numbers[at : at + len(words)] = [ids.setdefault(w, len(ids)) for w in words]
        numbers[at : at + len(words)] += known
        at += len(words)
        numbers[at] = known + len(ids)  # the separator
        known += len(ids) + 1
        at += 1
        ends.append(at)
    rows, out, a = runs(numbers), [], 0
    cuts = np.searchsorted(rows[:, 0], ends)
    for k, cut in enumerate(cuts):
        own = rows[a:cut].copy()
        own[:, 0] -= ends[k - 1] if k else 0
        out.append(own)
        a = cut
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        rows = [_described(i, words, r) for (i, words), r in zip(held, together([w for _, w in held]), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

    held, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
            words = planted((text.as_py() or b"").split(), doc_id)
            if held and size + len(words) > TOGETHER:
                yield done(held)
                held, size = [], 0
            held.append((doc_id, words))
            size += len(words) + 1
    if held:
        yield done(held)


_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]
_TYPES = [pa.string() if field.endswith("string") else pa.int64() for field in SCHEMA.split(", ")]


def periodic_runs(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_runs, the run of most periods (start, length, period, exponent_milli), and digests of
    all runs and of the text without their repeats. Texts are read as the contract's, with what planted() repeats."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_rows, SCHEMA)
