"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document gets a vector of statistics of its whole text, transformed to be nearer to normal (shares
by the arcsine of the root, counts by the logarithm). Of each label the mean and the covariance are
estimated from all training rows, from sums that Spark adds up; a covariance is shrunk towards the one of
both labels together, and that towards its diagonal. A score is the logistic of the difference of the two
log-densities with their priors; Mahalanobis distances use inverse Cholesky factors that are computed once
and sent with the tasks.

Defined cases: null and empty texts have the statistics of an empty text and get a score like others; a
null doc_id is not held out and has no label; labels other than 0 and 1 are not used, nor those of a doc_id
that has both, and equal ones of a doc_id count once; a text of any length is read whole; with rows of one
label only, or none, every score is that label's share, or 0.5; repeated rows are rows of their own;
extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash
from .storage import settle

#: Weights of the shared covariance, and of the diagonal within it.
SHRINK, DIAGONAL = 0.2, 0.05
NAMES = (
    "bytes", "words", "word_bytes", "upper", "digits", "symbols", "marks", "bars", "white", "lines",
    "distinct", "top", "again", "triples",
)
D = len(NAMES)


def _classes() -> dict[str, np.ndarray]:
    def table(chars: bytes) -> np.ndarray:
        out = np.zeros(256, dtype=np.int64)
        out[list(chars)] = 1
        return out

    letters = table(bytes(range(0x61, 0x7B)) + bytes(range(0x41, 0x5B)) + bytes(range(0xC0, 0x100)))
    return {
        "letters": letters,
        "upper": table(bytes(range(0x41, 0x5B))),
        "digits": table(bytes(range(0x30, 0x3A))),
        "symbols": table(b"!#$%&*@^~+=<>{}[]\\/_`"),
        "marks": table(b".,;:?'\"()-"),
        "bars": table(b"|"),
        "white": table(b" \t\n\r\x0b\x0c"),
        "lines": table(b"\n"),
    }


CLASSES = _classes()


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _word_statistics(words: np.ndarray) -> tuple[float, float, float, float]:
    n = len(words)
    if not n:
        return 0.0, 0.0, 0.0, 0.0
    _, counts = np.unique(words, return_counts=True)
    triples = bytehash.shingles(words, 3)
    again = float((words[1:] == words[:-1]).sum())
    return len(counts) / n, counts.max() / n, again / n, len(np.unique(triples)) / len(triples)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of NAMES for each text."""
    data, offsets = bytehash.texts(column)
    out = np.zeros((len(offsets) - 1, D))
    for a, b in bytehash.groups_of_rows(offsets):
        part, ends = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        size = np.diff(ends)
        count = {}
        for name, lut in CLASSES.items():
            total = np.concatenate(([0], np.cumsum(lut[part])))
            count[name] = (total[ends[1:]] - total[ends[:-1]]).astype(float)
        spaced = np.insert(part, ends[1:-1], np.uint8(32)) if b - a > 1 else part
        words, starts = bytehash.word_hashes(spaced)
        begins = ends[:-1] + np.arange(b - a)
        cuts = np.concatenate((np.searchsorted(starts, begins), [len(starts)]))
        n = np.diff(cuts).astype(float)
        word = np.array([_word_statistics(words[cuts[i] : cuts[i + 1]]) for i in range(b - a)])
        own = out[a:b]
        own[:, 0], own[:, 1] = np.log1p(size), np.log1p(n)
        own[:, 2] = np.log1p((size - count["white"]) / np.maximum(n, 1))
        own[:, 3] = _share(count["upper"], count["letters"])
        for i, name in enumerate(("digits", "symbols", "marks", "bars", "white", "lines")):
            own[:, 4 + i] = _share(count[name], size)
        own[:, 10] = np.log1p(word[:, 0] * n) / np.log1p(np.maximum(n, 1))
        for i in range(1, 4):
            own[:, 10 + i] = np.arcsin(np.sqrt(np.clip(word[:, i], 0, 1)))
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics(batch.column("text"))
        vectors = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), D).cast(pa.list_(pa.float64()))
        yield pa.record_batch([batch.column("doc_id"), batch.column("row"), vectors], ["doc_id", "row", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, D)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each label: count, sums and sums of products, as numbered cells."""
    total = np.zeros((2, 1 + D + D * D))
    for batch in batches:
        x, y = _matrix(batch.column("x")), batch.column("quality").to_numpy(zero_copy_only=False)
        for k in (0, 1):
            own = x[y == k]
            total[k] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
    cells = np.arange(total[0].size)
    for k in (0, 1):
        yield pa.record_batch([pa.array(np.full(len(cells), k), pa.int32()), pa.array(cells, pa.int32()), pa.array(total[k])], ["label", "cell", "value"])


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and constants of the two labels' densities; factors is None if
    there was one label or none, and constant then holds the score."""

    means: np.ndarray | None
    factors: np.ndarray | None
    constant: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.factors is None:
            return np.full(len(x), self.constant[0])
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.factors[k].T
            density.append(self.constant[k] - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def discriminant(total: np.ndarray) -> Discriminant:
    """From the sums of _sums, added up."""
    n = total[:, 0]
    if not n.all():
        return Discriminant(None, None, np.array([n[1] / n.sum() if n.sum() else 0.5]))
    means = total[:, 1 : 1 + D] / n[:, None]
    second = total[:, 1 + D :].reshape(2, D, D) / n[:, None, None]
    own = second - means[:, :, None] * means[:, None, :]
    shared = (own * n[:, None, None]).sum(axis=0) / n.sum()
    shared = (1 - DIAGONAL) * shared + DIAGONAL * np.diag(np.diag(shared)) + 1e-6 * np.eye(D)
    factors, constant = [], []
    for k in (0, 1):
        weight = max(SHRINK, 1 - n[k] / (n[k] + D))
        lower = np.linalg.cholesky((1 - weight) * own[k] + weight * shared)
        factors.append(np.linalg.inv(lower))
        constant.append(np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(constant))


def held_out(doc_id):
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(documents: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. row names a column of numbers that is handed through."""
    number = F.lit(None).cast("long") if row is None else F.col(row)
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row"), "text")
    vectors = settle(plain.mapInArrow(_rows, "doc_id long, row long, x array<double>"))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.filter("quality in (0, 1)").filter(~held_out(F.col("doc_id")))
    # A doc_id with several equal labels has one, and one with both has none.
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most").drop("most")
    sums = (
        vectors.join(marked, "doc_id").select("quality", "x").mapInArrow(_sums, "label int, cell int, value double")
        .groupBy("label", "cell").agg(F.sum("value").alias("value"))
    )
    total = np.zeros((2, 1 + D + D * D))
    for cell in sums.collect():  # as many rows as the two covariances have cells
        total[cell["label"], cell["cell"]] = cell["value"]
    fitted = discriminant(total)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), batch.column("row"), pa.array(fitted.score(_matrix(batch.column("x"))))], ["doc_id", "row", "score"])

    scores = vectors.mapInArrow(scored, "doc_id long, row long, score double")
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *([] if row is None else [F.col("row").alias(row)]),
    )
