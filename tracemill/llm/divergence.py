"""Source divergence audit: how far the sources of a language differ in their words, and by which.

Terms are counted by language and source; a language keeps the terms of at least MOST_RARE of its documents. A
kept term is its sparse vector of counts by source. Many terms have the same vector, so all that depends on
counts alone is worked out once for each distinct vector: the divergence of every pair of sources, times how
many terms have the vector, and what a term adds to its source's divergence from the whole language. Only the
ranking of terms looks at terms again, at those whose vectors can reach it.

Shares are whole numbers in parts of 10 ** 9, and every step is exact; floor(10 ** 9 * a / b) is taken in three
steps of 10 ** 3, so no product leaves 64 bits for totals up to 9 * 10 ** 15.

Counting combines in tasks before the one shuffle of terms, so a hot word or source arrives as few rows. Distinct vectors are
dealt in slices of bounded size, and pairs in blocks of sources, so neither grows into one task.

Defined cases: null texts, languages and sources are empty ones; a language without kept terms has pairs of value
0 and no terms; one without a second source has no pairs; repeated rows count each; doc_id isn't looked at, so it may be
null; an empty table gives no rows; extra columns are not looked at; a text of any length is read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import settle, small

#: Documents of a language that a kept term is in, at least; ranks of terms that are returned.
MOST_RARE, RANKS = 3, 200
#: Terms that a task counts before it hands them on; counts in a slice of vectors; sources in a block; cells of one numpy step.
TERMS, SLICE, BLOCK, CELLS = 1 << 18, 1 << 15, 64, 1 << 20
#: Rows up to which the groups of languages and sources are broadcast; beyond, joins shuffle.
BROADCAST_GROUPS = 100_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each language, source and term: occurrences and documents, of a bounded number of terms at a time."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> pa.RecordBatch:
        lang, source, term, count, docs = [], [], [], [], []
        for (a, b), (every, once) in held.items():
            lang += [a] * len(every)
            source += [b] * len(every)
            term += every.keys()
            count += every.values()
            docs += map(once.__getitem__, every)
        held.clear()
        terms = pa.array(term, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), terms, pa.array(count, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "count", "docs"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
            words = _TERM.findall(text.as_py().translate(_LOWER))
            every, once = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(every)
            every.update(words)
            once.update(set(words))
            size += len(every)
            if size > TERMS:
                yield handed()
                size = 0
    if held:
        yield handed()


def kept_terms(rows: DataFrame) -> DataFrame:
    """lang, term, vector (source and count, by source) of the terms that each language keeps."""
    counts = rows.mapInArrow(_counted, "lang string, source string, term string, count long, docs long").repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "count"))).alias("vector"))
    return terms.filter(F.col("docs") >= MOST_RARE).select("lang", "term", "vector")


def share(count: Column, total: Column) -> Column:
    """1 + floor(10 ** 9 * count / total), for count <= total."""
    out, rest = F.lit(1).cast("long"), count
    for power in (1_000_000, 1_000, 1):
        out = out + F.call_function("div", 1000 * rest, total) * power
        rest = (1000 * rest) % total
    return out


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """share() of arrays."""
    out, rest = np.ones(np.broadcast_shapes(count.shape, total.shape), dtype=np.int64), count
    for power in (1_000_000, 1_000, 1):
        digits, rest = np.divmod(1000 * rest, total)
        out += digits * power
    return out


def _pairs(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over a slice of vectors of the divergences of a block's sources from all others."""
    right = right.sort_by("source")
    sources, total = right.column("source").combine_chunks(), right.column("total").to_numpy() + right.column("kept").to_numpy()
    size, first = len(sources), key[2].as_py() * BLOCK
    block = range(first, min(first + BLOCK, size))
    out = np.zeros((len(block), size), dtype=np.int64)
    many = left.column("terms").to_numpy()
    vectors = left.column("vector").combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks) if vectors.num_chunks else pa.array([], vectors.type)
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(vectors).to_numpy(zero_copy_only=False)))).astype(np.int64)
    cells = vectors.flatten()
    place, count = pc.index_in(cells.field("source"), value_set=sources).to_numpy(zero_copy_only=False), cells.field("count").to_numpy(zero_copy_only=False)
    step = max(1, CELLS // size)
    for a in range(0, len(many), step):
        b = min(a + step, len(many))
        own = np.ones((b - a, size), dtype=np.int64)
        own[np.repeat(np.arange(b - a), np.diff(ends[a : b + 1])), place[ends[a] : ends[b]]] += count[ends[a] : ends[b]]
        p = shares(own, total[None, :])
        for k, s in enumerate(block):
            d = p[:, s : s + 1] - p
            out[k] += ((d * d // p) * many[a:b, None]).sum(axis=0)
    x, y = np.divmod(np.arange(out.size), size)
    differ = x + first != y
    x, y = x[differ], y[differ]
    langs = pa.array([key[0].as_py()] * len(x), pa.string())
    return pa.table({"lang": langs, "source": sources.take(pa.array(x + first)), "item": sources.take(pa.array(y)), "value": pa.array(out[x, y])})


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(F.broadcast(groups) if small(groups, BROADCAST_GROUPS) else groups, keys)


def pair_values(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every ordered pair of a language's sources."""
    size = vectors.groupBy("lang").agg(F.sum(F.size("vector")).alias("cells"))
    dealt = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(size, "lang", "left")
    dealt = settle(dealt.select(
        "lang", (1 + F.floor(F.coalesce("cells", F.lit(0)) / SLICE)).cast("int").alias("slices"), F.ceil(F.col("sources") / BLOCK).cast("int").alias("blocks"),
    ))
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    left = _joined(vectors, dealt, ["lang"]).select("lang", F.pmod(F.xxhash64("vector"), "slices").cast("int").alias("slice"), blocks, "vector", "terms")
    right = _joined(groups, dealt, ["lang"]).select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    right = right.select("lang", "slice", blocks, "source", "total", "kept")
    keys = ["lang", "slice", "block"]
    parts = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(_pairs, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(terms: DataFrame, vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms that a source has more of than its language, RANKS a source and ties by vector."""
    langs = settle(groups.groupBy("lang").agg(F.sum("total").alias("all"), F.max("kept").alias("kept")))
    every = F.aggregate("vector", F.lit(0).cast("long"), lambda n, x: n + x["count"])
    cells = vectors.select("lang", "id", every.alias("in_lang"), F.explode("vector").alias("x")).select("lang", "id", "in_lang", "x.source", "x.count")
    cells = _joined(_joined(cells, langs, ["lang"]), groups.select("lang", "source", "total"), ["lang", "source"])
    cells = cells.select("lang", "source", "id", share(F.col("count") + 1, F.col("total") + F.col("kept")).alias("p"), share(F.col("in_lang") + 1, F.col("all") + F.col("kept")).alias("q"))
    d = F.col("p") - F.col("q")
    cells = cells.filter("p > q").select("lang", "source", "id", F.call_function("div", d * d, F.col("q")).alias("value"))
    # A term among the first has fewer than RANKS vectors above its own.
    best = cells.withColumn("r", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).filter(F.col("r") <= RANKS)
    named = best.select("source", "id", "value").join(vectors.select("lang", "id", "vector"), "id")
    return named.join(terms, ["lang", "vector"]).select("lang", "source", F.col("term").alias("item"), "value")


def audit(documents: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: `pair` has every other source of the language by divergence from it, `term`
    the first RANKS terms by what they add to the source's divergence from its language."""
    rows = documents.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    terms = settle(kept_terms(rows))
    vectors = settle(terms.groupBy("lang", "vector").agg(F.count(F.lit(1)).alias("terms")).withColumn("id", F.monotonically_increasing_id()))
    totals = vectors.select("lang", "terms", F.explode("vector").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum(F.col("x.count") * F.col("terms")).alias("total"))
    kept = vectors.groupBy("lang").agg(F.sum("terms").alias("kept"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = settle(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = [
        df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        for part, df in (("pair", pair_values(vectors, groups)), ("term", term_values(terms, vectors, groups)))
    ]
    return found[0].unionByName(found[1].filter(F.col("rank") <= RANKS))
