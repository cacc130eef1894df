"""MinHash near-duplicates with SetSketch registers.

A document's set is its distinct shingles of five words. Its sketch has M registers; each holds, of the
smallest of the shingles' exponential variates, the truncated logarithm to base B. Registers are merged
by maximum, and two sets agree in a register about as often as their Jaccard similarity.

1. Documents with equal sets are one class, kept by its smallest doc_id.
2. Classes whose registers agree in all of a band's are candidates. A bucket of candidates is not
   expanded into pairs: its members are joined to one centre, the verified ones become components, and
   buckets that still hold several components get the member whose registers agree with most others as
   the next centre. What is left apart after that is compared between components: small buckets by a
   join, larger ones in blocks of bounded size, each pair in the first band that it shares. Shingles that none
   of the others has, and counts of shingles in cells, bound what two sets can share: documents that can
   link with none are left out before a row a bucket is made, pairs before they are, and no link is lost.
3. A candidate pair's similarity is estimated jointly, by the likelihood of how many registers are
   larger, smaller and equal; pairs over five standard deviations (and 0.02) below the threshold are dropped.
4. The rest are verified on their full sets, and verified links give components.

A pair at the threshold shares no band with a probability of about 3e-6 at 0.85 and 2e-4 at 0.80, and its
estimate is dropped with one of at most 5e-7; together at most 4e-6 and 3e-4.

Defined cases: null and wordless texts have an empty set and no link; fewer than five words are one
shingle; rows that share a doc_id are rows of their own with that id's component (equal rows link); a
null doc_id takes part in no link and is its own, null, component; an empty table gives no rows; a text of
any length is one set, of all its shingles; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash
from .components import components
from .storage import settle, small

SHINGLE = 5
BANDS, ROWS = 24, 6
M = BANDS * ROWS
B, A, Q = 1.2, 20.0, 254
#: Ids up to which a table of ids is broadcast to the documents; beyond, the join shuffles.
BROADCAST_IDS = 500_000
#: Members of a bucket up to which all its pairs of different components are joined, and members of a block
#: that is compared with another such block in larger ones.
FEW, BLOCK = 16, 1024
#: Cells in which a set's shingles are counted, for a bound on what two sets share.
CELLS = 256

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**32, M, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 2**32, M, dtype=np.uint64).astype(np.uint32)


def registers(distinct: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes."""
    low = np.full(M, 2**32 - 1, dtype=np.uint32)
    short = (distinct >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for a in range(0, len(short), 512):
            part = short[a : a + 512, None] * _FACTORS
            part += _SHIFTS
            np.minimum(low, part.min(axis=0), out=low)
    return quantised(low)


def quantised(low: np.ndarray) -> np.ndarray:
    """Register values of the smallest uniform numbers, given as 32-bit integers."""
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / A
    return np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint8)


def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    data, offsets = bytehash.texts(column)
    for a, b in bytehash.groups_of_rows(offsets):
        if b - a == 1:
            words, _ = bytehash.word_hashes(data[offsets[a] : offsets[b]])
            yield np.unique(bytehash.shingles(words, SHINGLE))
            continue
        # Several texts at once: a blank between texts keeps their words apart.
        part, ends = data[offsets[a] : offsets[b]], offsets[a + 1 : b] - offsets[a]
        spaced = np.insert(part, ends, np.uint8(32))
        words, starts = bytehash.word_hashes(spaced)
        begins = np.concatenate(([0], ends + np.arange(1, len(ends) + 1), [len(spaced) + 1]))
        cuts = np.searchsorted(starts, begins)
        for i in range(b - a):
            yield np.unique(bytehash.shingles(words[cuts[i] : cuts[i + 1]], SHINGLE))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, first, second, sketch = [], [], [], []
        for own in sets_of(batch.column("text")):
            size.append(len(own))
            with np.errstate(over="ignore"):
                first.append(int(own.sum(dtype=np.uint64).view(np.int64)))
                second.append(int(bytehash.mixed(own).sum(dtype=np.uint64).view(np.int64)))
            sketch.append(registers(own).tobytes() if len(own) else None)
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("row"), pa.array(size, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(sketch, pa.binary())],
            ["doc_id", "row", "n_shingles", "set_a", "set_b", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        held, at, total = [], 0, 0
        for i, own in enumerate(sets_of(batch.column("text"))):
            held.append(own.view(np.int64))
            total += len(own)
            if total > 1 << 19 or i == len(ids) - 1:
                ends = np.concatenate(([0], np.cumsum([len(x) for x in held])))
                values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held)))
                yield pa.record_batch([ids.slice(at, len(held)), values], ["id", "shingles"])
                held, at, total = [], i + 1, 0


def estimate(larger: np.ndarray, smaller: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Jaccard similarities of highest likelihood, given how many registers of the first sketch are larger
    and smaller than the second's, and the sets' sizes. A search by thirds; the likelihood is concave."""
    larger, smaller = np.asarray(larger, float), np.asarray(smaller, float)
    u = np.asarray(nu, float) / (np.asarray(nu, float) + nv)
    v = 1 - u
    equal = M - larger - smaller
    scale, log_b = (B - 1) / B, np.log(B)

    def p(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.maximum(x, 0) * scale) / log_b, 1e-12)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(22):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(a) < likelihood(b)
        low, high = np.where(better, a, low), np.where(better, high, b)
    return (low + high) / 2


def least_estimate(threshold: float) -> float:
    return threshold - 5 * float(np.sqrt(threshold * (1 - threshold) / M)) - 0.02


def _likely(threshold: float):
    low = least_estimate(threshold)

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series, nu: pd.Series, nv: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x = np.frombuffer(b"".join(a), np.uint8).reshape(-1, M)
        y = np.frombuffer(b"".join(b), np.uint8).reshape(-1, M)
        return pd.Series(estimate((x > y).sum(1), (x < y).sum(1), nu.to_numpy(), nv.to_numpy()) >= low)

    return likely


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of a set fall into each of CELLS cells by hash."""
    for batch in batches:
        lists = batch.column("shingles")
        values, ends = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        count = [np.bincount(values[a:b] & (CELLS - 1), minlength=CELLS).astype(np.int32).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.record_batch([batch.column("id"), pa.array(count, pa.binary())], ["id", "cells"])


def _central(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket's block, the member whose registers agree with most others', for each register."""
    x = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, M)
    cell = x + 256 * np.arange(M)
    score = np.bincount(cell.ravel(), minlength=256 * M)[cell].sum(axis=1).astype(float)
    best = group.iloc[[int(np.lexsort((group["id"].to_numpy(), -score))[0])]]
    return pd.DataFrame({"key": best["key"], "center": best["id"], "home": best["component"], "score": score.max() / len(x)})


def _across(threshold: float):
    low = least_estimate(threshold)

    def across(group: pd.DataFrame) -> pd.DataFrame:
        """Likely pairs of different components between the two blocks of a group, which may be one.

        Left out are pairs that cannot share enough: by what each shares with any other at most, and by how many
        shingles each has in a cell; and pairs that an earlier band brings together as well.
        """
        group = group.sort_values("id").reset_index(drop=True)
        x = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, M)
        cells = np.frombuffer(b"".join(group["cells"]), np.int32).reshape(-1, CELLS)
        ids, comp, size, common = (group[c].to_numpy() for c in ("id", "component", "n", "common"))
        side, band = group["side"].to_numpy(), int(group["band"].iloc[0])
        one = bool((group["left"] == group["right"]).iloc[0])
        found = []
        for i in range(len(x) - 1):
            # Rows are sorted by id, and ids are unique.
            at = i + 1 + np.flatnonzero((comp[i + 1 :] != comp[i]) & (one | (side[i + 1 :] != side[i])))
            most = np.minimum(common[at], common[i])
            at = at[most >= (threshold - 1e-9) * (size[at] + size[i] - most)]
            if len(at):
                most = np.minimum(cells[at], cells[i]).sum(axis=1)
                at = at[most >= (threshold - 1e-9) * (size[at] + size[i] - most)]
            if len(at) and band:
                met = (x[at, : band * ROWS] == x[i, : band * ROWS]).reshape(len(at), band, ROWS).all(axis=2).any(axis=1)
                at = at[~met]
            if len(at):
                est = estimate((x[i] > x[at]).sum(1), (x[i] < x[at]).sum(1), np.full(len(at), size[i]), size[at])
                found += [(ids[i], ids[k]) for k in at[est >= low]]
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return across


def near_duplicates(documents: DataFrame, percent: int = 85, row: str | None = None) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept. Links need 100 * intersection >= percent * union.

    row names a column of numbers that is handed through.
    """
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = plain.withColumn("row", F.lit(None).cast("long")) if row is None else documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"), "text")
    sketched = settle(numbered.mapInArrow(_sketch, "doc_id long, row long, n_shingles long, set_a long, set_b long, sketch binary"))
    in_play = sketched.filter("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "set_a", "set_b"]
    classes = settle(in_play.groupBy(*same).agg(F.min("doc_id").alias("id")))
    joined = classes.join(in_play.select(F.col("doc_id").alias("id"), "sketch", *same), ["id", *same])
    members = settle(joined.dropDuplicates(["id", *same]).select("id", F.col("n_shingles").alias("n"), "sketch"))
    links = _links(plain, members, percent)
    labels = components(links)
    named = (
        classes.join(labels, F.col("id") == F.col("node"), "left")
        .select(*same, F.coalesce("component", "id").alias("component"))
    )
    named = settle(named)
    return (
        sketched.drop("sketch")
        .join(named, same, "left")
        .select(
            "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
            *([] if row is None else [F.col("row").alias(row)]),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _links(plain: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Verified links (u, v) of members with different sets, enough to connect all that are linked."""
    threshold = percent / 100
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda t: F.xxhash64(t, F.substring(F.col("sketch"), t * ROWS + 1, F.lit(ROWS))))
    keyed = settle(members.select("id", F.explode(keys).alias("key")))
    buckets = settle(keyed.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("members")).filter("members > 1"))
    crowd = settle(keyed.join(buckets, "key").select("key", "id", "center", "members"))
    ids = settle(crowd.select("id").distinct())
    few = F.broadcast(ids) if small(ids, BROADCAST_IDS) else ids
    texts = plain.join(few.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    sets = settle(texts.mapInArrow(_sets, "id long, shingles array<bigint>").dropDuplicates(["id"]))
    side = members.select("id", "n", "sketch")

    def verified(pairs: DataFrame) -> DataFrame:
        """Of the pairs (u, v), those that are likely and whose full sets are similar enough."""
        a = side.select(F.col("id").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
        b = side.select(F.col("id").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
        likely = settle(
            pairs.join(a, "u").join(b, "v")
            .filter(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
            .filter(_likely(threshold)("su", "sv", "nu", "nv"))
            .select("u", "v", "nu", "nv")
        )
        own = likely.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("x")), "u").join(
            sets.select(F.col("id").alias("v"), F.col("shingles").alias("y")), "v"
        )
        both = F.size(F.array_intersect("x", "y")).cast("long")
        return settle(own.withColumn("both", both).filter(100 * F.col("both") >= percent * (F.col("nu") + F.col("nv") - F.col("both"))).select("u", "v"))

    tested = settle(crowd.filter("id <> center").select(F.least("id", "center").alias("u"), F.greatest("id", "center").alias("v")).distinct())
    links = verified(tested)

    # In a bucket of two all is tested. Of the members of larger ones only those go on that share enough of their
    # shingles with any other: one row a document, before a row for each bucket is made.
    larger = settle(buckets.filter("members > 2").select("key"))
    larger = F.broadcast(larger) if small(larger, BROADCAST_IDS) else larger
    wide = settle(keyed.join(larger, "key").select("id").distinct())
    held = sets.join(wide, "id", "left_semi")
    shared = held.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("c"), F.min("id").alias("id"))
    alone = shared.filter("c = 1").groupBy("id").agg(F.count("*").alias("alone"))
    common = F.col("n") - F.coalesce("alone", F.lit(0))
    able = side.join(wide, "id").join(alone, "id", "left").withColumn("common", common).filter(100 * F.col("common") >= percent * F.col("n"))
    able = settle(able.select("id", "n", "sketch", "common"))
    able = settle(able.join(held.join(able.select("id"), "id", "left_semi").mapInArrow(_cells, "id long, cells binary"), "id"))

    def apart() -> tuple[DataFrame, DataFrame]:
        """The able members with their components, and the buckets that still hold several of these."""
        now = settle(able.join(components(links), F.col("id") == F.col("node"), "left").select(*able.columns, F.coalesce("component", "id").alias("component")))
        per = now.select("component", F.explode(keys).alias("key")).groupBy("key").agg(
            F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("members")
        )
        return now, settle(per.filter("a <> b").select("key", "members"))

    def spread(now: DataFrame, split: DataFrame) -> DataFrame:
        """A row for each member and split bucket, with the band."""
        some = F.broadcast(split) if small(split, BROADCAST_IDS) else split
        return now.select(*now.columns, F.posexplode(keys).alias("band", "key")).join(some, "key")

    now, split = apart()
    for _ in range(2):
        hot = split.filter(F.col("members") > FEW)
        if hot.isEmpty():
            break
        block = F.pmod(F.xxhash64("id"), F.ceil(F.col("members") / BLOCK))
        central = spread(now.select("id", "component", "sketch"), hot).withColumn("block", block).groupBy("key", "block").applyInPandas(
            _central, "key long, center long, home long, score double"
        )
        central = settle(central.groupBy("key").agg(F.max_by(F.struct("center", "home"), F.struct("score", -F.col("center"))).alias("c")).select("key", "c.*"))
        pairs = (
            spread(now.select("id", "component", "sketch"), central).filter("component <> home")
            .select(F.least("id", "center").alias("u"), F.greatest("id", "center").alias("v")).distinct()
        )
        pairs = settle(pairs.join(tested, ["u", "v"], "left_anti"))
        if pairs.isEmpty():
            break
        tested, links = settle(tested.union(pairs)), settle(links.union(verified(pairs)))
        now, split = apart()
    if split.isEmpty():
        return links
    some = spread(now, split.filter(F.col("members") <= FEW)).select("key", "id", "component", "n", "common")
    met = some.alias("a").join(some.alias("b"), "key").filter("a.id < b.id and a.component <> b.component")
    most = F.least("a.common", "b.common")
    near = met.filter(100 * most >= percent * (F.col("a.n") + F.col("b.n") - most))
    pairs = near.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()
    hot = split.filter(F.col("members") > FEW)
    if not hot.isEmpty():
        # Each block of a bucket meets each other block once.
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("side"), o).alias("left"), F.greatest(F.col("side"), o).alias("right")))
        dealt = (
            spread(now, hot).withColumn("blocks", blocks).withColumn("side", own).withColumn("m", F.explode(meet))
            .select("key", "band", "id", "component", "n", "common", "sketch", "cells", "side", "m.left", "m.right")
        )
        # Few bytes but much work: keep the tasks apart.
        tasks = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        met = dealt.repartition(tasks, "key", "left", "right").groupBy("key", "left", "right").applyInPandas(_across(threshold), "u long, v long")
        pairs = pairs.union(met).distinct()
    pairs = settle(pairs.join(tested, ["u", "v"], "left_anti"))
    return settle(links.union(verified(pairs)))
