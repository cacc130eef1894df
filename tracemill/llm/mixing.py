"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets a fractional number of copies, its source's target over its source's size. The whole
part is taken as it is; the fractional parts are rounded in pairs: mass moves between two documents of
a source, weighted by their sizes, until one of the two is integral. Each move keeps the source's words
exactly and each document's expectation, so a source misses its target by less than one document.

The pairs form a reduction tree: documents are dealt to blocks by hash of doc_id and text, a block folds to at
most one document that is still fractional, and these meet in the next level's blocks. The last one of a
source is drawn. Documents of more than one part in LARGE of their source, so fewer than LARGE, come first and
by themselves; the mass of the one that is left goes to the smaller ones, as far as these can take it, so what
is drawn in the end is small. What a source then has too many or too few words is evened out by REPAIRS
documents at most, each time the one whose size is nearest to it, rounded the other way.

Defined cases: a null or blank text has size 0 and takes 0 words; a null source is a source of its own,
the last; repeated rows are documents of their own, of which equal ones may be told apart in any way; a null
doc_id is told apart by its text; a text of any length counts whole; an empty table gives no rows; other
columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import settle, small

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one block folds, on average.
BLOCK = 48
#: Sources up to which the table of sources is broadcast; beyond, the join shuffles and AQE splits hot sources.
BROADCAST_SOURCES = 100_000
#: Documents of a source that are rounded the other way, at most, to meet its target.
REPAIRS = 4
#: A document of more than one part in so many of its source is folded before the others.
LARGE = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Adds rank, from 0, by source in code point order, null last, without one task that sees all.

    After a range sort the row number in each partition is the low half of monotonically_increasing_id;
    the partitions' counts, as many as there are partitions, give what to add.
    """
    placed = settle(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    )
    sizes = placed.groupBy(F.shiftright("at", 33).alias("part")).count().orderBy("part").collect()
    before, starts = 0, {}
    for row in sizes:
        starts[row["part"]] = before
        before += row["count"]
    if not starts:
        return placed.withColumn("rank", F.lit(0).cast("long")).drop("at")
    offset = F.element_at(
        F.create_map(*[F.lit(x).cast("long") for kv in starts.items() for x in kv]), F.shiftright("at", 33)
    )
    return placed.withColumn("rank", offset + F.col("at").bitwiseAND(F.lit(2**33 - 1))).drop("at")


def with_targets(sources: DataFrame, cap: float) -> DataFrame:
    """Adds target to (source, source_size, weight): shares of all words by weight, each at most cap times
    its source; what exceeds is shared again by weight until no target is above."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit, held, level = F.col("source_size") * F.lit(float(cap)), -1, 0.0
    while True:
        full = limit < F.col("weight") * F.lit(level)
        got = sources.agg(
            F.sum(F.when(full, limit)).alias("held_words"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("held"),
        ).first()
        if got["held"] == held or not got["weight"]:
            break
        held, level = got["held"], (total - (got["held_words"] or 0.0)) / got["weight"]
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(float(level))))


def _chance(doc: Column, other: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the two documents and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(doc, other, F.lit(seed)), 11) / F.lit(float(2**53))


ITEM = "struct<key:bigint,doc_id:bigint,size:bigint,base:bigint,p:double,row:bigint>"
DONE = "struct<doc_id:bigint,size:bigint,copies:bigint,row:bigint>"


def _fold(items: Column, seed: int) -> Column:
    """Folds a block's documents; returns struct(left: the fractional one or null, done: the integral ones)."""

    def finished(x: Column, p: Column) -> Column:
        return F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), (x["base"] + p.cast("long")).alias("copies"), x["row"].alias("row"))

    def kept(x: Column, p: Column) -> Column:
        return F.struct(x["key"].alias("key"), x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["base"].alias("base"), p.alias("p"), x["row"].alias("row"))

    def step(state: Column, y: Column) -> Column:
        x, tiny = state["left"], 1e-9
        up = F.least((1 - x["p"]) * x["size"], y["p"] * y["size"])
        down = F.least(x["p"] * x["size"], (1 - y["p"]) * y["size"])
        moved = F.when(_chance(x["key"], y["key"], seed) * (up + down) < down, up).otherwise(-down)
        return F.when(x.isNull(), F.struct(y.cast(ITEM).alias("left"), state["done"].alias("done"))).otherwise(
            F.transform(
                F.array(F.struct((x["p"] + moved / x["size"]).alias("a"), (y["p"] - moved / y["size"]).alias("b"))),
                lambda m: F.when(
                    (m["a"] < tiny) | (m["a"] > 1 - tiny),
                    F.struct(
                        kept(y, m["b"]).cast(ITEM).alias("left"),
                        F.concat(state["done"], F.array(finished(x, F.round(m["a"])))).cast(f"array<{DONE}>").alias("done"),
                    ),
                ).otherwise(
                    F.struct(
                        kept(x, m["a"]).cast(ITEM).alias("left"),
                        F.concat(state["done"], F.array(finished(y, F.round(m["b"])))).cast(f"array<{DONE}>").alias("done"),
                    )
                ),
            )[0]
        )

    start = F.struct(F.lit(None).cast(ITEM).alias("left"), F.array().cast(f"array<{DONE}>").alias("done"))
    return F.aggregate(items, start, step)


def mix(documents: DataFrame, cap: float = 3.0, seed: int = 0, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    row names a column of unique numbers in a settled table, which is handed through and, with the text, tells
    rows without a doc_id or with the same one apart.
    """
    number = F.lit(None).cast("long") if row is None else F.col(row)
    sized = settle(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), number.alias("row"), F.xxhash64("text").alias("salt"),
        )
    )
    sources = settle(
        ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))).withColumn(
            "weight", (F.col("rank") % 3 + 1).cast("double")
        )
    )
    sources = settle(with_targets(sources, cap).withColumn("sid", F.col("rank")))
    side = sources.select("source", "sid", "source_size", "target", "n")
    side = F.broadcast(side) if small(side, BROADCAST_SOURCES) else side
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    item = F.struct("key", "doc_id", "size", "base", "p", "row").cast(ITEM)

    def with_chance(rows: DataFrame, f: Column) -> DataFrame:
        """Adds base and p, the whole and the fractional part of a document's copies."""
        rows = rows.withColumn("base", F.floor(f + 1e-9)).withColumn("p", F.when(F.col("size") > 0, F.greatest(F.lit(0.0), f - F.col("base"))).otherwise(0.0))
        return rows.withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p")))

    placed = settle(
        sized.alias("d")
        .join(side.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("sid", "n", "doc_id", "size", "row", F.xxhash64("doc_id", "salt", F.lit(seed)).alias("key"), share.alias("f"), "target", (F.col("size") * LARGE > F.col("source_size")).alias("large"))
    )
    # The large documents of a source, fewer than LARGE, in one row.
    folded = with_chance(placed.filter("large"), F.col("f")).groupBy("sid").agg(
        F.sort_array(F.collect_list(F.when(F.col("p") > 0, item))).alias("items"), F.sum(F.when(F.col("p") == 0, F.col("size") * F.col("base"))).alias("held")
    )
    folded = settle(folded.select("sid", "held", _fold(F.col("items"), seed - 1).alias("r")))
    small_words = placed.groupBy("sid").agg(F.max("target").alias("target"), F.sum(F.when(~F.col("large"), F.col("size")).otherwise(0)).alias("words"))
    x = F.col("r.left")
    done = F.aggregate("r.done", F.lit(0).cast("long"), lambda a, d: a + d["size"] * d["copies"])
    rest = F.col("target") - F.coalesce(F.col("held"), F.lit(0)) - F.coalesce(done, F.lit(0)) - F.coalesce(x["size"] * x["base"], F.lit(0))
    most = F.lit(float(cap)) * F.col("words")
    over = lambda r: F.greatest(F.lit(0.0), -r, r - most)
    one, none = over(F.col("rest") - x["size"]), over(F.col("rest"))
    up = F.when((one == 0) & (none == 0), _chance(x["key"], F.lit(0), seed + 2) < x["p"]).otherwise(one < none)
    folded = settle(
        small_words.join(folded, "sid", "left").withColumn("rest", rest).withColumn("up", F.when(x.isNotNull(), up).cast("long"))
        .withColumn("rest", F.least(most, F.greatest(F.lit(0.0), F.col("rest") - F.coalesce(F.col("up") * x["size"], F.lit(0)))))
        .select("sid", "r", "up", F.when(F.col("words") > 0, F.col("rest") / F.col("words")).otherwise(F.lit(0.0)).alias("g"))
    )
    told = ["sid", "doc_id", "size", "copies", "row"]
    first = folded.select("sid", F.explode("r.done").alias("x")).select("sid", "x.doc_id", "x.size", "x.copies", "x.row").unionByName(
        folded.filter(x.isNotNull()).select("sid", x["doc_id"].alias("doc_id"), x["size"].alias("size"), (x["base"] + F.col("up")).alias("copies"), x["row"].alias("row"))
    )
    exact = with_chance(placed.filter("large"), F.col("f")).filter("p = 0").withColumn("copies", F.col("base")).select(*told)
    shares = folded.select("sid", "g")
    shares = F.broadcast(shares) if small(shares, BROADCAST_SOURCES) else shares
    drawn = with_chance(placed.filter("not large").join(shares, "sid"), F.col("g"))
    whole = drawn.filter("p = 0").withColumn("copies", F.col("base")).select(*told).unionByName(exact.select(*told)).unionByName(first)
    level, results, depth = drawn.filter("p > 0").select("sid", "n", item.alias("item")), [whole], 0
    most = sources.agg(F.max("n")).first()[0] or 0
    while most:
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(BLOCK))).cast("long")
        level = (
            level.withColumn("blocks", blocks)
            .groupBy("sid", "blocks", F.pmod(F.xxhash64(F.col("item.key"), F.lit(depth + 1)), F.col("blocks")).alias("block"))
            .agg(F.array_sort(F.collect_list("item")).alias("items"))
            .select("sid", F.col("blocks").alias("n"), _fold(F.col("items"), seed + depth).alias("r"))
        )
        level = settle(level.select("sid", "n", "r.left", "r.done"))
        results.append(level.select("sid", F.explode("done").alias("x")).select("sid", "x.doc_id", "x.size", "x.copies", "x.row"))
        most = 0 if most <= BLOCK else -(-most // BLOCK)
        if not most:
            x = F.col("left")
            drawn_up = _chance(x["key"], F.lit(depth), seed + 1) < x["p"]
            results.append(
                level.filter("left is not null").select(
                    "sid", x["doc_id"].alias("doc_id"), x["size"].alias("size"), (x["base"] + drawn_up.cast("long")).alias("copies"), x["row"].alias("row")
                )
            )
        level = level.filter("left is not null").select("sid", "n", F.col("left").alias("item"))
        depth += 1
    rows = results[0]
    for more in results[1:]:
        rows = rows.unionByName(more)
    rows = _repaired(settle(rows.withColumn("uid", F.monotonically_increasing_id())), sources.select("sid", "target"), cap, seed)
    return rows.join(side, "sid").select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"),
        *([] if row is None else [F.col("row").alias(row)]),
    )


def _repaired(rows: DataFrame, sources: DataFrame, cap: float, seed: int) -> DataFrame:
    """rows with a few copies more or less, so that the sources' words come nearer to their targets."""
    taken = rows.groupBy("sid").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    lack = settle(sources.join(taken, "sid").select("sid", (F.col("target") - F.col("words")).alias("lack")).filter("abs(lack) > 0.5"))
    changed = None
    for _ in range(REPAIRS):
        near = F.broadcast(lack) if small(lack, BROADCAST_SOURCES) else lack
        free = rows if changed is None else rows.join(F.broadcast(changed.select("uid")) if small(changed, BROADCAST_SOURCES) else changed.select("uid"), "uid", "left_anti")
        able = free.join(near, "sid").filter(((F.col("lack") > 0) & (F.col("copies") < int(cap))) | ((F.col("lack") < 0) & (F.col("copies") > 0)))
        gap = F.abs(F.abs("lack") - F.col("size"))
        best = able.filter((F.col("size") > 0) & (gap < F.abs("lack"))).groupBy("sid").agg(
            F.min(F.struct(gap.alias("gap"), F.xxhash64("doc_id", F.lit(seed)).alias("h"), "uid", "size", F.signum("lack").cast("long").alias("step"))).alias("b")
        )
        now = settle(best.select("sid", "b.uid", "b.step", "b.size"))
        if now.isEmpty():
            break
        lack = settle(lack.join(now, "sid", "left").select("sid", (F.col("lack") - F.coalesce(F.col("step") * F.col("size"), F.lit(0))).alias("lack")))
        changed = now if changed is None else changed.unionByName(now)
    if changed is None:
        return rows
    steps = changed.select("uid", "step")
    steps = F.broadcast(steps) if small(steps, BROADCAST_SOURCES) else steps
    return rows.join(steps, "uid", "left").withColumn("copies", F.col("copies") + F.coalesce("step", F.lit(0)))
