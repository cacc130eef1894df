"""Document fingerprints by invertible Bloom lookup sketches, in Spark expressions.

A text is the set of its paragraphs' digests: lines, cut after sentence marks, and where a piece is longer than
LONG, after words that their own hash tells, so that equal passages are cut alike wherever they stand; words
longer than WORD are cut every WORD characters. A sketch is a row of cells in three parts; a digest goes into
one cell of each part, and a cell holds the count, the exclusive or of its digests and that of their check
sums. Subtracting two versions' sketches cancels what they share; peeling cells that hold one digest then
recovers those that differ, and their numbers give the likeness: the shared digests over all.

A document's fingerprint is its sketch, written out: the width of a part and its cells that are not empty. The
width is twice the number of digests or more, and larger until no two digests share all their cells, so that a
written sketch peels on its own, back to the digests (but for about one text in ten thousand, by knots of more
digests). From two fingerprints alone, however different in size, both sketches can therefore be made again at a
size of choice; that is what the likeness does, at a width by both numbers of digests. What does not peel is
made again at larger widths, and what even the last does not resolve has its digests compared as they are.

Cells are rows: the digests are dealt out by document and cell and added up, and each round of peeling is a
grouping of the cells that are left, with the digests that cells of one part hold alone taken from all parts.
The documents lie in a table in buckets of ranges, so all these groupings take place where the bucket is
read, without a shuffle, and in time that follows the number of paragraphs, also for very long texts.

Defined cases: a null text is empty; an empty text has no paragraph, and two such are alike (1.0); repeated
paragraphs count once; repeated rows are rows of their own, each other's next; a null doc_id comes last; of
equal doc_ids the smaller text comes first; a single document is its own next; an empty table gives no rows;
extra columns are not looked at.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import BROADCAST_IDS, settle, shared_folder, small

PARTS = 3
#: Least cells of a part; cells of a part for each digest of two versions, as tried; rounds of peeling, one part each.
LEAST, WIDTHS, ROUNDS = 16, (0.75, 3.0), 12
#: Digests of a cell that are looked for beside each other.
NEAR = 6
#: Where texts are cut; characters from which a piece is cut again, after about every EVERY-th word.
CUT, LONG, EVERY = r"\n+|(?<=[.!?])\s+|(?<=[\u3002\uff01\uff1f])\s*", 256, 8
#: Characters of a word, of a long piece, after which it is cut.
WORD = 64
#: Documents of a range that one window goes through, on average, and ranges at most (they only get longer).
RANGE_ROWS, RANGES = 1024, 10_000
#: Documents of a bucket of the table, on average.
BUCKET_ROWS = 1024

def _parts(piece: Column) -> Column:
    """A long piece, cut after words that their hash tells; longer words by length."""

    def cut(words: Column) -> Column:
        size = F.size(words)
        told = lambda w: (F.pmod(F.xxhash64(w), F.lit(EVERY)) == 0) | (F.length(w) == WORD)
        ends = F.filter(F.sequence(F.lit(1), size), lambda i: (i == size) | told(F.get(words, i - 1)))
        start = lambda e, k: F.when(k == 0, F.lit(0)).otherwise(F.get(e, k - 1))
        return F.transform(F.array(ends), lambda e: F.transform(e, lambda end, k: F.array_join(F.slice(words, start(e, k) + 1, end - start(e, k)), " ")))[0]

    words = F.regexp_extract_all(piece, F.lit(rf"(\S{{1,{WORD}}})"), F.lit(1))
    return F.transform(F.array(words), cut)[0]


def pieces(text: Column) -> Column:
    """A text's paragraphs."""
    parts = F.filter(F.transform(F.split(text, CUT), lambda x: F.trim(x)), lambda x: x != "")
    cut = F.flatten(F.transform(parts, lambda x: F.when(F.length(x) <= LONG, F.array(x)).otherwise(_parts(x))))
    return F.when(F.length(text) <= LONG, parts).otherwise(cut)


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    return F.array_distinct(F.transform(pieces(text), lambda x: F.xxhash64(x)))


def _place(digest: Column, part: int, width: Column) -> Column:
    """The cell of a part that a digest goes into."""
    return (F.pmod(F.shiftrightunsigned(digest, 16 * part), width) + part * width).cast("int")


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(1))


def _power(least: Column) -> Column:
    """The power of two from there on."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(least, F.lit(float(LEAST)))))).cast("bigint")


def written_width(own: Column) -> Column:
    """The width of a written sketch."""
    base = _power(F.size(own) * 2.0)
    told = F.lit(None).cast("bigint")
    for factor in (64, 16, 4, 1):
        code = lambda d, w=factor: (_place(d, 0, base * w) + (_place(d, 1, base * w) + _place(d, 2, base * w) * base * w * 3) * base * w * 3)
        distinct = F.size(F.array_distinct(F.transform(own, lambda d: code(d)))) == F.size(own)
        told = F.when(distinct, base * factor).otherwise(told if factor < 64 else base * 256)
    return told


KEYS = ["range", "row", "what"]


def _dealt(rows: DataFrame) -> DataFrame:
    """rows (KEYS, width, sign, d) as cells: what each cell of each sketch counts and adds up."""
    places = F.array(*[_place(F.col("d"), p, F.col("width")) for p in range(PARTS)])
    dealt = rows.select(*KEYS, "width", "sign", "d", _check(F.col("d")).alias("c"), F.explode(places).alias("cell"))
    return dealt.groupBy(*KEYS, "width", "cell").agg(F.sum("sign").alias("n"), F.bit_xor("d").alias("key"), F.bit_xor("c").alias("sum"))


def _peeled(cells: DataFrame) -> DataFrame:
    """Per sketch: plus and minus (digests found with either sign) and left (cells that are not resolved)."""
    zero = F.lit(0).cast("bigint")
    now = cells.filter("n <> 0 or key <> 0 or sum <> 0").withColumn("plus", zero).withColumn("minus", zero)
    cell = lambda at, n, key, sum, plus, minus: F.struct(at.alias("cell"), n.alias("n"), key.alias("key"), sum.alias("sum"), plus.alias("plus"), minus.alias("minus"))
    for k in range(ROUNDS):
        n, key, at, width = F.col("n"), F.col("key"), F.col("cell"), F.col("width")
        alone = (at >= (k % PARTS) * width) & (at < (k % PARTS + 1) * width) & (F.abs(n) == 1) & (F.col("sum") == _check(key))
        itself = cell(at, n, key, F.col("sum"), F.col("plus"), F.col("minus"))
        # A digest has one cell in the part, so it is taken once; the count goes to a cell of its own.
        away = [cell(_place(key, p, width), -n, key, F.col("sum"), zero, zero) for p in range(PARTS)]
        found = cell(F.lit(-1), zero, zero, zero, (n == 1).cast("bigint"), (n == -1).cast("bigint"))
        after = now.select(*KEYS, "width", F.explode(F.when(alone, F.array(itself, *away, found)).otherwise(F.array(itself))).alias("x")).select(*KEYS, "width", "x.*")
        now = (
            after.groupBy(*KEYS, "width", "cell")
            .agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("sum").alias("sum"), F.sum("plus").alias("plus"), F.sum("minus").alias("minus"))
            .filter("cell < 0 or n <> 0 or key <> 0 or sum <> 0")
        )
    return now.groupBy(*KEYS).agg(F.sum("plus").alias("plus"), F.sum("minus").alias("minus"), F.count(F.when(F.col("cell") >= 0, 1)).alias("left"))


def differences(pairs: DataFrame) -> DataFrame:
    """pairs (KEYS, a, b: digests) -> per pair plus and minus: how many digests only a has and only b has. Pairs that agree
    in all are left out."""
    done = None
    for k, factor in enumerate(WIDTHS):
        width = _power((F.size("a") + F.size("b")) * F.lit(float(factor)))
        sides = F.array(*[F.struct(F.lit(sign).alias("sign"), F.col(c).alias("d")) for sign, c in ((1, "a"), (-1, "b"))])
        rows = pairs.select(*KEYS, width.alias("width"), F.explode(sides).alias("s")).select(*KEYS, "width", "s.sign", F.explode("s.d").alias("d"))
        found = settle(_peeled(_dealt(rows)))
        good = found.filter("left = 0").select(*KEYS, "plus", "minus")
        done = good if done is None else done.unionByName(good)
        failed = found.filter("left > 0").select(*KEYS)
        if failed.isEmpty():
            return done
        failed = F.broadcast(failed) if small(failed, BROADCAST_IDS) else failed
        pairs = settle(pairs.join(failed, KEYS, "left_semi"))
    rest = pairs.select(*KEYS, F.size(F.array_except("a", "b")).cast("long").alias("plus"), F.size(F.array_except("b", "a")).cast("long").alias("minus"))
    return done.unionByName(rest)


def written(own: Column) -> Column:
    """The sketch of a set of digests as text: the width, and of each cell that is not empty its place, count, digest and
    check sum, in hexadecimal. Each cell's digests lie side by side once all are sorted by place."""
    width = written_width(own)

    def entries_of(p: int, w: Column) -> Column:
        return F.transform(own, lambda d: F.struct(_place(d, p, w).alias("at"), d.alias("d"), _check(d).alias("c")))

    def cell(entries: Column, e: Column, i: Column) -> Column:
        here = lambda x: x["at"] == e["at"]
        # More than NEAR in one cell are next to none, but then all are looked through.
        same = F.when(F.coalesce(F.get(entries, i + NEAR)["at"] == e["at"], F.lit(False)), F.filter(entries, here)).otherwise(F.filter(F.slice(entries, i + 1, F.lit(NEAR)), here))
        xor = lambda held, c: F.aggregate(held, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(x[c]))
        said = lambda held: F.concat_ws(".", F.hex(e["at"].cast("bigint")), F.hex(F.size(held).cast("bigint")), F.hex(xor(held, "d")), F.hex(xor(held, "c")))
        return F.when(F.coalesce(F.get(entries, i - 1)["at"] == e["at"], F.lit(False)), F.lit(None)).otherwise(F.transform(F.array(same), said)[0])

    def text(w: Column) -> Column:
        entries = F.array_sort(F.flatten(F.array(*[entries_of(p, w) for p in range(PARTS)])))
        return F.transform(F.array(entries), lambda x: F.lower(F.concat_ws("-", F.hex(w), F.transform(x, lambda e, i: cell(x, e, i)))))[0]

    return F.when(F.size(own) == 0, F.lit("0")).otherwise(F.transform(F.array(width), text)[0])


def _rank(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most value, by a coarse step and a fine one."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.lit(bounds[::step])
    upto = F.size(F.filter(coarse, lambda b: b <= value))
    start = F.greatest(upto - 1, F.lit(0)) * step
    fine = F.filter(F.slice(F.lit(bounds), start + 1, F.lit(step)), lambda b: b <= value)
    return F.coalesce(start + F.size(fine), F.lit(0))


def with_next(documents: DataFrame) -> DataFrame:
    """doc_id, text and own (its digests), next and other: those of the next document in falling doc_id, after
    the last the first.

    Documents are dealt to ranges of doc_id, so a text moves once; each range also gets the first document
    of the range below it.
    """
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = plain.count()
    ranges = min(RANGES, -(-count // RANGE_ROWS))
    bounds: list[int] = []
    if ranges > 1:
        cuts = [i / ranges for i in range(1, ranges)]
        found = plain.agg(F.percentile_approx("doc_id", cuts, 20 * ranges).alias("q")).first()["q"] or []
        bounds = sorted(set(found))
    ranked = plain.withColumn("range", _rank(F.col("doc_id"), bounds))
    firsts = {r["range"]: r["top"] for r in ranked.groupBy("range").agg(F.max("doc_id").alias("top")).collect()}
    there = sorted(firsts)
    above = {r: there[(i + 1) % len(there)] for i, r in enumerate(there)}
    spread = len(bounds) + 1
    tops = F.array(*[F.lit(firsts.get(r)).cast("long") for r in range(spread)]) if spread < 64 else F.lit([firsts.get(r, -(2**62)) for r in range(spread)])
    ups = F.lit([above.get(r, 0) for r in range(spread)])
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(ups, F.col("range")).cast("int").alias("range"), F.lit(True).alias("guest"))
    copies = F.when(F.col("doc_id").eqNullSafe(F.get(tops, F.col("range"))), F.array(own, guest)).otherwise(F.array(own))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    return (
        ranked.withColumn("to", F.explode(copies)).select("doc_id", "text", digests(F.col("text")).alias("own"), "to.range", "to.guest")
        .withColumn("next", F.lead("text").over(order)).withColumn("other", F.lead("own").over(order))
        .filter("not guest").select("range", "doc_id", "text", "next", "own", "other")
    )


#: The likenesses, each of two sets of digests, and the sets that are written.
PAIRS = {"near_edited": ("own", "new"), "near_next": ("own", "other")}
PRINTS = {"fingerprint": "own", "edited_fingerprint": "new"}


def edits(documents: DataFrame) -> DataFrame:
    """Per document, before anything is sketched: range, doc_id, n_chars, edited (its edited text), edited_sha256, own and other."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next").substr(F.lit(1), half))
    found = with_next(documents).select("range", "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "other")
    return found.withColumn("edited_sha256", F.sha2("edited", 256))


def fingerprints(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = documents.sparkSession
    whole = ["doc_id", "n_chars", "edited_sha256"]
    told = (
        edits(documents).select("range", *whole, "own", "other", digests(F.col("edited")).alias("new"))
        .select("*", F.monotonically_increasing_id().alias("row"))
    )
    # In buckets of ranges, of as many documents as a task groups at ease: groupings by range and row then shuffle nothing.
    name = f"tracemill_{uuid.uuid4().hex}"
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-documents.count() // BUCKET_ROWS))
    told.write.bucketBy(files, "range").option("path", f"{shared_folder(spark)}/table").saveAsTable(name, format="parquet")
    told = spark.table(name)
    pairs = F.array(*[F.struct(F.lit(k).alias("what"), F.col(a).alias("a"), F.col(b).alias("b")) for k, (a, b) in enumerate(PAIRS.values())])
    found = differences(told.select("range", "row", F.explode(pairs).alias("p")).select("range", "row", "p.*"))
    counts = found.groupBy("range", "row").agg(
        *[F.coalesce(F.sum(F.when(F.col("what") == k, F.col(c))), F.lit(0)).alias(f"{c}{k}") for k in range(len(PAIRS)) for c in ("plus", "minus")]
    )
    size = F.size("own")
    near = []
    for k, name in enumerate(PAIRS):
        plus, minus = (F.coalesce(F.col(f"{c}{k}"), F.lit(0)) for c in ("plus", "minus"))
        near.append(F.when(size + minus == 0, F.lit(1.0)).otherwise((size - plus) / (size + minus)).alias(name))
    return (
        told.join(counts, ["range", "row"], "left").select(*whole, *near, F.transform(F.array(*PRINTS.values()), written).alias("prints"))
        .select(*whole, *[F.get("prints", F.lit(k)).alias(c) for k, c in enumerate(PRINTS)], *PAIRS)
    )
