"""Benchmark decontamination by winnowing.

Both sides become words; from every window of consecutive k-gram hashes the smallest (the leftmost of
equal ones) is kept as a fingerprint. Two texts that share n words in a row share a whole window, hence a
fingerprint, as k + window - 1 = n. Fingerprints of documents and items are joined, and each hit is
extended word by word to both sides; a run of n equal words or more is contaminated. An extension by
n - k words to each side is enough, since every shared n words have a fingerprint of their own.

Items of fewer than n words, but not none, are one window of their own length L: the same is done with
n = L, for each L that occurs.

Defined cases: a null or wordless text has no words, no hits and, as an item, no window; repeated items
are one item by item_id; each row is a document of its own, also rows that share a doc_id or have none; of equal
hashes in a window the leftmost is kept; a text of any length is read whole, and its words leave its row only
once, if some fingerprint is met; an empty benchmark leaves everything clean; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import settle, small

#: Runs between words, after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Item fingerprints up to which they are broadcast; beyond, the join shuffles.
BROADCAST_FINGERPRINTS = 400_000


def words(text: Column) -> Column:
    """The words of a text; null gives none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, GAP), lambda w: w != "")


def _lengths(n: int) -> tuple[int, int]:
    """k and the window for which k + window - 1 = n."""
    k = (n + 1) // 2
    return k, n - k + 1


def _grams(hashes: str, k: int) -> Column:
    """Hashes of the k-grams of an array of word hashes, in order."""
    at = F.sequence(F.lit(0), F.size(hashes) - k)
    gram = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(k)]))
    return F.when(F.size(hashes) >= k, gram).otherwise(F.array().cast("array<bigint>"))


def fingerprints(rows: DataFrame, n: int, keep: list[str]) -> DataFrame:
    """keep plus `chosen`: array of (n, gram hash, position) of the fingerprints for windows of n words.

    The minimum is over 32 bits of hash above 31 bits of position, so it is the leftmost of the least.
    """
    k, window = _lengths(n)
    grams = rows.withColumn("_g", _grams("hashes", k))
    packed = grams.withColumn(
        "_p", F.transform("_g", lambda g, i: F.shiftleft(F.shiftrightunsigned(g, 33), 31).bitwiseOR(i.cast("long")))
    )
    starts = F.sequence(F.lit(0), F.size("_p") - window)
    least = F.transform(starts, lambda i: F.least(*[F.get(F.col("_p"), i + j) for j in range(window)])) if window > 1 else F.col("_p")
    minima = packed.withColumn(
        "_m", F.array_distinct(F.when(F.size("_p") >= window, least).otherwise(F.array().cast("array<bigint>")))
    )

    def entry(m: Column) -> Column:
        at = m.bitwiseAND(F.lit(2**31 - 1)).cast("int")
        return F.struct(F.lit(n).alias("n"), F.get(F.col("_g"), at).alias("gram"), at.alias("at"))

    return minima.select(*keep, F.transform("_m", entry).alias("chosen"))


def _with_words(table: DataFrame, key: str) -> DataFrame:
    return (
        table.select(key, words(F.col("text")).alias("words"))
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    )


NONE = "array<struct<n:int,gram:bigint,at:int>>"


def _all_fingerprints(rows: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """As fingerprints, for several n at once, in one pass."""
    out = rows.withColumn("_all", F.array().cast(NONE))
    for n in lengths:
        out = fingerprints(out, n, [*keep, "hashes", "_all"]).select(*keep, "hashes", F.concat("_all", "chosen").cast(NONE).alias("_all"))
    return out.select(*keep, F.col("_all").alias("chosen"))


def _context(array: Column, at: Column, k: int, side: int) -> Column:
    """The words from `side` before `at` to `side` after the gram, null outside the text."""
    return F.transform(F.sequence(at - side, at + (k + side - 1)), lambda i: F.get(array, i))


def decontaminate(documents: DataFrame, benchmark: DataFrame, n: int = 10, row: str | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, as the module says.

    row names a column of unique numbers in a settled table, which is handed through.
    """
    items = (
        _with_words(benchmark, "item_id")
        .filter(F.size("words") > 0)
        .withColumn("n", F.least(F.lit(n), F.size("words")))
    )
    # Of fewer than n lengths; each is a parameter of the plan that follows.
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())
    own = None
    for m in lengths:
        k, _ = _lengths(m)
        part = (
            fingerprints(items.filter(F.col("n") == m), m, ["item_id", "words"])
            # explode would infer a filter on the whole chain of expressions below it, explode_outer does not
            .select("item_id", "words", F.explode_outer("chosen").alias("c"))
            .filter("c is not null")
            .select(
                F.col("c.n").alias("n"),
                F.col("c.gram").alias("gram"),
                F.col("item_id").cast("string").alias("item"),
                _context(F.col("words"), F.col("c.at"), k, m - k).alias("theirs"),
            )
        )
        own = part if own is None else own.unionByName(part)
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    plain = settle(documents.select(number.alias("_row"), "doc_id", "text"))
    whole = ["_row", "doc_id", "n_words"]
    none = F.array().cast("array<string>")
    if own is None:
        found = plain.select("_row", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
        return _named(found, row)
    # One row per distinct context, with the items that have it.
    own = settle(
        own.groupBy("n", "gram", "theirs").agg(F.collect_set("item").alias("items")).withColumn("context", F.monotonically_increasing_id())
    )
    # The entry (0, 0) is met by the one that carries each document's word count.
    entry = documents.sparkSession.range(1).select(
        F.lit(0).alias("n"), F.lit(0).cast("long").alias("gram"), F.array().cast("array<string>").alias("theirs"), F.lit(-1).cast("long").alias("context")
    )
    side = own.select("n", "gram", "theirs", "context").unionByName(entry)
    side = F.broadcast(side) if small(side, BROADCAST_FINGERPRINTS) else side

    docs = plain.select("_row", "doc_id", words(F.col("text")).alias("words")).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    docs = docs.select("_row", "doc_id", "hashes", F.size("words").alias("n_words"))
    marks = _all_fingerprints(docs, lengths, whole)
    # The first entry of each document carries its word count through the join.
    first = F.array(F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("gram"), F.col("n_words").alias("at"))).cast(NONE)
    rows = marks.select("_row", "doc_id", F.explode_outer(F.concat(first, F.col("chosen"))).alias("c")).select("_row", "doc_id", "c.n", "c.gram", "c.at")
    met = settle(rows.join(side, ["n", "gram"]).select("_row", "doc_id", "n", "at", "theirs", "context"))
    counted = met.filter("n = 0").select("_row", "doc_id", F.col("at").cast("long").alias("n_words"))

    # Documents that met a fingerprint, each with what it met, and its words.
    hits = settle(met.filter("n > 0").groupBy("_row").agg(F.collect_list(F.struct("n", "at", "theirs", "context")).alias("hits")))
    ids = hits.select("_row")
    some = plain.join(F.broadcast(ids) if small(ids, BROADCAST_FINGERPRINTS) else ids, "_row", "left_semi").select("_row", words(F.col("text")).alias("words"))

    def extended(h: Column, own: Column) -> Column:
        """Which run of a document's words a hit extends to, and whether it is long enough."""
        k = F.floor((h["n"] + 1) / 2).cast("int")
        side_words = h["n"] - k
        # Which words of the item's context stand at the same place in the document, as a string of 0 and 1.
        same = F.concat_ws("", F.transform(h["theirs"], lambda w, i: F.when(F.get(own, h["at"] - side_words + i) == w, F.lit("1")).otherwise(F.lit("0"))))

        def run(bits: Column) -> Column:
            left = F.length(F.regexp_extract(bits.substr(F.lit(1), side_words), "1*$", 0))
            right = F.length(F.regexp_extract(bits.substr(side_words + k + 1, side_words), "^1*", 0))
            middle = bits.substr(side_words + 1, k) == F.repeat(F.lit("1"), k)
            length = left + k + right
            return F.struct(
                (h["at"] - left).alias("start"), (h["at"] - left + length).alias("end"), h["context"].alias("context"), (middle & (length >= h["n"])).alias("ok")
            )

        return F.transform(F.array(same), run)[0]

    runs = some.join(hits, "_row").select("_row", F.transform("hits", lambda h: extended(h, F.col("words"))).alias("runs"))
    runs = runs.select("_row", F.filter("runs", lambda r: r["ok"]).alias("runs"))
    spans = F.array_sort(F.array_distinct(F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))))

    def cover(state: Column, s: Column) -> Column:
        fresh = F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], state["end"]))
        return F.struct((state["words"] + fresh).alias("words"), F.greatest(state["end"], s["end"]).alias("end"))

    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
    covered = settle(runs.select("_row", F.aggregate(spans, zero, cover)["words"].cast("long").alias("n_hit"), F.array_distinct(F.transform("runs", lambda r: r["context"])).alias("contexts")))
    found = own.select("context", "items")
    found = F.broadcast(found) if small(found, BROADCAST_FINGERPRINTS) else found
    named = (
        covered.filter("n_hit > 0").select("_row", F.explode("contexts").alias("context")).join(found, "context")
        .select("_row", F.explode("items").alias("item")).groupBy("_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hit = settle(covered.filter("n_hit > 0").select("_row", "n_hit").join(named, "_row"))
    hit = F.broadcast(hit) if small(hit, BROADCAST_FINGERPRINTS) else hit
    joined = counted.join(hit, "_row", "left").select(*whole, F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
    return _named(joined, row)


def _named(found: DataFrame, row: str | None) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.col("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items", *([] if row is None else [F.col("_row").alias(row)]),
    )
