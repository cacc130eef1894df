"""Quality rules on whole hosts: failures of document rules by host, shrunk towards all hosts, and back to documents.

Each document is tested by the rules of RULES on statistics of its whole text. Of each host and rule, documents
and failures are counted; the hosts' rates are taken as drawn from a beta distribution whose mean and spread are
estimated from all hosts by moments (an empirical prior), and the rate of a host is its posterior mean. So a host
of few documents is judged mostly by what hosts are like, and a host of many by its own. A host is refused if
under any rule its shrunk rate is above MOST_FAILING; its documents go with it. A document that fails a rule of
BASE goes anyway.

Windows that repeat inside a text are found in its row: the windows' 64-bit hashes are sorted with their places, and
neighbours of equal hash are compared by their words, so nothing is taken for a repeat that is none (a repeat
could only be missed between two different windows of one hash).

Defined cases: a null text has no words and fails for being short; documents of a null host share one; rows are
documents, whatever their ids; with one host the prior adds nothing; an empty table gives no rows; extra columns are not
looked at; a text of any length is read whole, in one row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import settle, small

#: Words of a window; a power of two.
WINDOW = 8
WORD, SYMBOLS = r"[^\x20\x09-\x0D]+", "[#*$%&|<>]+"
#: A host whose shrunk rate of failures under any rule is above this is refused.
MOST_FAILING = 0.5
#: Refused hosts up to which their names are broadcast; beyond, the join shuffles.
BROADCAST_HOSTS = 100_000

#: Rules, by name: a document of which this holds fails.
RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 12 * n_words",
}
BASE = ("short", "repeats")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once a row."""
    return F.transform(F.array(value), then)[0]


def with_windows(rows: DataFrame) -> DataFrame:
    """rows with `windows`: hashes of every WINDOW words in a row, by where they start, from those of half as many."""
    rows, size = rows.withColumn("windows", F.transform("words", lambda x: F.xxhash64(x))), 1
    while size < WINDOW:
        half = F.lit(size)
        rows, size = rows.withColumn("windows", F.transform("windows", lambda x, i: F.xxhash64(x, F.get("windows", i + half)))), 2 * size  # noqa: B023
    none = F.array().cast("array<bigint>")
    return rows.withColumn("windows", F.when(F.size("words") >= WINDOW, F.slice("windows", 1, F.size("words") - (WINDOW - 1))).otherwise(none))


def repeat_words(words: Column, windows: Column) -> Column:
    """How many of the words are in a stretch of WINDOW words that occurs again in them."""

    def places(by_hash: Column) -> Column:
        def same(x: Column, other: Column) -> Column:
            equal = [F.get(words, x["i"] + k) == F.get(words, other["i"] + k) for k in range(WINDOW)]
            return F.coalesce(reduce(Column.__and__, equal, x["h"] == other["h"]), F.lit(False))

        held = F.filter(by_hash, lambda x, i: same(x, F.get(by_hash, i - 1)) | same(x, F.get(by_hash, i + 1)))
        return F.array_sort(F.transform(held, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        new = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(new, F.lit(0), lambda n, x: n + x)

    by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Most texts have no hash twice.
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(let(by_hash, places), covered)).cast("long")


def statistics(documents: DataFrame, host: str) -> DataFrame:
    """doc_id, host and the statistics that rules look at; no text."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    rows = with_windows(rows.withColumns({"words": F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), "lines": lines}))
    return rows.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words"), F.col("windows")).alias("n_repeat_words"),
    )


def host_rates(found: DataFrame) -> DataFrame:
    """Per host and rule: documents, failures, and the failures' rate shrunk by the beta prior of all hosts."""
    counts = found.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items()])
    counts = settle(counts)
    rates = counts.select("host", "n", F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("k")) for name in RULES])).alias("x"))
    rates = rates.select("host", "n", "x.rule", "x.k")
    # Moments of rates weighted by documents: what they differ by beyond what drawing n documents does.
    total = rates.groupBy("rule").agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("all_n"), F.sum("k").alias("all_k"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    )
    mean = F.col("all_k") / F.col("all_n")
    total = total.select("rule", "all_n", mean.alias("mean"), (F.col("kk") - F.col("all_n") * mean * mean).alias("between"), (F.col("hosts") - 1).alias("df"), (F.col("all_n") - F.col("nn") / F.col("all_n")).alias("weight"))
    spread = F.col("mean") * (1 - F.col("mean"))
    share = (F.col("between") - spread * F.col("df")) / F.nullif(spread * (F.col("weight") - F.col("df")), F.lit(0.0))
    # A share of 0 means that hosts don't differ (a prior as heavy as all documents), of 1 that a host is all or nothing.
    least = 1 / (1 + F.col("all_n"))
    prior = total.select("rule", "mean", share.alias("share"), least.alias("least"))
    prior = prior.select("rule", "mean", F.greatest(F.least(F.coalesce("share", "least"), F.lit(1.0)), "least").alias("share"))
    strength = (1 - F.col("share")) / F.col("share")
    shrunk = (F.col("k") + F.col("mean") * strength) / (F.col("n") + strength)
    # One row a rule.
    return rates.join(F.broadcast(prior), "rule").select("host", "rule", "n", "k", shrunk.alias("rate"))


def judge(documents: DataFrame, host: str = "source") -> DataFrame:
    """Per document: doc_id, host, the statistics, base_failed, host_rate (the largest of its host's shrunk rates) and kept."""
    found = settle(statistics(documents, host))
    hosts = settle(host_rates(found).groupBy("host").agg(F.max("rate").alias("host_rate")))
    hosts = hosts.select(F.col("host").alias("of_host"), "host_rate")
    # A host is one row of the right side, so a hot host of the left can be split.
    rows = found.join(F.broadcast(hosts) if small(hosts, BROADCAST_HOSTS) else hosts, F.col("host").eqNullSafe(F.col("of_host")))
    failed = F.expr(" or ".join(f"({RULES[name]})" for name in BASE))
    rows = rows.withColumn("base_failed", failed).drop("of_host")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= MOST_FAILING))
