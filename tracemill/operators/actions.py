"""Timelines of actions: repeats, failures, roles, transitions. One window sort per user serves each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER = ["ts", "event_id"]


def by_user():
    return Window.partitionBy("user_id").orderBy(*ORDER)


def repeats(timeline: DataFrame, kind: str) -> DataFrame:
    """Per user: actions of a kind whose signature came before. Counts instead of ranks: n minus distinct."""
    return timeline.filter(F.col("event_type") == kind).groupBy("user_id", "props").count().groupBy("user_id").agg(F.sum(F.col("count") - 1).alias("repeats"))


def time_to(timeline: DataFrame, kind: str) -> DataFrame:
    """Per user: milliseconds from the first action to the first of a kind; null if there is none."""
    first = F.min("ts").alias("start")
    got = F.min(F.when(F.col("event_type") == kind, F.col("ts"))).alias("reached")
    us = F.unix_micros(F.col("reached").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))
    return timeline.groupBy("user_id").agg(first, got).select("user_id", F.floor(us / 1000).alias("ms"))


def roles(timeline: DataFrame, patch: str | None = "purchase", failed: str = "error") -> DataFrame:
    """Adds role: first action, final answer, patch (if named), recovery after a failure, else tool choice."""
    whole = Window.partitionBy("user_id")
    n, last = F.row_number().over(by_user()), F.count("*").over(whole)
    before = F.lag("event_type").over(by_user())
    role = F.when(n == 1, "first-action").when(n == last, "final-answer")
    if patch is not None:
        role = role.when(F.col("event_type") == patch, "patch")
    return timeline.withColumn("role", role.when(before == failed, "failure-recovery").otherwise("tool-selection"))


def transitions(timeline: DataFrame) -> DataFrame:
    moved = timeline.select("user_id", F.lag("event_type").over(by_user()).alias("old"), F.col("event_type").alias("new"))
    return moved.filter("old is not null").groupBy("old", "new").agg(F.count("*").alias("n"))


def adjacent(timeline: DataFrame) -> DataFrame:
    """Per user: actions equal to the one before, and their share of all."""
    flagged = timeline.select("user_id", (F.lag("event_type").over(by_user()) == F.col("event_type")).cast("long").alias("d"))
    return flagged.groupBy("user_id").agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("dup_count"), F.round(F.coalesce(F.sum("d"), F.lit(0)) / F.count("*"), 6).alias("dup_rate")
    )


def loops(timeline: DataFrame, least: int = 2) -> DataFrame:
    """Per user: runs of at least so many equal actions."""
    n = F.row_number().over(by_user())
    m = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy(*ORDER))
    runs = timeline.select("user_id", "event_type", (n - m).alias("island")).groupBy("user_id", "event_type", "island").count()
    return runs.groupBy("user_id").agg(F.sum((F.col("count") >= least).cast("long")).alias("loop_count"))


def recovery(timeline: DataFrame, failed: str = "error") -> DataFrame:
    """Per user: share of failures after which some later action is none; 0 without failures.

    A failure is recovered if it comes before the user's last success, so one grouping finds these and a join by
    user compares, without a window over a user's actions.
    """
    bad, at = F.col("event_type") == failed, F.struct(*ORDER)
    last = timeline.groupBy("user_id").agg(F.max(F.when(~bad, at)).alias("last"), F.count(F.when(bad, 1)).alias("n"))
    later = timeline.filter(bad).join(last.select("user_id", "last"), "user_id").filter(at < F.col("last")).groupBy("user_id").agg(F.count("*").alias("good"))
    rate = F.coalesce(F.try_divide(F.coalesce(F.col("good"), F.lit(0)), F.col("n")), F.lit(0.0))
    return last.join(later, "user_id", "left").select("user_id", F.round(rate, 6).alias("rate"))


def terminal(timeline: DataFrame, kind: str = "purchase") -> DataFrame:
    """Per user: the last event of a kind and how many there are."""
    own = F.col("event_type") == kind
    return timeline.groupBy("user_id").agg(
        F.max(F.when(own, F.struct("ts", "event_id")))["event_id"].alias("last_event_id"), F.count(F.when(own, 1)).alias("n_terminal")
    )


def attested(timeline: DataFrame) -> DataFrame:
    """Per user: the latest verdict that is not null."""
    verdict = F.when(F.col("event_type") == "purchase", "PASSED").when(F.col("event_type") == "error", "FAILED")
    return timeline.groupBy("user_id").agg(F.max(F.when(verdict.isNotNull(), F.struct("ts", "event_id", verdict.alias("v"))))["v"].alias("verdict"))


def unclosed(timeline: DataFrame, opener: str = "view", closer: str = "click") -> DataFrame:
    """Per user: opened signatures that are never closed."""
    opened = F.collect_set(F.when(F.col("event_type") == opener, F.col("props")))
    closed = F.collect_set(F.when(F.col("event_type") == closer, F.col("props")))
    return timeline.groupBy("user_id").agg(F.size(F.array_except(opened, closed)).cast("long").alias("n_unclosed"))


def paired(timeline: DataFrame, call: str = "click", result: str = "purchase") -> DataFrame:
    """Per user: calls with and without a result of the same signature."""
    sides = timeline.groupBy("user_id", "props").agg(
        F.count(F.when(F.col("event_type") == call, 1)).alias("calls"), F.count(F.when(F.col("event_type") == result, 1)).alias("results")
    )
    return sides.groupBy("user_id").agg(
        F.sum(F.when(F.col("results") > 0, F.col("calls")).otherwise(0)).alias("matched"),
        F.sum(F.when(F.col("results") == 0, F.col("calls")).otherwise(0)).alias("unmatched"),
    )


def lacking(timeline: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Per user: required kinds that are not there, sorted and joined."""
    there = F.collect_set("event_type")
    missing = F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), there))
    return timeline.groupBy("user_id").agg(F.array_join(missing, ",").alias("missing"))
