"""Recovery from files that tools don't find, replayed over an episode's errors: look for the file, read what was found, or stop.

A scope of an episode is searched once, while the budget lasts, and what was found is kept for later errors there. The
controller's state needs no pass over an episode: the scopes in order of their first error spend the budget, so an error's
scope has been searched before if it is among the first of these, and the budget left is what those spent before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import normal
from ..functions.prefix import running
from ..sources.scratch import settle

FILE_NOT_FOUND = "FILE_NOT_FOUND"


def search_pattern(path: Column) -> Column:
    """What to look for: a name of several parts joined by dashes by its last, with its suffix; other names, and those that are
    patterns, as they are; anything, if there is no name."""
    slashed = F.regexp_replace(F.concat(F.lit("/"), F.replace(path, F.lit("\\"), F.lit("/"))), r"(/\.?)+$", "")
    name = F.substring_index(slashed, "/", -1)
    suffix = F.regexp_extract(name, r"(?s)^\.*[^.].*?(\.[^.]*)$", 1)
    parts = F.filter(F.split(F.left(name, F.length(name) - F.length(suffix)), "-"), lambda s: s != "")
    return F.when(name == "", "*").when(name.rlike(r"[*?\[]"), name).when(F.size(parts) >= 2, F.concat(F.lit("*-"), F.element_at(parts, -1), suffix)).otherwise(name)


def scope_path(scope: Column) -> Column:
    return normal(F.replace(scope, F.lit("\\"), F.lit("/")))


def safe_candidates(scope: Column, candidates: Column) -> Column:
    """The candidates that lie in the scope, as normal paths, sorted, each once; relative ones are the scope's."""
    base = scope_path(scope)

    def resolved(candidate: Column) -> Column:
        path = normal(F.replace(candidate, F.lit("\\"), F.lit("/")))
        inside = (path == base) | path.startswith(F.concat(base, F.lit("/"))) | path.startswith("/")
        return F.when(inside, path).otherwise(normal(F.concat(base, F.lit("/"), path)))

    def within(path: Column) -> Column:
        relative = ~path.startswith("/") & (path != "..") & ~path.startswith("../")
        top = F.when(base == "/", path.startswith("/")).otherwise((path == base) | path.startswith(F.concat(base, F.lit("/"))))
        return F.when(base == ".", relative).otherwise(top)

    said = F.filter(candidates, lambda c: c.rlike(r"(?U)\S"))
    return F.array_sort(F.array_distinct(F.filter(F.transform(said, resolved), within)))


def replay(errors: DataFrame, found: DataFrame, budget: int) -> DataFrame:
    """A decision for each error (episode, place, event_id, code, path, scope): action, reason, tool, target, the safe
    candidates, the budget before and after, and whether the scope had been searched. found has what a search of an
    episode's scope gives (episode, scope, candidates); places are whole numbers, none twice in an episode."""
    rows = settle(errors.select("episode", "place", "event_id", "code", "path", "scope"), "errors")
    asks = (F.col("code") == FILE_NOT_FOUND) & F.col("path").isNotNull()
    # The first error of each scope, and how many scopes came before it.
    first = settle(rows.filter(asks).groupBy("episode", "scope").agg(F.min("place").alias("first")), "scopes")
    first = settle(running(first, "episode", "first", {"n": F.lit(1)}).filter(F.col("n") <= budget).select("episode", "scope", "first", "n"), "searched")
    rows = rows.withColumn("asks", F.coalesce(asks, F.lit(False))).join(first, ["episode", "scope"], "left")
    rows = rows.withColumn("opens", F.coalesce(F.col("asks") & (F.col("place") == F.col("first")), F.lit(False)))
    rows = running(settle(rows, "errors"), "episode", "place", {"spent": F.col("opens").cast("long")})
    rows = rows.join(found.select("episode", "scope", "candidates"), ["episode", "scope"], "left")
    cached = F.col("asks") & F.col("first").isNotNull() & ~F.col("opens")
    safe = F.when(cached, safe_candidates(F.col("scope"), F.coalesce("candidates", F.array().cast("array<string>"))))
    rows = rows.withColumns({"cached": cached, "safe": safe, "before": budget - F.col("spent") + F.col("opens").cast("long")})
    one, none = F.size("safe") == 1, F.size("safe") == 0
    other = ~F.col("code").eqNullSafe(F.lit(FILE_NOT_FOUND))
    reason = (
        F.when(other, "UNSUPPORTED_ERROR_CODE").when(F.col("path").isNull(), "MISSING_ERROR_PATH").when(F.col("opens"), "FILE_NOT_FOUND_DISCOVERY").when(~F.col("cached"), "RECOVERY_BUDGET_EXHAUSTED")
        .when(one, "UNIQUE_DISCOVERY_CANDIDATE").when(none, "NO_DISCOVERY_CANDIDATE").otherwise("AMBIGUOUS_DISCOVERY_CANDIDATES")
    )
    rows = rows.withColumn("reason", reason)
    action = F.when(F.col("reason") == "UNSUPPORTED_ERROR_CODE", "NO_ACTION").when(F.col("opens"), "DISCOVER").when(F.col("reason") == "UNIQUE_DISCOVERY_CANDIDATE", "READ").otherwise("TERMINATE")
    target = F.when(F.col("opens"), F.concat(scope_path(F.col("scope")), F.lit("/"), search_pattern(F.col("path")))).when(F.col("reason") == "UNIQUE_DISCOVERY_CANDIDATE", F.get("safe", F.lit(0)))
    told = F.col("asks")
    return rows.select(
        "episode", "place", "event_id", action.alias("action"), "reason", F.when(F.col("opens"), "find").when(F.col("reason") == "UNIQUE_DISCOVERY_CANDIDATE", "read").alias("tool"), target.alias("target"), F.col("safe").alias("candidates"),
        F.when(told, F.col("before")).alias("budget_before"), F.when(told, F.col("before") - F.col("opens").cast("long")).alias("budget_after"), F.when(told & F.col("first").isNotNull(), F.col("cached")).alias("cache_hit"),
    )
