"""Episodes as numbered sequences: integrity, gaps, collisions, first and last arrivals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def integrity(log: DataFrame, first: int = 0) -> DataFrame:
    """Per episode: state, n_events, n_distinct_seq, n_gaps. One grouping, combined map-side."""
    per = log.groupBy("episode").agg(
        F.count("*").alias("n_events"), F.size(F.collect_set("seq")).cast("long").alias("n_distinct_seq"), F.max("seq").alias("last")
    )
    gaps = (F.col("last") - first + 1).cast("long") - F.col("n_distinct_seq")
    state = F.when(F.col("n_events") > F.col("n_distinct_seq"), "CORRUPT").when(gaps > 0, "PARTIAL").otherwise("COMPLETE")
    return per.select("episode", state.alias("state"), "n_events", "n_distinct_seq", gaps.alias("n_gaps"))


def gaps(log: DataFrame, first: int = 0) -> DataFrame:
    """One row per number between first and an episode's last that it lacks: only the holes between neighbours are
    written out, so the work follows what is there and missing, not the largest number."""
    order = Window.partitionBy("episode").orderBy("seq")
    seen = log.select("episode", F.col("seq").cast("long").alias("seq")).distinct().withColumn("before", F.coalesce(F.lag("seq").over(order), F.lit(first - 1)))
    holes = seen.filter(F.col("seq") > F.col("before") + 1)
    return holes.select("episode", F.explode(F.sequence(F.col("before") + 1, F.col("seq") - 1)).alias("gap_seq"))


def collisions(log: DataFrame) -> DataFrame:
    return log.groupBy("episode", "seq").agg(F.count("*").alias("copies")).filter("copies > 1")


def classified(log: DataFrame, keys: list[str], arrival: list[Column]) -> DataFrame:
    """Adds status: APPENDED for an id's first arrival, DUPLICATE if equal to it, CONFLICT if not."""
    rest = [c for c in log.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy(*arrival)
    whole = F.struct(*rest)
    ranked = log.withColumn("_n", F.row_number().over(order)).withColumn("_first", F.first(whole).over(order))
    status = F.when(F.col("_n") == 1, "APPENDED").when(whole.eqNullSafe(F.col("_first")), "DUPLICATE").otherwise("CONFLICT")
    return ranked.withColumn("status", status).drop("_n", "_first")


def compacted(log: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """The last arrival of each id, by an aggregate instead of a sort."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max(F.struct(*arrival, *[c for c in rest if c not in arrival])).alias("s"))
    return last.select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest])


def manifest(log: DataFrame) -> DataFrame:
    """Per episode: count and a digest of its sorted numbers."""
    return log.groupBy("episode").agg(
        F.count("*").alias("n_events"), F.sha2(F.array_join(F.array_sort(F.collect_list("seq")), ","), 256).alias("ids_sha256")
    )


def monotonic(rows: DataFrame, group: str, order: list[str], clock: str) -> DataFrame:
    """Adds repaired: a clock that rises by one at least, in closed form."""
    w = Window.partitionBy(group).orderBy(*order)
    numbered = rows.withColumn("_i", F.row_number().over(w).cast("long"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return numbered.withColumn("repaired", F.col("_i") + F.max(F.col(clock) - F.col("_i")).over(upto)).drop("_i")
