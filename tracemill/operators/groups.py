"""Groups of rewarded attempts and dataset constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def advantages(attempts: DataFrame) -> DataFrame:
    """Adds advantage to attempts (group, reward, ...): the reward less its group's mean, over its population
    deviation; 0 where the group's rewards agree. Moments are grouped with a map-side combine and joined back, so
    a hot group is no window of its own."""
    moments = attempts.groupBy("group").agg(F.avg("reward").alias("mean"), F.stddev_pop("reward").alias("sd"))
    value = F.when(F.col("sd") > 1e-6, (F.col("reward") - F.col("mean")) / (F.col("sd") + 1e-6)).otherwise(0.0)
    return attempts.join(moments, "group").withColumn("advantage", F.round(value, 6)).drop("mean", "sd")


def gate(attempts: DataFrame, least: int = 4) -> DataFrame:
    """Per group: distinct episodes, distinct rewards, and whether it is admitted (large enough, rewards that differ)."""
    per = attempts.groupBy("group").agg(F.count_distinct("episode").alias("size"), F.count_distinct("reward").alias("distinct_rewards"))
    return per.withColumn("admitted", (F.col("size") >= least) & (F.col("distinct_rewards") >= 2))


def leaks(members: DataFrame) -> DataFrame:
    """task, split -> tasks that stand in several splits."""
    return members.groupBy("task").agg(F.size(F.collect_set("split")).cast("long").alias("n_splits")).filter("n_splits > 1")


def preferences(members: DataFrame) -> DataFrame:
    """group, role -> per group: whether it is exactly one chosen and one rejected, and else why not."""
    chosen, rejected = (F.count(F.when(F.col("role") == r, 1)) for r in ("CHOSEN", "REJECTED"))
    per = members.groupBy("group").agg(chosen.alias("c"), rejected.alias("r"), F.count("*").alias("n"))
    reason = (
        F.when(F.col("c") == 0, "no chosen").when(F.col("r") == 0, "no rejected").when((F.col("c") > 1) | (F.col("r") > 1), "not a pair").when(F.col("n") > 2, "other roles").otherwise("")
    )
    return per.select("group", (reason == "").alias("valid"), reason.alias("reason"))


def picked(pool: DataFrame, stratum: str, key: str, quota: int, seed: str) -> DataFrame:
    """Of each stratum the first quota by a seeded digest; ties cannot be."""
    from pyspark.sql import Window

    order = Window.partitionBy(stratum).orderBy(F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256))
    return pool.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= quota)
