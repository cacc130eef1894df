"""Tables by name, and their projections onto the evidence model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user: an episode's actions, with their signature."""
    return read(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value", "props")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as an event log with repeats, conflicts and gaps: episode is the order, seq the line."""
    return read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "episode").withColumnRenamed("l_linenumber", "seq")


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as verdicts with their reason."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return read(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(good & ~toxic, "ELIGIBLE").otherwise("REJECTED").alias("verdict"),
        F.when(~good, "low quality").when(toxic, "toxic").alias("reason"),
    )
