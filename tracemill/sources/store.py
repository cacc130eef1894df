"""A log kept in folders by run: written once, read by run or whole; `generations` compacts and recovers one of raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a run's folder, by hash of the episode, so a hot run is no single file.
PARTS = 16


def write(log: DataFrame, path: str, run: str, episode: str) -> None:
    """Appends; rows of a run and part of its episodes go to the same folder, from as many tasks as the log has parts."""
    part = F.pmod(F.xxhash64(episode), F.lit(PARTS)).cast("int")
    log.withColumn("_part", part).write.mode("append").partitionBy(run, "_part").parquet(path)


def read_run(spark: SparkSession, path: str, run, episode=None, key: str = "episode", name: str = "run") -> DataFrame:
    """One run's rows, or one episode's of it; other folders are pruned."""
    found = spark.read.parquet(path).filter(F.col(name) == run)
    if episode is not None:
        found = found.filter((F.col("_part") == F.pmod(F.xxhash64(F.lit(episode)), F.lit(PARTS)).cast("int")) & (F.col(key) == episode))
    return found.drop("_part")


def read_all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_part")
