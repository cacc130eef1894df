"""Tables written once, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, a local session may use one of its own."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="tracemill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes df once and returns the written table: a lost executor costs its tasks, and no later branch computes df again.

    Joins with it shuffle unless a side is hinted to be broadcast (`hinted` counts first): the size of compressed files says
    little about rows, and ten MB of them are millions that Spark would hold in the driver.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")


def shuffled(df: DataFrame) -> DataFrame:
    """df with the hint that written tables carry: a hint ends where its table is joined, so what is joined again needs it anew."""
    return df.hint("merge")


#: Rows up to which a table of groups is broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 200_000


def hinted(df: DataFrame) -> DataFrame:
    """df with a hint to broadcast it, if it has few rows; counts no further."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
