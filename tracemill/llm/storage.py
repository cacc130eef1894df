"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table of their numbers is broadcast to what it selects from; beyond, the join shuffles.
BROADCAST_IDS = 500_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset a local session (as in tests) gets a temporary
    one; elsewhere executors would not see it."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tracemill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tracemill-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Writes df once and returns the written table: what follows reads files that survive a lost executor, and
    no later action computes df again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most_rows: int) -> bool:
    """Whether df has at most that many rows; counts no further."""
    return df.limit(most_rows + 1).count() <= most_rows


def without(docs: DataFrame, rows: DataFrame, row: str) -> DataFrame:
    """The documents whose number is not among rows (settled)."""
    rows = rows.select(row)
    return docs.join(F.broadcast(rows) if small(rows, BROADCAST_IDS) else rows, row, "left_anti")
