"""Snapshots of workspaces: files by path, digests of all, contents of those that fit a budget of bytes.

The budget is spent in order of paths: a file that doesn't fit is left out, and later ones may still fit. No task goes
through a workspace: while the rest of the budget is at least half of what it was, every file of at most that half
fits and at most one larger one, so running sums tell where the rest falls below half. Each such step halves the
rest, so a budget of 2 ** 26 bytes takes 26 of them at most, for all workspaces together.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prefix import running
from ..sources.scratch import settle

MOST_FILES, MOST_BYTES = 10_000, 64 << 20


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """workspace (root), path (below it), size, sha256 and content of the files below a folder, without what lies in .git.
    Spark's sources don't see files without bytes, nor names that begin with . or _, so nor does this."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    below = F.substring_index("path", re.sub(r"^\w+:(//[^/]*)?", "", root).rstrip("/") + "/", -1)
    found = files.select(F.lit(root).alias("workspace"), below.alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")
    return found.filter(~F.array_contains(F.split("path", "/"), ".git"))


def _placed(files: DataFrame) -> DataFrame:
    """Files with a number that rises with workspace and path, from ranges sorted side by side."""
    rows = files.select("workspace", "path", "size").repartitionByRange("workspace", "path").sortWithinPartitions("workspace", "path")
    return settle(rows.withColumn("place", F.monotonically_increasing_id()), "files")


def retained(files: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """workspace, place of the files (with workspace, place and size) that the budget takes, in order of place."""
    left = settle(files.groupBy("workspace").agg(F.min("place").alias("from"), F.lit(most_bytes).cast("long").alias("rest")), "budget")
    taken = None
    while not left.isEmpty():
        open_ = settle(files.join(left, "workspace").filter((F.col("place") >= F.col("from")) & (F.col("size") <= F.col("rest"))), "open")
        # What of the rest is kept back: a file of at most the other half fits as long as that much is left.
        half = F.col("rest") - F.floor(F.col("rest") / 2)
        small = F.col("size") <= F.floor(F.col("rest") / 2)
        rows = settle(running(open_, "workspace", "place", {"spent": F.when(small, F.col("size"))}).withColumn("small", small), "open")
        falls = F.when(F.col("small"), F.col("rest") - F.col("spent") < half).otherwise(F.col("size") <= F.col("rest") - F.col("spent"))
        ends = rows.filter(falls).groupBy("workspace").agg(F.min(F.struct("place", (F.col("rest") - F.col("spent") - F.when(F.col("small"), 0).otherwise(F.col("size"))).alias("rest"))).alias("end"))
        ends = settle(ends, "end")
        step = rows.join(ends, "workspace", "left").filter(F.col("end").isNull() | (F.col("small") & (F.col("place") <= F.col("end.place"))) | (F.col("place") == F.col("end.place")))
        step = settle(step.filter(F.col("small") | F.col("end").isNotNull()).select("workspace", "place"), "taken")
        taken = step if taken is None else taken.unionByName(step)
        left = ends.select("workspace", (F.col("end.place") + 1).alias("from"), F.col("end.rest").alias("rest"))
    return files.select("workspace", "place").filter("false") if taken is None else taken


def snapshot(files: DataFrame, most_files: int = MOST_FILES, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, issues, workspaces) of files with workspace, path, size, sha256 and content. kept are the first most_files by path, with
    content only where the budget takes it; an issue says which file it doesn't, or that there are more files; a workspace is complete without."""
    placed = settle(running(_placed(files), "workspace", "place", {"number": F.lit(1)}), "files")
    first = placed.filter(F.col("number") <= most_files)
    took = retained(first.select("workspace", "place", "size"), most_bytes).withColumn("retained", F.lit(True))
    first = settle(first.join(took, ["workspace", "place"], "left").select("workspace", "path", F.coalesce("retained", F.lit(False)).alias("retained")), "first")
    kept = files.join(first, ["workspace", "path"]).withColumn("content", F.when(F.col("retained"), F.col("content")))
    many = placed.groupBy("workspace").agg(F.count(F.lit(1)).alias("files")).filter(F.col("files") > most_files)
    issues = first.filter("not retained").select("workspace", "path", F.lit("BUDGET_EXCEEDED").alias("code"))
    issues = issues.unionByName(many.select("workspace", F.lit(None).cast("string").alias("path"), F.lit("TOO_MANY_FILES").alias("code")))
    workspaces = placed.select("workspace").distinct().join(issues.select("workspace").distinct().withColumn("bad", F.lit(True)), "workspace", "left")
    return kept, issues, workspaces.select("workspace", F.col("bad").isNull().alias("complete"))
