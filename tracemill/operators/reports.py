"""Aggregate reports over episodes, decisions and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(table: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Counts of every value of a fixed vocabulary, those that do not occur as 0."""
    dim = F.array(*[F.lit(v) for v in values])
    spark = table.sparkSession
    every = spark.range(1).select(F.explode(dim).alias(column))
    return every.join(table.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def melted(row: DataFrame) -> DataFrame:
    """A row of counts as rows of metric and value."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in row.columns]
    return row.select(F.explode(F.array(*pairs)).alias("m")).select("m.metric", "m.value")


def quality_report(artifacts: DataFrame, decisions: DataFrame) -> DataFrame:
    """metric and value: artifacts, repeats of their content, verdicts, reasons, and orphans on either side."""
    digest = F.xxhash64("text")
    content = artifacts.groupBy(digest.alias("h"), F.sha2("text", 256).alias("sha")).count()
    a = content.agg(F.sum("count").alias("artifacts"), (F.sum("count") - F.count("*")).alias("duplicates"))
    own = artifacts.select("doc_id", F.lit(1).alias("a"))
    both = own.join(decisions.withColumn("d", F.lit(1)), "doc_id", "full")
    b = both.agg(
        F.count(F.when(F.col("verdict") == "ELIGIBLE", 1)).alias("eligible"),
        F.count(F.when(F.col("verdict") == "REJECTED", 1)).alias("rejected"),
        F.count(F.when(F.col("reason") == "low quality", 1)).alias("reason_low_quality"),
        F.count(F.when(F.col("reason") == "toxic", 1)).alias("reason_toxic"),
        F.count(F.when(F.col("a").isNull(), 1)).alias("orphan_decisions"),
        F.count(F.when(F.col("d").isNull(), 1)).alias("undecided"),
    )
    return melted(a.crossJoin(b))  # one row each


def rates(attempts: DataFrame, by: str, valid: Column, solved: Column) -> DataFrame:
    """Attempts, valid ones, solved among these, and their rate; null without valid ones."""
    per = attempts.groupBy(by).agg(
        F.count("*").alias("attempts"), F.count(F.when(valid, 1)).alias("valid"), F.count(F.when(valid & solved, 1)).alias("resolved")
    )
    return per.withColumn("rate", F.round(F.try_divide(F.col("resolved"), F.col("valid")), 6))


def changes(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Keys added, deleted and modified between two snapshots, counted."""
    joined = before.select(key, F.col(value).alias("x"), F.lit(1).alias("b")).join(after.select(key, F.col(value).alias("y"), F.lit(1).alias("a")), key, "full")
    change = F.when(F.col("b").isNull(), "ADDED").when(F.col("a").isNull(), "DELETED").when(~F.col("x").eqNullSafe(F.col("y")), "MODIFIED").otherwise("SAME")
    return joined.groupBy(change.alias("change")).agg(F.count("*").alias("n"))


def regression_gate(candidate: Column, baseline: Column, valid: Column, least: int = 3) -> Column:
    return F.when(valid < least, "INCONCLUSIVE").when(candidate > baseline, "ACCEPT").otherwise("REJECT")
