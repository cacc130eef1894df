"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.

Defined cases, for every stage: decisions are about rows, told apart by a number of their own, so a null or
repeated doc_id neither loses nor multiplies rows. A null text is empty: the classifier scores it like others,
it links with nothing, loses nothing, is clean, and has no words, so the mix does not take it. Rows that share a
doc_id are near duplicates if their texts are equal; one of them, of the smallest number, stays. An empty table
gives no rows. Other columns are handed on whatever their names; where one has the name of a column that the
mix adds, the mix's is called mix_ and that name.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import decontamination, mixing, neardup, quality, substrings
from tracemill.llm.storage import BROADCAST_IDS, settle, small, without


#: The number of a row inside a stage, and what the mix adds.
ROW = "_pipeline_row"
ADDED = ["size", "source_size", "target", "copies", "taken"]


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a number for each row, the same whenever they are read: of a written table (as stages get it) by file and
    place in it, which copies nothing; anything else is written first."""
    spark = docs.sparkSession
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        return settle(docs.withColumn(ROW, F.monotonically_increasing_id()))
    # As many rows as the table has files.
    files = sorted(r["file_path"] for r in docs.select("_metadata.file_path").distinct().collect())
    names = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "_file string, _number long")
    return placed.join(F.broadcast(names), "_file").withColumn(ROW, F.shiftleft("_number", 40).bitwiseOR(F.col("_place"))).select(*docs.columns, ROW)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labelled ones among docs, accepts."""
    rows = numbered(docs)
    found = quality.classify(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), ROW)
    return without(rows, settle(found.filter("predicted = 0").select(ROW)), ROW).select(*docs.columns)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (0.8 of five-word shingles) the document of smallest doc_id."""
    rows = numbered(docs)
    found = settle(neardup.near_duplicates(rows, 80, ROW).select(ROW, "doc_id", "kept"))
    # Rows that share a kept doc_id are all kept; of those with the same text one stays.
    again = settle(found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    again = F.broadcast(again) if small(again, BROADCAST_IDS) else again
    same = settle(rows.join(again, "doc_id", "left_semi").select(ROW, "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")))
    first = same.groupBy("doc_id", "digest").agg(F.min(ROW).alias(ROW))
    gone = found.filter("not kept").select(ROW).union(same.select(ROW).join(first.select(ROW), ROW, "left_anti"))
    return without(rows, settle(gone.distinct()), ROW).select(*docs.columns)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller doc_id has; n_chars follows the text."""
    found = substrings.clean_texts(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    rows = numbered(docs)
    found = decontamination.decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), row=ROW)
    return without(rows, settle(found.filter("contaminated").select(ROW)), ROW).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often, and their sources' sizes and targets."""
    rows = numbered(docs)
    found = mixing.mix(rows, row=ROW).filter("copies > 0")
    found = found.select(ROW, *[F.col(c).alias(f"mix_{c}" if c in docs.columns else c) for c in ADDED])
    return rows.join(found, ROW).drop(ROW)


STAGES = [
    ("quality", good),
    ("near_duplicates", different),
    ("repeated_passages", unrepeated),
    ("decontamination", unseen),
    ("mixing", mixed),
]

#: SQL expresses neither the classifier nor the random mix; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
