"""Streaming ingest with global idempotency: the first content of an id is kept, equal repeats are dropped, different
ones quarantined. No watermark: late events are taken forever.

The store is partitioned by a hash of the id. A batch reads of it only the partitions that its own ids fall into,
and of these only the id and digest columns. A batch of very many ids falls into all of them and so reads those columns
whole: for small batches onto a large store, `state` keeps digests as state instead.
Which content of an id is first within a batch goes by `order`, then by digest: a micro-batch has no order of its own.

Whole rows are shuffled once a batch, without digests, together with what the store knows of their ids, into slices of its
partitions; a slice sorts its ids by that order. Ids that a batch has very often are counted by content and joined instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import shared_folder

#: Partitions of the store by id, and rows of one that a task sorts about (and at least, while there are so few).
PARTS, SLICE_ROWS, LEAST_ROWS = 64, 1 << 19, 1 << 13

#: Ids are counted by so many hashes; those of a hash with more rows in a batch are crowded.
HASHES, CROWD = 1 << 14, 1 << 20


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def _digest(columns: list[str]) -> Column:
    """Digests are bytes, half of what their text takes wherever rows are shuffled or kept."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256))


def _part(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def _sorted(named: DataFrame, known: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """What is new and what is in conflict (with _n, how often) among the rows of a batch; n is how many rows and known ids there are."""
    columns = named.columns
    slices = max(1, -(-n // (PARTS * SLICE_ROWS)))
    tasks = max(1, min(PARTS * slices, n // LEAST_ROWS))
    slice_ = F.pmod(_part(key) * slices + F.pmod(F.shiftright(F.xxhash64(key), 6), F.lit(slices)), F.lit(tasks)).cast("int")
    dealt = named.unionByName(known, allowMissingColumns=True).withColumn("_slice", slice_).repartitionById(tasks, F.col("_slice"))
    rows = dealt.withColumn("_digest", F.coalesce("_known", _digest(columns)))
    # What is known of an id comes first; equal contents are peers, and the first of them stands for all.
    ids = Window.partitionBy("_slice", key).orderBy(F.col("_known").isNull(), *order, "_digest")
    upto = ids.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select(
        *columns, "_known", "_digest", F.row_number().over(ids).alias("_row"), F.rank().over(ids).alias("_rank"),
        F.first("_digest").over(upto).alias("_kept"), F.count(F.lit(1)).over(ids.rangeBetween(Window.currentRow, Window.currentRow)).alias("_n"),
    )
    new = F.col("_row") == 1
    found = placed.filter(F.col("_known").isNull() & (new | ((F.col("_row") == F.col("_rank")) & (F.col("_digest") != F.col("_kept")))))
    return found.select(*columns, "_n", new.alias("_new"))


def _counted(named: DataFrame, known: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The same for ids with very many rows: equal contents are one row with their number before anything is joined."""
    rows = named.withColumn("_digest", _digest(named.columns))
    first = rows.groupBy(key).agg(F.min(F.struct(*order, "_digest"))["_digest"].alias("_first"))
    heads = first.join(known, key, "left").select(key, F.coalesce("_known", "_first").alias("_kept"), F.col("_known").isNotNull().alias("_old"))
    row, same = F.min_by(F.struct(*named.columns), F.struct(*order)), F.col("_digest") == F.col("_kept")
    per = rows.groupBy(key, "_digest").agg(row.alias("_at"), F.count("*").alias("_n")).join(heads, key)
    return per.filter(~same | ~F.col("_old")).select("_at.*", "_n", same.alias("_new"))


def ingest_batch(batch: DataFrame, store: str, key: str, order: list[str], number: int) -> None:
    """Splits one batch into new events, repeats and conflicts by id and content digest; writes the new ones, the conflicts
    and, with a code, events without an id below store, and one row of counts. A batch that is replayed overwrites
    its own files, so it adds nothing."""
    spark = batch.sparkSession
    named = batch.filter(F.col(key).isNotNull())
    hash_ = F.pmod(F.xxhash64(key), F.lit(HASHES)).cast("int")
    per_hash = {r["_hash"]: r["count"] for r in named.groupBy(hash_.alias("_hash")).count().collect()}  # HASHES at most
    total = sum(per_hash.values())
    parts = sorted({h % PARTS for h in per_hash})
    crowded = [h for h, n in per_hash.items() if n > max(CROWD, 8 * total // HASHES)]
    schema = T.StructType([batch.schema[key], T.StructField("_digest", T.BinaryType()), T.StructField("_batch", T.LongType()), T.StructField("_part", T.IntegerType())])
    known = _table(spark, f"{store}/events", schema).filter(F.col("_part").isin(*parts or [-1]) & (F.col("_batch") != number)).select(key, F.col("_digest").alias("_known"))
    rest = (lambda df: df.filter(~hash_.isin(*crowded))) if crowded else (lambda df: df)
    per = _sorted(rest(named), rest(known), key, order, total + known.count())
    if crowded:
        per = per.unionByName(_counted(named.filter(hash_.isin(*crowded)), known.filter(hash_.isin(*crowded)), key, order))
    path = shared_folder(spark, "batch")
    per.write.option("compression", "zstd").parquet(path)
    per = spark.read.schema(per.schema).parquet(path)
    kept = [*batch.columns, _digest(batch.columns).alias("_digest")]
    base = f"batch-{number:012d}"
    # Ids of a part are in one file, or in as many as it has slices, so a batch adds about as many files.
    fresh = per.filter("_new").select(*kept, _part(key).alias("_part"), F.lit(number).cast("long").alias("_batch"))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("_batch", "_part").parquet(f"{store}/events")
    bad = per.filter(~F.col("_new")).select(*kept, "_n", F.lit("CONFLICTING_EVENT_ID").alias("code"))
    blank = batch.filter(F.col(key).isNull()).select(*kept, F.lit(1).cast("long").alias("_n"), F.lit("BLANK_EVENT_ID").alias("code"))
    bad.unionByName(blank).write.mode("overwrite").option("compression", "zstd").parquet(f"{store}/quarantine/{base}")
    # A row of the batch is appended, in conflict, or else repeats what is kept.
    appended, conflicts = F.count(F.when(F.col("_new"), 1)), F.coalesce(F.sum(F.when(~F.col("_new"), F.col("_n"))), F.lit(0))
    counts = per.agg(appended.alias("appended"), (F.lit(total).cast("long") - appended - conflicts).alias("duplicates"), conflicts.alias("conflicts"))
    counts.write.mode("overwrite").parquet(f"{store}/counts/{base}")


def ingest(source: DataFrame, store: str, key: str, order: list[str]):
    """Starts ingest of a streaming source until it has taken what is there; returns the query."""
    return (
        source.writeStream.foreachBatch(lambda batch, number: ingest_batch(batch, store, key, order, number))
        .option("checkpointLocation", f"{store}/progress").trigger(availableNow=True).start()
    )


def read_events(spark: SparkSession, store: str) -> DataFrame:
    """All events of a store, without its own columns."""
    return spark.read.parquet(f"{store}/events").drop("_digest", "_batch", "_part")
