"""A store of raw lines with compacted generations beside it: what is derived can always be rebuilt from what came in.

Raw lines are only appended, compressed, in folders by run and part (of its episodes). A manifest has, for each run and part, how many
lines it was made from and a checksum of them that does not depend on their order, so tasks sum it up; it names the
generation that holds the compacted events. A generation is written whole before its rows of the manifest are, and readers
go by the manifest, so what a lost job leaves behind is never read. Recovery compares checksums and rebuilds
only the parts that differ; a part with a line that can't be read is reported, and keeps the generation it has. A part is compacted
by as many tasks as its lines ask for, after one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequences import compacted
from .scratch import hinted, settle

PARTS = 16
PLACE = ["run", "part"]
#: Lines of a raw file at most, as a compressed one is read by one task; lines of a part for each of its slices, about, when it is compacted.
FILE_LINES, SLICE_LINES = 1_000_000, 500_000
MANIFEST = "run long, part int, generation long, lines long, sum decimal(38,0), xor long, events long"
OK, REBUILT, MALFORMED, MISSING = "OK", "REBUILT", "MALFORMED", "RAW_MISSING"


def part_of(episode: str) -> Column:
    return F.pmod(F.xxhash64(episode), F.lit(PARTS)).cast("int")


def append(events: DataFrame, path: str, part: Column) -> None:
    """Adds events (with run) as lines of JSON; what lies there is not touched."""
    columns = [c for c in events.columns if c != "run"]
    # Sorted before they are lines, which take twice the memory; the write then sorts no more.
    placed = events.select("run", part.alias("part"), F.struct(*columns).alias("event")).sortWithinPartitions(*PLACE)
    append_lines(placed.select(*PLACE, F.to_json("event", {"ignoreNullFields": "false"}).alias("value")), path)


def append_lines(lines: DataFrame, path: str) -> None:
    files = lines.select(*PLACE, "value").write.mode("append").partitionBy(*PLACE).option("maxRecordsPerFile", FILE_LINES)
    files.text(f"{path}/raw", compression="gzip")


def raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, run long, part int").text(f"{path}/raw").select(*PLACE, "value")


def _parsed(lines: DataFrame, schema: T.StructType, key: list[str]) -> DataFrame:
    """Lines with their event, null where a line is no event: no JSON, or without one of its keys."""
    strict = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    event = F.from_json("value", strict, {"columnNameOfCorruptRecord": "_bad"})
    rows = lines.withColumn("event", event)
    bad = F.col("event").isNull() | F.col("event._bad").isNotNull()
    for k in key:
        bad = bad | F.col(f"event.{k}").isNull()
    return rows.withColumn("bad", F.coalesce(bad, F.lit(True)))


def summary(lines: DataFrame, schema: T.StructType, key: list[str]) -> DataFrame:
    """Per run and part: lines, sum and xor of their hashes, and how many are bad."""
    h = F.xxhash64("value")
    return _parsed(lines, schema, key).groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias("sum"), F.bit_xor(h).alias("xor"), F.count(F.when(F.col("bad"), 1)).alias("bad")
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The row of the last generation of each run and part."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], MANIFEST)
    rest = [c for c in rows.columns if c not in (*PLACE, "generation")]
    last = rows.groupBy(*PLACE).agg(F.max(F.struct("generation", *rest)).alias("m"))
    return last.select(*PLACE, "m.*")


def recover(spark: SparkSession, path: str, schema: T.StructType, key: list[str], arrival: list[str]) -> DataFrame:
    """Brings compacted generations up to the raw lines; returns run, part, state, generation, lines and events. Of the
    lines of one key the last by arrival is kept. The first call compacts everything."""
    found = settle(summary(raw(spark, path), schema, key), "summary")
    known = settle(manifest(spark, path), "known")
    m = known.select(*PLACE, "generation", "events", F.col("lines").alias("_lines"), F.col("sum").alias("_sum"), F.col("xor").alias("_xor"))
    both = found.join(m, PLACE, "full")
    same = F.col("lines").eqNullSafe(F.col("_lines")) & F.col("sum").eqNullSafe(F.col("_sum")) & F.col("xor").eqNullSafe(F.col("_xor"))
    state = F.when(F.col("lines").isNull(), MISSING).when(F.col("bad") > 0, MALFORMED).when(same, OK).otherwise(REBUILT)
    judged = settle(both.withColumn("state", state), "judged")
    stale = judged.filter(F.col("state") == REBUILT).select(*PLACE, F.ceil(F.col("lines") / SLICE_LINES).alias("_slices"))
    number = (known.agg(F.max("generation")).first()[0] or 0) + 1
    if not stale.isEmpty():
        slice_ = F.pmod(F.xxhash64(*[F.col(f"event.{k}") for k in key]), "_slices").alias("_slice")
        events = _parsed(raw(spark, path).join(hinted(stale), PLACE), schema, key).select(*PLACE, slice_, "event.*").drop("_bad")
        last = compacted(events.repartition(*PLACE, "_slice"), [*PLACE, "_slice", *key], arrival).drop("_slice")
        last.write.mode("overwrite").partitionBy(*PLACE).parquet(f"{path}/compacted/generation={number}")
        counts = spark.read.schema("run long, part int").parquet(f"{path}/compacted/generation={number}").groupBy(*PLACE).agg(F.count(F.lit(1)).alias("events"))
        rows = stale.join(found, PLACE).join(counts, PLACE).select("run", "part", F.lit(number).cast("long").alias("generation"), "lines", "sum", "xor", "events")
        settle(rows, "rows").write.mode("append").parquet(f"{path}/manifest")
    now = manifest(spark, path).select(*PLACE, "generation", "events")
    return judged.select(*PLACE, "state", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("bad", F.lit(0)).alias("bad")).join(now, PLACE, "left")


def read_compacted(spark: SparkSession, path: str, schema: T.StructType, run: int | None = None) -> DataFrame:
    """The compacted events of a run, or of all: of each part those of the generation that the manifest names."""
    whole = T.StructType([*schema.fields, T.StructField("generation", T.LongType()), T.StructField("run", T.LongType()), T.StructField("part", T.IntegerType())])
    rows, now = spark.read.schema(whole).option("basePath", f"{path}/compacted").parquet(f"{path}/compacted"), manifest(spark, path).select(*PLACE, "generation")
    if run is not None:
        rows, now = rows.filter(F.col("run") == run), now.filter(F.col("run") == run)
    return rows.join(hinted(now), [*PLACE, "generation"], "left_semi").drop("generation")


def read_all(spark: SparkSession, path: str, schema: T.StructType, key: list[str]) -> DataFrame:
    """All raw events; an error that names the runs and parts, if a line of theirs is none."""
    bad = summary(raw(spark, path), schema, key).filter("bad > 0").select(*PLACE).orderBy(*PLACE).limit(20).collect()
    if bad:
        raise ValueError(f"malformed events in {', '.join(f'run={r.run}/part={r.part}' for r in bad)}")
    return _parsed(raw(spark, path), schema, key).select(*PLACE, "event.*").drop("_bad")
