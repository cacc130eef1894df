"""JSON-lines event logs: bad lines become issues, their neighbours survive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1, blank ones count) and raw of each line, without one task that sees a whole file.

    A file's part in a partition has rising ids, so its lines' numbers follow from how many lines its earlier
    parts have: one small row a file and partition.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"), F.monotonically_increasing_id().alias("id"))
    part = F.shiftright("id", 33)
    parts = lines.groupBy("file", part.alias("part")).agg(F.count("*").alias("n"), F.min("id").alias("start"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("file", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start") + 1).alias("shift"))
    return lines.withColumn("part", part).join(offsets, ["file", "part"]).select("file", (F.col("id") + F.col("shift")).alias("line"), "raw")


def _text(c: Column) -> Column:
    """Not null and not blank, in any script's blanks."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def event_issue(raw: Column, value: Column) -> Column:
    """The first rule of the event contract that a line breaks, or null."""
    required = F.array(*[F.lit(k) for k in sorted(f.name for f in schemas.EVENT)])
    keys = F.array_sort(F.json_object_keys(raw))
    bad_text = F.coalesce(*[F.when(~_text(value[k]), F.lit(k)) for k in ("event_id", "run_id", "episode_id", "trace_id", "span_id")])
    parent, refs = value["parent_span_id"], value["artifact_refs"]
    moment = value["timestamp"]
    # A number that is written as a string or a flag is no number.
    number = lambda k: F.get_json_object(raw, f"$.{k}").rlike(r"^-?[0-9]+$") & ~raw.rlike(rf'"{k}"\s*:\s*["tf]')
    one_of = lambda k, values: F.coalesce(value[k].isin(*values), F.lit(False))
    return (
        F.when(keys.isNull() | value.isNull(), "MALFORMED_EVENT")
        .when(F.size(F.array_except(keys, required)) > 0, "UNKNOWN_FIELD").when(F.size(F.array_except(required, keys)) > 0, "MISSING_FIELD")
        .when(bad_text.isNotNull(), F.concat(F.lit("BLANK_"), F.upper(bad_text)))
        .when(parent.isNotNull() & ~_text(parent), "BLANK_PARENT_SPAN_ID").when(parent == value["span_id"], "SELF_PARENT")
        .when(~F.coalesce(number("sequence") & (value["sequence"] >= 0), F.lit(False)), "BAD_SEQUENCE")
        .when(~F.coalesce(number("attempt") & (value["attempt"] >= 1), F.lit(False)), "BAD_ATTEMPT")
        .when(~F.coalesce(moment.rlike(r"(Z|[+-]00:?00)$") & F.try_to_timestamp(moment).isNotNull(), F.lit(False)), "TIMESTAMP_NOT_UTC")
        .when(~one_of("event_type", schemas.EVENT_TYPES), "UNKNOWN_EVENT_TYPE").when(~one_of("component", schemas.COMPONENTS), "UNKNOWN_COMPONENT")
        .when(~one_of("status", schemas.STATUSES), "UNKNOWN_STATUS")
        .when(~F.coalesce(F.ltrim(value["attributes"]).startswith("{"), F.lit(False)), "BAD_ATTRIBUTES")
        .when(refs.isNull() | F.exists(refs, lambda r: ~_text(r)), "BAD_ARTIFACT_REFS").when(F.size(F.array_distinct(refs)) < F.size(refs), "REPEATED_ARTIFACT_REF")
        .when(~value["schema_version"].eqNullSafe(F.lit(schemas.SCHEMA_VERSION)), "SCHEMA_VERSION")
    )


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events, issues). An event also has its file, line and raw digest; an issue has these and a code. All fields
    of the contract are required and no others allowed; blank lines are skipped."""
    lines = numbered_lines(spark, path).filter(F.col("raw").rlike(r"(?U)\S"))
    parsed = lines.withColumn("event", F.from_json("raw", schemas.EVENT)).withColumn("raw_sha256", F.sha2("raw", 256))
    checked = parsed.withColumn("code", event_issue(F.col("raw"), F.col("event")))
    return (
        checked.filter("code is null").select("event.*", "file", "line", "raw_sha256"),
        checked.filter("code is not null").select("file", "line", "code", "raw_sha256"),
    )


def strict(events: DataFrame, issues: DataFrame) -> DataFrame:
    """The events, or an error that names the first bad line: for scans that take no bad line."""
    first = issues.orderBy("file", "line").first()
    if first is not None:
        raise ValueError(f"{first['file']}:{first['line']}: {first['code']}")
    return events
