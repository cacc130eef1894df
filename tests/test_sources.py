import json

import pytest
from tracemill import schemas
from tracemill.functions import canonical
from tracemill.sources.jsonl import read_events, strict
from tracemill.streaming.ingest import ingest, ingest_batch
from pyspark.sql import functions as F


def event(**changes):
    base = {
        "schema_version": "trace-event/v1", "event_id": "e", "run_id": "r", "episode_id": "p", "trace_id": "t", "span_id": "s", "parent_span_id": None, "sequence": 0,
        "timestamp": "2026-08-14T00:00:00Z", "event_type": "TOOL_CALL", "component": "HARNESS", "status": "STARTED", "attempt": 1, "attributes": {}, "artifact_refs": [],
    }
    return base | changes


CASES = [
    ({"extra": 1}, "UNKNOWN_FIELD"), ({"event_type": "NOPE"}, "UNKNOWN_EVENT_TYPE"), ({"timestamp": "2026-08-14T00:00:00+02:00"}, "TIMESTAMP_NOT_UTC"), ({"timestamp": "yesterdayZ"}, "TIMESTAMP_NOT_UTC"),
    ({"run_id": " \u2003"}, "BLANK_RUN_ID"), ({"parent_span_id": "s"}, "SELF_PARENT"), ({"parent_span_id": ""}, "BLANK_PARENT_SPAN_ID"), ({"sequence": -1}, "BAD_SEQUENCE"), ({"sequence": True}, "BAD_SEQUENCE"),
    ({"sequence": "3"}, "BAD_SEQUENCE"), ({"attempt": 0}, "BAD_ATTEMPT"), ({"component": "X"}, "UNKNOWN_COMPONENT"), ({"status": "DONE"}, "UNKNOWN_STATUS"), ({"attributes": []}, "BAD_ATTRIBUTES"),
    ({"artifact_refs": ["a", "a"]}, "REPEATED_ARTIFACT_REF"), ({"artifact_refs": [" "]}, "BAD_ARTIFACT_REFS"), ({"schema_version": "v0"}, "SCHEMA_VERSION"),
]


def test_bad_lines_become_issues_and_neighbours_survive(spark, tmp_path):
    missing = event(event_id="m")
    del missing["attempt"]
    lines = [json.dumps(event(event_id="a")), "{broken", "", json.dumps(missing), *[json.dumps(event(event_id="x") | change) for change, _ in CASES], json.dumps(event(event_id="z", timestamp="2026-08-14T00:00:00.5+00:00"))]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    events, issues = read_events(spark, str(tmp_path))
    assert sorted((r.event_id, r.line) for r in events.collect()) == [("a", 1), ("z", len(lines))]
    expected = [(2, "MALFORMED_EVENT"), (4, "MISSING_FIELD"), *[(5 + i, code) for i, (_, code) in enumerate(CASES)]]
    assert sorted((r.line, r.code) for r in issues.collect()) == expected
    with pytest.raises(ValueError, match=":2: MALFORMED_EVENT"):
        strict(events, issues)


def test_all_kinds_of_events_are_taken(spark, tmp_path):
    lines = [json.dumps(event(event_id=f"{t}{c}{s}", event_type=t, component=c, status=s)) for t in schemas.EVENT_TYPES for c, s in zip(schemas.COMPONENTS, schemas.STATUSES)]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    events, issues = read_events(spark, str(tmp_path))
    assert events.count() == len(lines) and issues.count() == 0


def test_canonical_json_and_redaction(spark):
    rows = [('{"b": 1.50, "a": {"Api-Key": "x", "n": [null, true]}}',), ("nonsense",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(canonical.canonical_json("t").alias("c"), canonical.redacted_json("t").alias("r"))
    got = [tuple(r) for r in df.collect()]
    assert got[0] == ('{"a":{"Api-Key":"x","n":[null,true]},"b":1.5}', '{"a":{"Api-Key":"[REDACTED]","n":[null,true]},"b":1.5}')
    assert got[1:] == [(None, None), (None, None)]


def test_token_count_and_cap(spark):
    df = spark.createDataFrame([(" a  b\nc ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(canonical.token_count(F.col("t"))).collect()] == [3, 0, 0]
    long = spark.createDataFrame([("x" * 3000,)], "t string").select(canonical.cap_text(F.col("t"), 100)).first()[0]
    assert long == "x" * 50 + "\n...[+2900 chars truncated]...\n" + "x" * 50


def test_stream_keeps_first_drops_repeats_and_quarantines_conflicts(spark, tmp_path):
    schema = "event_id long, ts long, v string"
    inbox, store = str(tmp_path / "in"), str(tmp_path / "store")
    spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (2, 1, "b"), (2, 2, "other"), (None, 1, "n")], schema).write.mode("append").parquet(inbox)
    ingest(spark.readStream.schema(schema).parquet(inbox), store, "event_id", ["ts"]).awaitTermination()
    spark.createDataFrame([(1, 1, "a"), (2, 1, "late"), (3, 0, "c")], schema).write.mode("append").parquet(inbox)
    ingest(spark.readStream.schema(schema).parquet(inbox), store, "event_id", ["ts"]).awaitTermination()
    kept = sorted((r.event_id, r.v) for r in spark.read.parquet(f"{store}/events").collect())
    assert kept == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted((r.v, r.code) for r in spark.read.parquet(f"{store}/quarantine/*").collect()) == [("late", "CONFLICTING_EVENT_ID"), ("n", "BLANK_EVENT_ID"), ("other", "CONFLICTING_EVENT_ID")]
    counts = spark.read.parquet(f"{store}/counts/*").agg(F.sum("appended"), F.sum("duplicates"), F.sum("conflicts")).first()
    assert tuple(counts) == (3, 2, 2)
    # The second batch again adds nothing.
    again = spark.createDataFrame([(1, 1, "a"), (2, 1, "late"), (3, 0, "c")], schema)
    ingest_batch(again, store, "event_id", ["ts"], 1)
    assert sorted((r.event_id, r.v) for r in spark.read.parquet(f"{store}/events").collect()) == kept


def test_digests_of_a_store_are_bytes(spark, tmp_path):
    store = str(tmp_path / "store")
    for number, value in enumerate(("a", "b")):
        ingest_batch(spark.createDataFrame([(1, 1, value), (1, 1, value)], "event_id int, ts int, v string"), store, "event_id", ["ts"], number)
    kept = spark.read.parquet(f"{store}/events").collect()
    assert [(r.v, len(bytes(r["_digest"]))) for r in kept] == [("a", 32)]
    assert tuple(spark.read.parquet(f"{store}/counts/*").agg(F.sum("appended"), F.sum("duplicates"), F.sum("conflicts")).first()) == (1, 1, 2)
