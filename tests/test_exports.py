"""Scans of odd files, checked references, and tool calls in texts against a plain reading."""

import hashlib

from pyspark.sql import functions as F
from tracemill.functions import calls
from tracemill.operators import exports, release, training


def test_samples_and_logs_leave_bad_rows_out(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("name, utilization\ngpu0, 35 %\ngpu1,x\n\ngpu0,80%\n")
    assert sorted((r.name, r.share) for r in exports.read_samples(spark, str(tmp_path / "csv")).collect()) == [("gpu0", 35.0), ("gpu0", 80.0)]
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "x.log").write_text("start\nwall time: 12.5 s\nreward=-0.5\nDONE ok\n")
    (tmp_path / "logs" / "y.log").write_text("nothing")
    assert sorted((tuple(r) for r in exports.read_logs(spark, str(tmp_path / "logs")).collect()), key=str) == [("x.log", 12.5, -0.5, True), ("y.log", None, None, False)]


def test_references_are_held_against_contents(spark):
    digest = hashlib.sha256(b"abc").hexdigest()
    refs = spark.createDataFrame([("a", "f", digest, 3), ("b", "f", digest, 4), ("c", "f", "0" * 64, 3), ("d", "g", digest, 3)], "artifact string, file string, sha256 string, size long")
    files = spark.createDataFrame([("f", bytearray(b"abc"))], "file string, content binary")
    got = {r.artifact: r.reason for r in exports.verified_objects(refs, files).collect()}
    assert got == {"a": "", "b": "SIZE_DIFFERS", "c": "CONTENT_DIFFERS", "d": "FILE_MISSING"}


def test_tool_calls_in_texts(spark):
    texts = [
        ('<tool_call>{"name":"ls","arguments":{"a":1}}</tool_call>', [("ls", '{"a":1}')]), ('x {"name":"ls","arguments":{"a":"}"}} y', [("ls", '{"a":"}"}')]), ('{"name":"ls","arguments":{}}', []), ('{"name":"ls"}', []),
        ('{"name":"no","arguments":{"a":1}}', []), ('{"name":"ls","arguments":[1]}', []), ("{" * 50 + '{"name":"ls","arguments":{"é":2}}', [("ls", '{"é":2}')]), ('<tool_call>{"name":"ls","arguments":{"a":1}}', [("ls", '{"a":1}')]), (None, []),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string")
    got = {r.i: [tuple(x) for x in r.c] for r in rows.select("i", calls.tool_calls(F.col("t"), ("ls",)).alias("c")).collect()}
    assert got == {i: c for i, (_, c) in enumerate(texts)}


def test_a_release_that_costs_too_much_is_rejected(spark):
    schema = "slice int, " + ", ".join(f"{s}_{m} double" for m in ("success", "tokens", "latency", "infra", "loops") for s in "bc")
    costly = [(0, 0.0, 1.0, 1647.0, 2365.0, 6354.0, 9604.0, 0.0, 0.0, 3.0, 0.0)] * 3
    good = [(1, 0.0, 1.0, 100.0, 110.0, 100.0, 100.0, 0.0, 0.0, 3.0, 0.0)] * 3
    few = [(2, *good[0][1:])] * 2 + [(3, *good[0][1:])] * 3 + [(3, 1.0, None, 1.0, None, 1.0, None, 0.0, None, 0.0, None)]
    got = {r.slice: r for r in release.gate(spark.createDataFrame(costly + good + few, schema), "slice").collect()}
    assert {k: r.verdict for k, r in got.items()} == {0: "REJECT", 1: "ACCEPT", 2: "INSUFFICIENT_EVIDENCE", 3: "INSUFFICIENT_EVIDENCE"}
    assert (got[0].success_ok, got[0].slice_ok, got[0].tokens_ok, got[0].latency_ok, got[0].infra_ok) == (True, True, False, False, True)


def test_chat_pairing_by_turn(spark):
    said = [("a", 1, "assistant", "x"), ("a", 2, "tool", "x"), ("a", 3, "assistant", "y"), ("b", 1, "assistant", "x"), ("b", 2, "assistant", None), ("b", 3, "tool", "x"), ("c", 1, "assistant", "x"), ("c", 2, "tool", "x")]
    got = {r.trajectory: r for r in training.pairing(spark.createDataFrame(said, "trajectory string, position int, role string, call string")).collect()}
    assert (got["a"].matched, got["a"].open_calls, got["a"].paired) == (1, 1, False)
    assert (got["b"].matched, got["b"].stray_results, got["b"].open_calls) == (0, 1, 1) and got["c"].paired
