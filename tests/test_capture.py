"""Harness captures by hand: order, pairs, clocks, secrets, torn lines; prefix sums and walks of any depth."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tracemill.functions import calls, canonical, prefix
from tracemill.functions.walk import keys_at, nests, walk
from tracemill.operators import capture

OUTCOME = "session string, task_status string, execution_validity string, verifier_status string, score double, termination_reason string"
BASE = 1_785_542_400_000


def message(role, **values):
    return {"type": "message_end", "message": {"role": role, **values}}


def call(call_id, name, arguments):
    return {"type": "toolCall", "id": call_id, "name": name, "arguments": arguments}


SESSION = [
    {"type": "session", "id": "abc", "timestamp": "2026-08-01T00:00:00.000Z"},
    message("user", content=[{"type": "text", "text": "hi"}], timestamp=BASE),
    message("assistant", content=[{"type": "text", "text": "x"}, call("c1", "read", {"path": "a", "token": "t"}), call("c1", "grep", "q"), call("", "", None)], timestamp=BASE + 500, stopReason="toolUse", usage={"input": 5, "output": 2, "cost": {"total": 0.5}}),
    "{torn", "[1]", "  ",
    {"type": "tool_execution_end", "toolCallId": "c1", "result": {"content": [{"type": "text", "text": "ENOENT: no such file or directory, access '/w/a'"}]}, "isError": True},
    {"type": "tool_execution_end", "toolCallId": "c1", "result": "[not json"},
    {"type": "turn_end", "all": [{"deep": {"role": "toolResult", "toolCallId": "c1", "timestamp": BASE + 900}}]},
    {"type": "agent_end", "willRetry": False}, {"type": "agent_end", "willRetry": "no"}, message("system", content="s"), {"type": "message_end", "message": 3},
    message("assistant", content="done", stopReason="stop", timestamp=5),
]


@pytest.fixture(scope="module")
def converted(spark):
    lines = [("s1", i + 1, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(SESSION)]
    lines += [("s2", 1, json.dumps({"type": "session", "timestamp": "yesterday"})), ("s2", 2, json.dumps(message("assistant", stopReason="error", errorMessage="boom", content=[])))]
    lines += [("s3", 1, json.dumps({"type": "tool_execution_end", "toolCallId": None})), ("s3", 2, "{" * 50), ("s3", 3, '{"type": "x", "a": "\\ud800"}'), ("s3", 4, '{"a":' * 200_000)]
    df = spark.createDataFrame(lines, "session string, line long, raw string")
    found = capture.convert(df, spark.createDataFrame([("s1", "SUCCESS", "VALID", "PASSED", 1.0, "DONE")], OUTCOME), {"provider": "p", "model": "m", "tools": "read"}, normalize_tool_errors=True)
    return df, [sorted(x.collect(), key=lambda r: str((r.session, r.asDict().get("sequence", 0)))) for x in found]


def test_events_of_a_session(converted):
    _, (events, issues, _) = converted
    own = sorted((e for e in events if e.session == "s1"), key=lambda e: e.sequence)
    assert [e.sequence for e in own] == list(range(13)) and len({e.event_id for e in own}) == 13
    assert [(e.event_type, e.status, e.attempt) for e in own[:9]] == [
        ("MODEL_REQUEST", "STARTED", 1), ("MODEL_RESPONSE", "SUCCEEDED", 1), ("TOOL_CALL", "STARTED", 1), ("TOOL_CALL", "STARTED", 1), ("TOOL_CALL", "STARTED", 1),
        ("TOOL_RESULT", "ERROR", 1), ("TOOL_RESULT", "SUCCEEDED", 1), ("TERMINATION_DECIDED", "SUCCEEDED", 1), ("MODEL_REQUEST", "STARTED", 2),
    ]
    # The id was called twice: its result takes the last call away, and the next result has none.
    assert [(e.parent_span_id, e.tool_name) for e in own[5:7]] == [("span-pi-model-1", "grep"), (None, "unknown")]
    assert (own[5].error_code, own[5].error_path) == ("FILE_NOT_FOUND", "/w/a") and own[6].error_code is None
    assert json.loads(own[6].attributes)["result"] == "[not json" and json.loads(own[9].attributes)["content"] == "done"
    assert [json.loads(e.attributes)["arguments"] for e in own[2:5]] == [{"path": "a", "token": "[REDACTED]"}, {"raw": "q"}, {"raw": None}]
    assert own[4].tool_call_id == "tool-2-3" and own[4].tool_name == "unknown"
    assert [json.loads(own[i].attributes)["n_messages"] for i in (0, 8)] == [1, 2]
    assert json.loads(own[1].attributes)["usage"]["input_tokens"] == 5
    assert json.loads(own[12].attributes)["evidence_event_ids"] == [own[11].event_id]
    assert {(i.session, i.line, i.code) for i in issues} == {
        ("s1", 4, "MALFORMED_JSON"), ("s1", 5, "NOT_AN_OBJECT"), ("s1", 8, "RESULT_WITHOUT_CALL"), ("s3", 1, "RESULT_WITHOUT_CALL"), ("s3", 2, "MALFORMED_JSON"), ("s3", 4, "MALFORMED_JSON"),
    }


def test_a_clock_never_runs_back(converted):
    _, (events, _, _) = converted
    own = [e.time for e in sorted((e for e in events if e.session == "s1"), key=lambda e: e.sequence)]
    after = [BASE + 499, BASE + 500, BASE + 501, BASE + 502, BASE + 503, BASE + 900, *range(BASE + 901, BASE + 908)]
    assert own == [1000 * t for t in after]
    assert [e.time for e in events if e.session == "s2"] == [0, 1000, 2000]


def test_a_backend_that_fails_ends_the_session(converted):
    _, (events, _, sessions) = converted
    own = sorted((e for e in events if e.session == "s2"), key=lambda e: e.sequence)
    assert [e.event_type for e in own] == ["MODEL_REQUEST", "MODEL_RESPONSE", "EPISODE_FINISHED"] and own[2].status == "ERROR"
    told = json.loads(own[2].attributes)
    assert (told["execution_validity"], told["verifier_status"], told["evidence_event_ids"]) == ("INFRA_INVALID", "NOT_RUN", [own[1].event_id])
    per = {s.session: s for s in sessions}
    assert per["s2"].backend_failed and per["s2"].session_id == "pi-session-unknown" and not per["s1"].backend_failed
    assert per["s1"].capabilities == ["MODEL_IO", "MODEL_TOKEN_USAGE", "TERMINATION_DECISIONS", "TOOL_IO"] and per["s3"].capabilities == ["MODEL_IO", "TOOL_IO"]


def test_histories_and_written_records(converted, spark, tmp_path):
    df, _ = converted
    got = {(r.session, r.assistant_index): r.messages for r in capture.request_messages(df).collect()}
    assert [m.role for m in got["s1", 2]] == ["user", "assistant"] and got["s1", 2][1].stop_reason == "toolUse" and got["s2", 1] == []
    records, _ = capture.read_records(df)
    capture.write_records(records, str(tmp_path / "out"))
    again = spark.read.text(str(tmp_path / "out")).filter("session = 's1'")
    assert [json.loads(r.value).get("type") for r in again.collect()] == [r["type"] for r in SESSION if isinstance(r, dict)]
    assert "[REDACTED]" in "".join(r.value for r in again.collect())


def test_captures_of_nothing(spark):
    empty = spark.createDataFrame([], "session string, line long, raw string")
    for found in capture.convert(empty, spark.createDataFrame([], OUTCOME)):
        assert found.collect() == []


def test_running_sums_and_maxima_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix, "CHUNK", 8)
    rnd = random.Random(3)
    rows = [(k, 3 * i - 5, rnd.choice((None, rnd.randint(-9, 9)))) for k in ("a", "b", None) for i in range(60)]
    got = prefix.running(spark.createDataFrame(rows, "k string, at long, x long").repartition(3), "k", "at", {"s": F.col("x")}, {"m": F.col("x")}).collect()
    assert len(got) == len(rows)
    for r in got:
        seen = [x for k, at, x in rows if k == r.k and at <= r.at and x is not None]
        assert (r.s, r.m) == (sum(seen), max(seen, default=None))


def test_walks_of_any_depth(spark):
    deep = '{"a":' * 40 + '{"API-Key":1}' + "}" * 40
    rows = [(1, '{"b":[1,{"token":"x","c":{"Password":2}}],"a":"t"}'), (2, "[]"), (3, "nope"), (4, deep), (5, '"x"'), (6, None), (7, '{"a":' * 10_000 + "1" + "}" * 10_000), (8, json.dumps({"it's": {"secret": 1}}))]
    df = spark.createDataFrame(rows, "id long, t string").select("id", F.try_parse_json("t").alias("v"))
    got = {(r.id, r.path) for r in keys_at(df, "v", canonical.SECRET_KEYS).collect()}
    assert got == {(1, "$.b[1].token"), (1, "$.b[1].c.Password"), (4, "$" + ".a" * 40 + "['API-Key']"), (8, "$['it\\'s'].secret")}
    every = walk(df.filter("id = 1"), "v").orderBy("place").collect()
    assert [r.path for r in every] == ["$", "$.a", "$.b", "$.b[0]", "$.b[1]", "$.b[1].c", "$.b[1].c.Password", "$.b[1].token"]


def test_odd_json_ends_no_query(spark):
    rows = [("[" * 200_000,), ('{"a":"\\ud800"}',), ('<tool_call>{"name":"f","arguments":' + '{"a":' * 200_000 + "</tool_call>",), ('{"name":"f","arguments":{"x":"\\udc00"}}',), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(canonical.canonical_json("t").alias("c"), canonical.redacted_json("t").alias("r"), calls.tool_calls(F.col("t"), ("f",)).alias("f")).collect()
    assert [r.c for r in got] == [None, '{"a":"\\ud800"}', None, '{"arguments":{"x":"\\udc00"},"name":"f"}', None]
    assert [len(r.f) for r in got] == [0, 0, 0, 1, 0] and got[3].f[0].arguments == '{"x":"\\udc00"}'


def test_a_site_has_markers_of_its_own(spark):
    df = spark.createDataFrame([("at 10.1.2.3 in /home/u",), ("$WORKSPACE 10.1.2.3",), ("none",), (None,)], "t string")
    markers = (*canonical.HOST_MARKERS, "10.1.")
    assert [r.m for r in df.select(canonical.host_markers(F.col("t"), markers).alias("m")).collect()] == [" /home/ 10.1.", "", "", ""]


def test_sessions_alone_are_those_of_the_conversion(spark):
    said = [("a", 0, '{"type": "session", "id": "A"}'), ("a", 1, '{"type": "message_end", "message": {"role": "assistant", "content": [{"type": "toolCall", "id": "c", "name": "read"}], "stopReason": "toolUse", "usage": {"input": 1}}}'), ("a", 2, "{torn"), ("b", 0, '{"type": "message_end", "message": {"role": "assistant", "content": [], "stopReason": "error"}}'), ("b", 1, '{"type": "agent_end", "willRetry": true}')]
    df, none = spark.createDataFrame(said, "session string, line long, raw string"), spark.createDataFrame([], OUTCOME)
    got = sorted(capture.sessions(df, none).collect())
    assert got == sorted(capture.convert(df, none)[2].collect())
    assert [(r.session, r.capabilities, r.backend_errors, r.backend_failed) for r in got] == [("a", ["MODEL_IO", "MODEL_TOKEN_USAGE", "TOOL_IO"], 0, False), ("b", ["MODEL_IO", "RETRY_DECISIONS", "TERMINATION_DECISIONS"], 1, True)]


def test_histories_and_running_sums_broadcast_nothing_and_deal_a_chunk_once(spark):
    said = [("a", i, json.dumps(message("user", content="u") if i % 2 else message("assistant", content="x"))) for i in range(6)]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(capture.request_messages(spark.createDataFrame(said, "session string, line long, raw string")))
    rows = spark.createDataFrame([(k, i, 1) for k in ("a", None) for i in range(9)], "k string, at long, x long").hint("merge")
    # One for the rows, one for the sums of chunks and one for these by key; joining them deals only the last again.
    assert plan(prefix.running(rows, "k", "at", {"s": F.col("x")})).count("Exchange hashpartitioning") <= 4


def most_rows(df):
    """The most rows that a join of df's plan returned, once it ran."""
    nodes, most = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if name.endswith("Join"):
            most = max(most, node.metrics().apply("numOutputRows").value())
    return most


@pytest.mark.parametrize("shared", [4, 256])
def test_a_message_is_not_joined_with_each_request_after_it(spark, monkeypatch, shared):
    monkeypatch.setattr(capture, "SHARED", shared, raising=False)
    kinds = {k: [random.Random(f"{k}").choice(("user", "assistant")) for _ in range(n)] for k, n in (("a", 60), ("b", 9), ("c", 1), (None, 3))}
    said = [(k, 2 * i, json.dumps({"type": "message_end", "message": {"role": role, "content": f"{k}{i}"}})) for k, roles in kinds.items() for i, role in enumerate(roles)]
    found = capture.request_messages(spark.createDataFrame(said, "session string, line long, raw string").repartition(3))
    got = {(r.session, r.assistant_index): [(m.n, m.role, m.content) for m in r.messages] for r in found.collect()}
    expected = {}
    for k, roles in kinds.items():
        for i in range(len(roles)):
            if roles[i] == "assistant":
                expected[k, roles[: i + 1].count("assistant")] = [(j, roles[j], f'"{k}{j}"') for j in range(i)] if k else []
    assert got == expected
    if shared > 60:
        assert most_rows(found) <= len(said)


def test_walks_keep_only_what_may_hold_a_key(spark):
    rows = [(1, '{"a":{"b":[{"c":1}]},"secret":{"x":{"token":[1]}},"d":"token"}'), (2, '{"a":{"b":{"c":{"e":2}}}}'), (3, '[{"\\u0054oken":1},{"API-KEY":{"y":1}}]')]
    df = spark.createDataFrame(rows, "id long, t string").select("id", F.try_parse_json("t").alias("v"))
    assert {(r.id, r.path) for r in keys_at(df, "v", canonical.SECRET_KEYS).collect()} == {(1, "$.secret"), (1, "$.secret.x.token"), (3, "$[0].Token"), (3, "$[1]['API-KEY']")}
    below = walk(df, "v", nests() & F.to_json("value").contains('"c"'))
    assert {r.path for r in below.filter("id = 1").collect()} == {"$", "$.a", "$.a.b", "$.a.b[0]"} and walk(df.filter("id = 2"), "v", nests() & F.to_json("value").contains("none")).isEmpty()
