"""Assembly and certification of single episodes; paths against the standard library."""

import posixpath

import pytest
from pyspark.sql import functions as F
from tracemill.functions import paths
from tracemill.operators import assembly, training

SCHEMA = (
    "event_id string, episode_id string, run_id string, span_id string, parent_span_id string, sequence long, timestamp string, event_type string, status string, passed boolean, artifact_refs array<string>, "
    "task_status string, execution_validity string, verifier_status string, score double, termination_reason string, evidence_event_ids array<string>, arrival long, digest string"
)


def row(episode, seq, kind, span="s", **changes):
    base = dict(
        event_id=f"{episode}{seq}{kind}", episode_id=episode, run_id="r", span_id=span, parent_span_id=None, sequence=seq, timestamp=f"2026-01-01T00:00:0{seq}Z", event_type=kind, status="SUCCEEDED", passed=None,
        artifact_refs=[], task_status=None, execution_validity=None, verifier_status=None, score=None, termination_reason=None, evidence_event_ids=[], arrival=seq, digest=f"{episode}{seq}{kind}",
    )
    return tuple((base | changes).values())


def whole(episode, **end):
    """A verified episode; end changes its terminal event."""
    declared = dict(task_status="SUCCESS", execution_validity="VALID", verifier_status="PASSED", score=1.0, termination_reason="DONE", evidence_event_ids=[f"{episode}3VERIFICATION_FINISHED"])
    return [
        row(episode, 0, "MODEL_REQUEST"), row(episode, 1, "MODEL_RESPONSE"), row(episode, 2, "VERIFICATION_STARTED", "v"), row(episode, 3, "VERIFICATION_FINISHED", "v", passed=True),
        row(episode, 4, "EPISODE_FINISHED", **(declared | end)),
    ]


@pytest.fixture(scope="module")
def episodes(spark):
    rows = whole("good") + whole("failed", task_status="FAILURE") + whole("cited", evidence_event_ids=[]) + whole("odd", task_status="MAYBE", termination_reason=" ")
    rows += whole("twice") + [row("twice", 1, "MODEL_RESPONSE", arrival=9)] + whole("clash") + [row("clash", 1, "MODEL_RESPONSE", digest="other", arrival=9)]
    rows += [r for r in whole("hole") if r[5] != 1] + whole("orphan")[:-1] + [row("orphan", 4, "EPISODE_FINISHED", "e", parent_span_id="gone", artifact_refs=["lost", "kept"])]
    rows += whole("ends") + [row("ends", 5, "EPISODE_FINISHED")] + whole("open")[:-1] + whole("nowhere") + [row("runs", 0, "MODEL_REQUEST"), row("runs", 1, "MODEL_RESPONSE", run_id="q")]
    names = [n for n in {r[1] for r in rows} if n != "nowhere"]
    log = spark.createDataFrame(rows, SCHEMA)
    found = assembly.assemble(log, spark.createDataFrame([(n,) for n in names], "episode_id string"), spark.createDataFrame([("kept",)], "artifact_id string"))
    return {r.episode_id: r for r in assembly.certify(found).collect()}


def test_states_and_what_is_lacking(episodes):
    assert "nowhere" not in episodes and "runs" not in episodes
    assert {k: r.state for k, r in episodes.items()} == {
        "good": "COMPLETE", "failed": "COMPLETE", "cited": "COMPLETE", "odd": "COMPLETE", "twice": "COMPLETE", "clash": "CORRUPT", "hole": "PARTIAL", "orphan": "PARTIAL", "ends": "CORRUPT", "open": "PARTIAL",
    }
    assert episodes["twice"].duplicates == 1 and episodes["clash"].duplicates == 1 and episodes["good"].duplicates == 0
    assert (episodes["hole"].sequence_gaps, episodes["hole"].missing_types) == ("1", "MODEL_RESPONSE")
    assert (episodes["orphan"].orphan_span_ids, episodes["orphan"].missing_artifacts) == ("e", "lost")
    assert (episodes["open"].missing_types, episodes["open"].termination_reason, episodes["open"].observable) == ("EPISODE_FINISHED", "CAPTURE_INTERRUPTED", False)
    assert (episodes["odd"].task_status, episodes["odd"].validity, episodes["odd"].score, episodes["odd"].termination_reason) == ("UNKNOWN", "UNKNOWN", None, "UNSPECIFIED")


def test_certification_is_fail_closed(episodes):
    got = {k: (r.certification, r.reasons) for k, r in episodes.items()}
    assert got["good"] == ("CERTIFIED", "") and got["twice"] == ("CERTIFIED", "")
    assert got["failed"] == ("REJECTED", "PASSED_BUT_NOT_SUCCESS") and got["cited"] == ("REJECTED", "EVIDENCE_NOT_VERIFIER")
    assert got["hole"] == ("INSUFFICIENT_EVIDENCE", "INTEGRITY_PARTIAL") and got["clash"] == ("REJECTED", "INTEGRITY_CORRUPT")
    assert got["open"] == ("REJECTED", "ATTESTED_BUT_NOT_VALID,PASSED_BUT_NOT_SUCCESS")


def test_conflicts_and_lost_contexts_are_quarantined(spark):
    rows = [row("a", 0, "TOOL_CALL"), row("a", 0, "TOOL_CALL", digest="x", arrival=5), row("a", 0, "TOOL_CALL", digest="x", arrival=6), row("b", 0, "TOOL_CALL")]
    got = assembly.quarantine(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("a",)], "episode_id string"))
    assert sorted((r.event_id, r.code, r.n) for r in got.collect()) == [("a0TOOL_CALL", "CONFLICTING_EVENT_ID", 2), ("b0TOOL_CALL", "EPISODE_CONTEXT_MISSING", 1)]


def test_episodes_of_several_runs_or_none_are_quarantined(spark):
    rows = [row("runs", 0, "TOOL_CALL"), row("runs", 1, "TOOL_CALL", run_id="q"), row("none", 0, "TOOL_CALL", run_id=None), row("half", 0, "TOOL_CALL"), row("half", 1, "TOOL_CALL", run_id=None), row("good", 0, "TOOL_CALL")]
    rows += [row("good", 1, "TOOL_CALL", run_id="r"), row("lost", 0, "TOOL_CALL"), row("lost", 1, "TOOL_CALL", run_id="q")]
    log, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("runs",), ("none",), ("half",), ("good",)], "episode_id string")
    got = sorted((r.episode_id, r.code) for r in assembly.quarantine(log, known).collect())
    assert got == [(e, "EPISODE_CONTRACT_INVALID") for e in ("half", "half")] + [("lost", "EPISODE_CONTEXT_MISSING")] * 2 + [(e, "EPISODE_CONTRACT_INVALID") for e in ("none", "runs", "runs")]
    assert [r.episode_id for r in assembly.assemble(log, known, spark.createDataFrame([], "artifact_id string")).collect()] == ["good"]


def test_paths_are_normal_as_the_standard_library_has_them(spark):
    said = ["", ".", "a//b/./c", "../a/../../b", "/a/../../b", "a/..", "/", "x/../..", "a/b/../../../c/d", "/ws/../ws/x", "..."]
    got = spark.createDataFrame([(p,) for p in said], "p string").select("p", paths.normal(F.col("p")).alias("n")).collect()
    assert {r.p: r.n for r in got} == {p: posixpath.normpath(p) for p in said}


def test_sequences_need_their_history(spark):
    calls = [("a", 1, [1, 2], [3]), ("a", 2, [1, 2, 3, 9, 9], [4, 5]), ("b", 1, [1], [2]), ("b", 2, [7, 2, 3], [4])]
    got = {r.episode: r for r in training.sequences(spark.createDataFrame(calls, "episode string, position int, prompt array<bigint>, response array<bigint>")).collect()}
    assert (got["a"].tokens, got["a"].mask, got["a"].rounds, got["a"].trainable) == ([3, 9, 9, 4, 5], [1, 0, 0, 1, 1], 1, True)
    assert got["b"].tokens is None and not got["b"].trainable


def test_lists_of_ids_go_by_their_texts(spark):
    numbers = SCHEMA.replace("span_id string, parent_span_id string", "span_id long, parent_span_id long").replace("artifact_refs array<string>", "artifact_refs array<long>")
    rows = [row("e", 0, "EPISODE_FINISHED", 90, parent_span_id=7, artifact_refs=[90, 300]), row("e", 1, "TOOL_CALL", 300, parent_span_id=7, artifact_refs=[5])]
    none = spark.createDataFrame([], "artifact_id long")
    got = assembly.assemble(spark.createDataFrame(rows, numbers), spark.createDataFrame([("e",)], "episode_id string"), none).first()
    assert (got.missing_artifacts, got.orphan_span_ids) == ("300,5,90", "300,90")


def test_an_id_in_several_episodes_counts_where_it_came(spark):
    rows = [row(e, 0, "TOOL_CALL") for e in "abc"] + [row(e, 1, "TOOL_CALL", event_id=i, digest=d, arrival=n) for e, i, d, n in (("a", "x", "1", 0), ("b", "x", "1", 1), ("b", "x", "1", 2), ("b", "y", "1", 0), ("c", "y", "2", 1))]
    log, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(e,) for e in "abc"], "episode_id string")
    got = {r.episode_id: (r.n_events, r.duplicates, r.state) for r in assembly.assemble(log, known, spark.createDataFrame([], "artifact_id string")).collect()}
    assert got == {"a": (2, 0, "PARTIAL"), "b": (2, 2, "CORRUPT"), "c": (1, 1, "CORRUPT")}
    assert [(r.event_id, r.episode_id, r.n) for r in assembly.quarantine(log, known).collect()] == [("y", "c", 1)]
