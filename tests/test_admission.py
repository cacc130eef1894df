"""Admission: members without a reason, found without joining the others to all they cite."""

from pyspark.sql import functions as F

from tracemill.operators import training

MEMBERS = "member string, episode long, certification long, bundle long, artifact long, group long, policy long, reward int"


def test_admitted_members_alone_are_those_without_a_reason(spark):
    rows = [(f"{i}", i % 3, i % 7, i % 5, i % 4, None if i % 11 == 0 else i % 2, None if i % 13 == 0 else 1, i % 2) for i in range(400)] + [("n", None, None, None, None, 1, 1, 1)] * 2
    members = spark.createDataFrame(rows, MEMBERS)
    decisions = spark.createDataFrame([(i, "ELIGIBLE" if i % 3 else "REJECTED", i % 3 if i < 5 else None) for i in range(6)] + [(1, "ELIGIBLE", 1)], "decision long, verdict string, decision_episode long")
    bundles = spark.createDataFrame([(i, None if i == 3 else i % 3, [0, 1, 2] if i < 2 else [3, None]) for i in range(4)], "bundle_sum long, bundle_episode long, bound array<long>")
    artifacts = spark.createDataFrame([(i, None if i == 2 else "COMPLETED") for i in range(4)], "artifact_sum long, status string")
    want = training.admitted(members, decisions, bundles, artifacts).filter("reason = ''").drop("reason")
    got = training.admitted_only(members, decisions, bundles, artifacts)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0
    # A rule that fails is applied before the next table is joined.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and got.filter(F.col("group").isNull()).isEmpty()
