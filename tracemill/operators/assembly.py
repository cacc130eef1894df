"""Assembly of episodes from an event log, and their certification.

Events have event_id, episode_id, run_id, span_id, parent_span_id, sequence, timestamp, event_type, status, passed,
artifact_refs, what a terminal event declares (task_status, execution_validity, verifier_status, score,
termination_reason, evidence_event_ids), arrival (when the log got them) and digest (of the content).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..sources.scratch import hinted, settle

DECLARED = ("task_status", "execution_validity", "verifier_status", "score", "termination_reason", "evidence_event_ids")
ORDER = ("sequence", "timestamp", "event_id")


def firsts(events: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """A row for each event_id, of its first content: digest, episode_id and columns; many (other contents came too), crossed (in
    several episodes).

    One grouping that combines map-side, no window over an id's arrivals: an id may have very many. Only what is named in columns is
    shuffled; ties of arrival go by digest, then episode and columns.
    """
    named = events.filter("event_id is not null").select("event_id", F.struct("arrival", "digest", "episode_id", *[c.alias(n) for n, c in columns.items()]).alias("e"))
    digest, episode = F.col("e.digest"), F.col("e.episode_id")
    per = named.groupBy("event_id").agg(
        F.min("e").alias("e"), (F.min(digest) < F.max(digest)).alias("many"),
        ((F.min(episode) < F.max(episode)) | (F.count(episode) < F.count(F.lit(1)))).alias("crossed"),
    )
    return settle(per.select("event_id", "many", "crossed", *[f"e.{c}" for c in ("digest", "episode_id", *columns)]), "firsts")


def quarantine(events: DataFrame, contexts: DataFrame) -> DataFrame:
    """event_id, episode_id, code, n: contents that differ from their id's first, events without a context, and the events of
    episodes that have no run, or several: these are not assembled."""
    first = firsts(events, {"run_id": F.col("run_id")})
    heads = first.filter("many").select("event_id", F.col("digest").alias("_head"))
    conflicts = events.groupBy("event_id", "digest", "episode_id").agg(F.count(F.lit(1)).alias("n")).join(heads, "event_id").filter("digest <> _head").select("event_id", "episode_id", F.lit("CONFLICTING_EVENT_ID").alias("code"), "n")
    told = settle(first.select("event_id", "episode_id", "run_id").join(contexts.select("episode_id").distinct().withColumn("known", F.lit(True)), "episode_id", "left"), "told")
    lost, known = told.filter("known is null"), told.filter("known")
    mixed = known.groupBy("episode_id").agg(F.min("run_id").alias("a"), F.max("run_id").alias("b"), F.max(F.col("run_id").isNull()).alias("none")).filter("none or a <> b")
    invalid = known.join(mixed.select("episode_id"), "episode_id", "left_semi")
    one = lambda df, code: df.select("event_id", "episode_id", F.lit(code).alias("code"), F.lit(1).cast("long").alias("n"))
    return conflicts.unionByName(one(lost, "EPISODE_CONTEXT_MISSING")).unionByName(one(invalid, "EPISODE_CONTRACT_INVALID"))


def _listed(c: Column) -> Column:
    """Ids joined by commas, in the order of their texts whatever their type."""
    return F.array_join(F.array_sort(c.cast("array<string>")), ",")


def assemble(events: DataFrame, contexts: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Per episode with a context: its integrity with what it lacks, its terminal outcome, and the facts that
    certification needs. One grouping of the first arrivals by episode; duplicates are an episode's
    arrivals that are not its first contents; contexts has episode_id, artifacts artifact_id."""
    kind = F.col("event_type")
    ending, verifier = kind == "EPISODE_FINISHED", kind == "VERIFICATION_FINISHED"
    # What only terminal events and verifications have is null elsewhere, so it is not shuffled with every event.
    held = {c: F.col(c) for c in ("run_id", "sequence", "timestamp", "span_id", "parent_span_id", "event_type", "artifact_refs")}
    held |= {"verdict": F.when(verifier, attestation(F.col("status"), F.col("passed"))), "declared": F.when(ending, F.struct(*DECLARED))}
    kept = firsts(events, held)
    arrived = events.filter("event_id is not null").groupBy("episode_id").agg(F.count(F.lit(1)).alias("arrived"))
    # An id of several episodes: each episode that one of its other contents is in clashes too.
    crossed = hinted(settle(kept.filter("many and crossed").select("event_id", F.col("digest").alias("_head")), "crossed"))
    others = events.select("event_id", "episode_id", "digest").join(crossed, "event_id").filter("digest <> _head").select("episode_id")
    clashes = kept.filter("many").select("episode_id").unionByName(others).distinct().withColumn("conflict", F.lit(True))
    # Firsts of an episode are dealt by it once, for what follows.
    first = kept.join(contexts.select("episode_id"), "episode_id", "left_semi")
    wanted = kept.filter(F.size("artifact_refs") > 0).select("episode_id", F.explode("artifact_refs").alias("artifact_id")).distinct()
    absent = wanted.join(hinted(artifacts.select("artifact_id").distinct()), "artifact_id", "left_anti").groupBy("episode_id").agg(_listed(F.collect_set("artifact_id")).alias("missing_artifacts"))

    spans = lambda k: F.collect_set(F.when(kind == k, F.col("span_id")))
    count = lambda k: F.count(F.when(kind == k, 1))
    ends = F.struct(*ORDER, *[F.col(f"declared.{c}").alias(c) for c in DECLARED])
    per = first.groupBy("episode_id").agg(
        F.count("*").alias("n_events"), F.max("sequence").alias("last"), (F.min("run_id") == F.max("run_id")).alias("one_run"), F.max(F.col("run_id").isNull()).alias("no_run"),
        F.collect_set("sequence").alias("sequences"), F.collect_set("span_id").alias("spans"),
        F.collect_set(F.when(F.col("parent_span_id").isNotNull(), F.struct("parent_span_id", "span_id"))).alias("parents"),
        F.min("timestamp").alias("started_at"), F.max("timestamp").alias("ended_at"),
        F.array(*[F.when(F.size(F.array_except(spans(a), spans(b))) > 0, F.lit(b)) for a, b in schemas.SPAN_PAIRS], F.when(count("EPISODE_FINISHED") == 0, F.lit("EPISODE_FINISHED"))).alias("types"),
        count("EPISODE_FINISHED").alias("terminals"), F.max(F.when(ending, ends)).alias("terminal"),
        count("MODEL_REQUEST").alias("requests"), count("MODEL_RESPONSE").alias("responses"), count("TOOL_CALL").alias("calls"), F.count(F.when(verifier, 1)).alias("verifiers"),
        F.collect_set(F.when(verifier, F.col("event_id"))).alias("verifier_ids"),
        F.max(F.when(F.col("verdict").isNotNull(), F.struct(*ORDER, F.col("verdict").alias("v"))))["v"].alias("attested"),
    ).withColumn("n_sequences", F.size("sequences"))
    whole = per.join(arrived, "episode_id").withColumn("duplicates", F.col("arrived") - F.col("n_events")).join(clashes, "episode_id", "left").join(absent, "episode_id", "left")
    # Numbers between 0 and the last that are not there: as many as the holes, not as the last number.
    held = F.array_sort("sequences")
    holes = F.flatten(
        F.transform(
            held, lambda x, i: F.when(x > F.coalesce(F.get(held, i - 1), F.lit(-1)) + 1, F.sequence(F.coalesce(F.get(held, i - 1), F.lit(-1)) + 1, x - 1)).otherwise(F.array().cast("array<bigint>"))
        )
    )
    orphans = F.array_distinct(F.transform(F.filter("parents", lambda p: ~F.array_contains("spans", p["parent_span_id"])), lambda p: p["span_id"]))
    missing = F.filter("types", lambda t: t.isNotNull())
    t = F.col("terminal")
    known = lambda c, values: F.coalesce(t[c], F.lit("UNKNOWN")).isin(*values)
    valid = known("task_status", schemas.TASK_STATUS) & known("execution_validity", schemas.VALIDITY) & known("verifier_status", (*schemas.ATTESTED, "NOT_RUN", "UNKNOWN"))
    declared = lambda c: F.when(t.isNotNull() & valid, F.coalesce(t[c], F.lit("UNKNOWN"))).otherwise("UNKNOWN")
    named = F.coalesce(t["termination_reason"], F.lit("UNSPECIFIED"))
    reason = F.when(t.isNull(), "CAPTURE_INTERRUPTED").when(named.rlike(r"(?U)\S"), named).otherwise("UNSPECIFIED")
    evidence = F.when(valid & (F.size(t["evidence_event_ids"]) > 0), t["evidence_event_ids"]).otherwise(F.array(t["event_id"]))
    told = whole.withColumn("holes", holes).withColumn("orphans", orphans).withColumn("missing", missing)
    corrupt = F.coalesce("conflict", F.lit(False)) | (F.col("n_events") > F.col("n_sequences")) | (F.col("terminals") > 1)
    partial = (F.size("holes") > 0) | (F.size("orphans") > 0) | (F.size("missing") > 0) | F.col("missing_artifacts").isNotNull()
    return told.filter("one_run and not no_run").select(
        "episode_id", F.when(corrupt, "CORRUPT").when(partial, "PARTIAL").otherwise("COMPLETE").alias("state"), "n_events", "duplicates",
        F.array_join("holes", ",").alias("sequence_gaps"), _listed(F.col("orphans")).alias("orphan_span_ids"), _listed(F.col("missing")).alias("missing_types"),
        F.coalesce("missing_artifacts", F.lit("")).alias("missing_artifacts"), declared("task_status").alias("task_status"), declared("execution_validity").alias("validity"),
        declared("verifier_status").alias("verifier_status"), F.when(valid, t["score"]).alias("score"), reason.alias("termination_reason"), t.isNotNull().alias("observable"),
        "started_at", "ended_at", "requests", "responses", "calls", "verifiers", "attested",
        (F.when(t.isNotNull(), F.size(F.array_intersect(evidence, "verifier_ids")) > 0).otherwise(F.lit(True))).alias("evidence_is_verifier"),
    )


def attestation(status: Column, passed: Column) -> Column:
    """The verdict that a finished verification attests, or null."""
    return (
        F.when((status == "SUCCEEDED") & passed, "PASSED").when((status == "FAILED") & ~passed, "FAILED").when(status == "ERROR", "ERROR").when(status == "TIMEOUT", "TIMEOUT")
    )


def certify(episodes: DataFrame) -> DataFrame:
    """Adds certification and reasons (sorted codes, comma-joined) to assembled episodes, fail-closed: a rejection
    dominates missing evidence, and only one of the two kinds of reasons is given."""
    success, valid = F.col("task_status") == "SUCCESS", F.col("validity") == "VALID"
    attested, trusted = F.col("attested"), F.coalesce(F.col("attested").isin("PASSED", "FAILED"), F.lit(False))
    broken = F.coalesce(attested.isin("ERROR", "TIMEOUT"), F.lit(False))
    said = lambda c, code: F.when(F.coalesce(c, F.lit(False)), F.lit(code))
    rejected = F.array(
        said(F.col("state") == "CORRUPT", "INTEGRITY_CORRUPT"),
        said((attested == "PASSED") & ~success, "PASSED_BUT_NOT_SUCCESS"), said((attested == "FAILED") & success, "FAILED_BUT_SUCCESS"),
        said(trusted & ~valid, "ATTESTED_BUT_NOT_VALID"), said(broken & success, "BROKEN_VERIFIER_BUT_SUCCESS"), said(broken & F.col("score").isNotNull(), "BROKEN_VERIFIER_WITH_SCORE"),
        said((F.col("verifiers") > 0) & F.col("observable") & ~F.col("evidence_is_verifier"), "EVIDENCE_NOT_VERIFIER"),
    )
    lacking = F.array(said(F.col("state") == "PARTIAL", "INTEGRITY_PARTIAL"), said(attested.isNull() & success & valid, "SUCCESS_NOT_ATTESTED"))
    codes = lambda a: F.array_sort(F.filter(a, lambda x: x.isNotNull()))
    ruled = episodes.withColumn("_r", codes(rejected)).withColumn("_l", codes(lacking))
    status = F.when(F.size("_r") > 0, "REJECTED").when(F.size("_l") > 0, "INSUFFICIENT_EVIDENCE").otherwise("CERTIFIED")
    return ruled.withColumn("certification", status).withColumn("reasons", F.array_join(F.when(F.size("_r") > 0, F.col("_r")).otherwise(F.col("_l")), ",")).drop("_r", "_l")


def capability_evidence(responses: DataFrame) -> DataFrame:
    """episode_id with token_ids, logprobs and mask (null: not there) of each response -> per episode whether each is
    really there, and whether arrays that are together agree in length."""
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    tokens, logs, mask = size("token_ids"), size("logprobs"), size("mask")
    ones = F.aggregate("mask", F.lit(0), lambda s, x: s + x)
    # Each part is null where one of its arrays is not there.
    off = F.coalesce(tokens != logs, F.lit(False)) | F.coalesce(tokens != mask, F.lit(False)) | F.coalesce((logs != ones) & (logs != mask), F.lit(False))
    there = lambda c: F.when(F.max(F.col(c).isNotNull()), "EVIDENCE_PRESENT").otherwise("MISSING")
    some = F.max(F.col("token_ids").isNotNull() | F.col("logprobs").isNotNull() | F.col("mask").isNotNull())
    return responses.groupBy("episode_id").agg(
        there("token_ids").alias("token_evidence"), there("logprobs").alias("logprob_evidence"), there("mask").alias("mask_evidence"),
        F.when(~some, "MISSING").when(F.max(off), "MISALIGNED").otherwise("EVIDENCE_PRESENT").alias("aligned"),
    )


def eligibility(certified: DataFrame, evidence: DataFrame) -> DataFrame:
    """Certified episodes with behavior_complete, target_complete and same_policy -> status and flags of what an
    episode may train: supervised, preference, off-policy and on-policy reinforcement."""
    e = certified.join(evidence, "episode_id", "left")
    ok, yes = F.col("certification") == "CERTIFIED", lambda c: F.coalesce(F.col(c) == "EVIDENCE_PRESENT", F.lit(False))
    attested, valid = F.coalesce(F.col("attested").isin("PASSED", "FAILED"), F.lit(False)), F.col("validity") == "VALID"
    acted = (F.col("requests") > 0) & (F.col("responses") + F.col("calls") > 0)
    sft = ok & (F.col("task_status") == "SUCCESS") & valid & attested & (F.col("verifier_status") == "PASSED") & acted
    reward = F.col("score").isNotNull() & ~F.isnan("score") & valid & attested
    fields = ok & yes("token_evidence") & yes("mask_evidence") & yes("aligned") & reward
    same = F.col("behavior_complete") & F.col("target_complete") & F.col("same_policy")
    flags = {"sft": sft, "preference": ok & attested & valid, "off_policy": fields & ~same, "on_policy": fields & yes("logprob_evidence") & same}
    out = e.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    status = F.when(~ok, F.col("certification")).when(F.col("on_policy"), "ON_POLICY_RL_ELIGIBLE").when(F.col("off_policy"), "OFF_POLICY_RL_ELIGIBLE")
    return out.withColumn("eligibility", status.when(F.col("sft"), "SFT_ELIGIBLE").when(F.col("preference"), "PREFERENCE_ELIGIBLE").otherwise("REJECTED"))


PROFILES = ("HARNESS_ANALYSIS", "EVALUATION", "SFT", "PREFERENCE", "OFF_POLICY_RL", "ON_POLICY_RL")


def decisions(eligible: DataFrame) -> DataFrame:
    """One verdict an episode and consumer profile."""
    lacking = F.col("certification") == "INSUFFICIENT_EVIDENCE"
    attested = F.coalesce(F.col("attested").isin("PASSED", "FAILED"), F.lit(False))
    verdict = {
        "HARNESS_ANALYSIS": F.when(F.col("state") == "CORRUPT", "REJECTED").when(F.col("n_events") == 0, "INSUFFICIENT_EVIDENCE").otherwise("ELIGIBLE"),
        "EVALUATION": F.when(F.col("certification") != "CERTIFIED", "INSUFFICIENT_EVIDENCE").when(F.col("validity") != "VALID", "REJECTED").when(~attested, "INSUFFICIENT_EVIDENCE").otherwise("ELIGIBLE"),
        "SFT": F.when(F.col("sft"), "ELIGIBLE").when(lacking, "INSUFFICIENT_EVIDENCE").otherwise("REJECTED"),
        "PREFERENCE": F.when(F.col("preference"), "ELIGIBLE").when(lacking, "INSUFFICIENT_EVIDENCE").otherwise("REJECTED"),
        "OFF_POLICY_RL": F.when(F.col("off_policy"), "ELIGIBLE").when(lacking, "INSUFFICIENT_EVIDENCE").otherwise("REJECTED"),
        "ON_POLICY_RL": F.when(F.col("on_policy"), "ELIGIBLE").when(lacking, "INSUFFICIENT_EVIDENCE").otherwise("REJECTED"),
    }
    each = F.array(*[F.struct(F.lit(p).alias("profile"), verdict[p].alias("verdict")) for p in PROFILES])
    return eligible.select("episode_id", F.explode(each).alias("d")).select("episode_id", "d.profile", "d.verdict")
