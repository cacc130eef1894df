"""Registered queries on an event log with spans, verdicts and terminal events, drawn from the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly
from ..sources import tables
from .catalog import query

_KINDS = (
    "MODEL_REQUEST", "MODEL_RESPONSE", "TOOL_CALL", "TOOL_RESULT", "VERIFICATION_STARTED", "VERIFICATION_FINISHED", "EPISODE_FINISHED", "SANDBOX_STARTED", "SANDBOX_FINISHED", "HARNESS_DECISION",
)
_LISTED = ", ".join(f"'{k}'" for k in _KINDS)

TRACE = f"""base as (select *, l_partkey * 31 + l_suppkey * 7 + l_linenumber as k from lineitem),
 log as (select l_orderkey as episode_id, case when k % 41 = 0 then 'other' when k % 41 > 1 then 'run' end as run_id, l_orderkey::varchar || '-' || l_linenumber::varchar as event_id, l_linenumber - 1 as sequence, l_shipdate as ts,
 k % 5 as span, case when k % 3 = 0 then k % 7 end as parent, [{_LISTED}][(k % 10)::int + 1] as kind, ['SUCCEEDED', 'FAILED', 'ERROR', 'TIMEOUT'][((k // 10) % 4)::int + 1] as status,
 case (k // 40) % 3 when 0 then true when 1 then false end as passed, case (k // 10) % 3 when 0 then 'SUCCESS' when 1 then 'FAILURE' end as task_status,
 case (k // 30) % 3 when 0 then 'VALID' when 1 then 'INFRA_INVALID' end as validity, case (k // 90) % 3 when 0 then 'PASSED' when 1 then 'FAILED' end as verifier_status,
 case when k % 4 = 0 then l_discount end as score, case k % 5 when 0 then '  ' when 1 then null else 'MODEL_STOP' end as reason,
 case when k % 6 = 0 then l_suppkey end as artifact, case when k % 3 > 0 then l_orderkey::varchar || '-' || ((k % 4) + 1)::varchar end as evidence,
 row(l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) as arrival, row(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount) as content from base),
 firsts as (select *, row_number() over (partition by event_id order by arrival, content) as n, first_value(content) over (partition by event_id order by arrival, content) as head,
 first_value(episode_id) over (partition by event_id order by arrival, content) as head_episode from log),
 accepted as (select f.* from firsts f where n = 1 and episode_id in (select o_orderkey from orders where o_orderkey % 11 <> 0)),
 ok as (select * from accepted where episode_id in (select episode_id from accepted group by 1 having count(distinct run_id) = 1 and count(run_id) = count(*))),
 dups as (select episode_id, count(*) filter (n > 1) as duplicates, coalesce(bool_or(content <> head), false) as conflict from firsts group by 1),
 holes as (select e.episode_id, string_agg(g.x::varchar, ',' order by g.x) as gaps from (select episode_id, max(sequence) as last from ok group by 1) e,
 lateral (select unnest(range(0, e.last)) as x) g where not exists (select 1 from ok o where o.episode_id = e.episode_id and o.sequence = g.x) group by 1),
 orphans as (select episode_id, string_agg(s, ',' order by s) as spans from (select distinct episode_id, span::varchar as s from ok a where parent is not null
 and not exists (select 1 from ok b where b.episode_id = a.episode_id and b.span = a.parent)) group by 1),
 pairs(opened, closed) as (values ('MODEL_REQUEST', 'MODEL_RESPONSE'), ('TOOL_CALL', 'TOOL_RESULT'), ('SANDBOX_STARTED', 'SANDBOX_FINISHED'), ('VERIFICATION_STARTED', 'VERIFICATION_FINISHED')),
 lacking as (select episode_id, string_agg(t, ',' order by t) as types from (select distinct episode_id, closed as t from ok a join pairs on kind = opened
 where not exists (select 1 from ok b where b.episode_id = a.episode_id and b.kind = closed and b.span = a.span)
 union select episode_id, 'EPISODE_FINISHED' from ok group by 1 having count(*) filter (kind = 'EPISODE_FINISHED') = 0) group by 1),
 absent as (select episode_id, string_agg(a, ',' order by a) as artifacts from (select distinct episode_id, artifact::varchar as a from ok where artifact is not null
 and artifact not in (select s_suppkey from supplier where s_suppkey % 10 <> 0)) group by 1),
 ends as (select * from (select *, row_number() over (partition by episode_id order by sequence desc, ts desc, event_id desc) as back from ok where kind = 'EPISODE_FINISHED') where back = 1),
 verdicts as (select *, case when status = 'SUCCEEDED' and passed then 'PASSED' when status = 'FAILED' and not passed then 'FAILED' when status in ('ERROR', 'TIMEOUT') then status end as v from ok where kind = 'VERIFICATION_FINISHED'),
 episodes as (select o.episode_id, case when d.conflict or o.n_events > o.n_seq or o.terminals > 1 then 'CORRUPT'
 when h.gaps is not null or r.spans is not null or l.types is not null or a.artifacts is not null then 'PARTIAL' else 'COMPLETE' end as state, n_events, duplicates,
 coalesce(h.gaps, '') as sequence_gaps, coalesce(r.spans, '') as orphan_span_ids, coalesce(l.types, '') as missing_types, coalesce(a.artifacts, '') as missing_artifacts,
 coalesce(e.task_status, 'UNKNOWN') as task_status, coalesce(e.validity, 'UNKNOWN') as validity, coalesce(e.verifier_status, 'UNKNOWN') as verifier_status, e.score,
 case when e.episode_id is null then 'CAPTURE_INTERRUPTED' when e.reason is null or trim(e.reason) = '' then 'UNSPECIFIED' else e.reason end as termination_reason,
 e.episode_id is not null as observable, started_at, ended_at, requests, responses, calls, verifiers,
 (select arg_max(v, (sequence, ts, event_id)) from verdicts where verdicts.episode_id = o.episode_id and v is not null) as attested,
 e.episode_id is null or coalesce(e.evidence, e.event_id) in (select event_id from verdicts where verdicts.episode_id = o.episode_id) as evidence_is_verifier
 from (select episode_id, count(*) as n_events, count(distinct sequence) as n_seq, count(*) filter (kind = 'EPISODE_FINISHED') as terminals, min(ts) as started_at, max(ts) as ended_at,
 count(*) filter (kind = 'MODEL_REQUEST') as requests, count(*) filter (kind = 'MODEL_RESPONSE') as responses, count(*) filter (kind = 'TOOL_CALL') as calls,
 count(*) filter (kind = 'VERIFICATION_FINISHED') as verifiers from ok group by 1) o join dups d on d.episode_id = o.episode_id left join holes h on h.episode_id = o.episode_id
 left join orphans r on r.episode_id = o.episode_id left join lacking l on l.episode_id = o.episode_id left join absent a on a.episode_id = o.episode_id left join ends e on e.episode_id = o.episode_id)"""


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trace events, with repeats, conflicts, gaps, orphans and odd terminal events."""
    lines = tables.read(spark, sf_dir, "lineitem")
    k = F.col("l_partkey") * 31 + F.col("l_suppkey") * 7 + F.col("l_linenumber")
    over = lambda n: F.floor(F.col("k") / n).cast("long")
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), i.cast("int") + 1)
    content = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount"]
    event = lambda n: F.concat_ws("-", F.col("l_orderkey").cast("string"), n.cast("string"))
    score = F.when(F.col("k") % 4 == 0, F.col("l_discount"))
    return lines.withColumn("k", k).select(
        F.col("l_orderkey").alias("episode_id"), F.when(F.col("k") % 41 == 0, "other").when(F.col("k") % 41 > 1, "run").alias("run_id"), event(F.col("l_linenumber")).alias("event_id"), (F.col("l_linenumber") - 1).cast("long").alias("sequence"),
        F.col("l_shipdate").alias("timestamp"), (F.col("k") % 5).alias("span_id"), F.when(F.col("k") % 3 == 0, F.col("k") % 7).alias("parent_span_id"),
        pick(_KINDS, F.col("k") % 10).alias("event_type"), pick(("SUCCEEDED", "FAILED", "ERROR", "TIMEOUT"), over(10) % 4).alias("status"),
        F.when(over(40) % 3 == 0, True).when(over(40) % 3 == 1, False).alias("passed"), F.when(over(10) % 3 == 0, "SUCCESS").when(over(10) % 3 == 1, "FAILURE").alias("task_status"),
        F.when(over(30) % 3 == 0, "VALID").when(over(30) % 3 == 1, "INFRA_INVALID").alias("execution_validity"),
        F.when(over(90) % 3 == 0, "PASSED").when(over(90) % 3 == 1, "FAILED").alias("verifier_status"), score.alias("score"),
        F.when(F.col("k") % 5 == 0, "  ").when(F.col("k") % 5 > 1, "MODEL_STOP").alias("termination_reason"),
        F.when(F.col("k") % 3 > 0, F.array(event(F.col("k") % 4 + 1))).otherwise(F.array().cast("array<string>")).alias("evidence_event_ids"),
        F.when(F.col("k") % 6 == 0, F.array("l_suppkey")).otherwise(F.array().cast("array<bigint>")).alias("artifact_refs"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount").alias("arrival"), F.unhex(F.sha2(F.to_json(F.struct(*content)), 256)).alias("digest"),
    )


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode_id")).filter("episode_id % 11 <> 0")


def _episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    artifacts = tables.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("artifact_id")).filter("artifact_id % 10 <> 0")
    return assembly.assemble(trace(spark, sf_dir), _contexts(spark, sf_dir), artifacts)


@query(f"with {TRACE} select * from episodes")
def assemble_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _episodes(spark, sf_dir)


@query(f"""with {TRACE} select event_id, episode_id, 'CONFLICTING_EVENT_ID' as code, count(*) as n from firsts where content <> head group by event_id, episode_id, content
 union all select event_id, episode_id, 'EPISODE_CONTEXT_MISSING', 1 from firsts where n = 1 and episode_id not in (select o_orderkey from orders where o_orderkey % 11 <> 0)
 union all select event_id, episode_id, 'EPISODE_CONTRACT_INVALID', 1 from accepted where episode_id not in (select episode_id from ok)""")
def assembly_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.quarantine(trace(spark, sf_dir), _contexts(spark, sf_dir))


_RULED = """ruled as (select *, list_sort(list_filter([case when state = 'CORRUPT' then 'INTEGRITY_CORRUPT' end, case when attested = 'PASSED' and task_status <> 'SUCCESS' then 'PASSED_BUT_NOT_SUCCESS' end,
 case when attested = 'FAILED' and task_status = 'SUCCESS' then 'FAILED_BUT_SUCCESS' end, case when attested in ('PASSED', 'FAILED') and validity <> 'VALID' then 'ATTESTED_BUT_NOT_VALID' end,
 case when attested in ('ERROR', 'TIMEOUT') and task_status = 'SUCCESS' then 'BROKEN_VERIFIER_BUT_SUCCESS' end, case when attested in ('ERROR', 'TIMEOUT') and score is not null then 'BROKEN_VERIFIER_WITH_SCORE' end,
 case when verifiers > 0 and observable and not evidence_is_verifier then 'EVIDENCE_NOT_VERIFIER' end], lambda x: x is not null)) as r,
 list_sort(list_filter([case when state = 'PARTIAL' then 'INTEGRITY_PARTIAL' end, case when attested is null and task_status = 'SUCCESS' and validity = 'VALID' then 'SUCCESS_NOT_ATTESTED' end], lambda x: x is not null)) as l from episodes),
 certified as (select * exclude (r, l), case when len(r) > 0 then 'REJECTED' when len(l) > 0 then 'INSUFFICIENT_EVIDENCE' else 'CERTIFIED' end as certification,
 array_to_string(case when len(r) > 0 then r else l end, ',') as reasons from ruled)"""


@query(f"with {TRACE}, {_RULED} select episode_id, state, attested, task_status, validity, certification, reasons from certified")
def certify_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.certify(_episodes(spark, sf_dir)).select("episode_id", "state", "attested", "task_status", "validity", "certification", "reasons")


_ARRAYS = """answers as (select episode_id, case when k % 2 = 0 then k % 4 end as t, case when k % 3 = 0 then (k // 7) % 4 end as g, case when k % 5 < 3 then (k // 11) % 4 end as m,
 least((k // 11) % 4, (k // 13) % 4) as ones from (select l_orderkey as episode_id, l_partkey * 31 + l_suppkey * 7 + l_linenumber as k from lineitem) where k % 10 = 1),
 evidence as (select episode_id, case when bool_or(t is not null) then 'EVIDENCE_PRESENT' else 'MISSING' end as token_evidence, case when bool_or(g is not null) then 'EVIDENCE_PRESENT' else 'MISSING' end as logprob_evidence,
 case when bool_or(m is not null) then 'EVIDENCE_PRESENT' else 'MISSING' end as mask_evidence, case when not bool_or(t is not null or g is not null or m is not null) then 'MISSING'
 when bool_or(coalesce(t <> g, false) or coalesce(t <> m, false) or coalesce(g <> ones and g <> m, false)) then 'MISALIGNED' else 'EVIDENCE_PRESENT' end as aligned from answers group by 1)"""


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_id"), (F.col("l_partkey") * 31 + F.col("l_suppkey") * 7 + F.col("l_linenumber")).alias("k"))
    over = lambda n: F.floor(F.col("k") / n).cast("long")
    size, ones = over(11) % 4, F.least(over(11) % 4, over(13) % 4)
    many = lambda value, n: F.array_repeat(F.lit(value), n.cast("int"))
    answers = lines.filter("k % 10 = 1").select(
        "episode_id", F.when(F.col("k") % 2 == 0, many(7, F.col("k") % 4)).alias("token_ids"), F.when(F.col("k") % 3 == 0, many(-0.5, over(7) % 4)).alias("logprobs"),
        F.when(F.col("k") % 5 < 3, F.concat(many(1, ones), many(0, size - ones))).alias("mask"),
    )
    return assembly.capability_evidence(answers)


@query(f"with {_ARRAYS} select * from evidence")
def capability_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir)


_ELIGIBLE = f"""{TRACE}, {_RULED}, {_ARRAYS}, joined as (select c.*, e.token_evidence, e.logprob_evidence, e.mask_evidence, e.aligned, certification = 'CERTIFIED' as ok,
 coalesce(attested in ('PASSED', 'FAILED'), false) as trusted, c.episode_id % 2 = 0 and c.episode_id % 3 <> 0 and c.episode_id % 5 <> 0 as same from certified c left join evidence e on e.episode_id = c.episode_id),
 flagged as (select *, ok and task_status = 'SUCCESS' and validity = 'VALID' and trusted and verifier_status = 'PASSED' and requests > 0 and responses + calls > 0 as sft,
 ok and trusted and validity = 'VALID' as preference, coalesce(ok and token_evidence = 'EVIDENCE_PRESENT' and mask_evidence = 'EVIDENCE_PRESENT' and aligned = 'EVIDENCE_PRESENT'
 and score is not null and validity = 'VALID' and trusted, false) as fields from joined),
 eligible as (select *, fields and not same as off_policy, coalesce(fields and logprob_evidence = 'EVIDENCE_PRESENT' and same, false) as on_policy from flagged)"""


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("episode_id")
    policies = assembly.certify(_episodes(spark, sf_dir)).withColumns({"behavior_complete": e % 2 == 0, "target_complete": e % 3 != 0, "same_policy": e % 5 != 0})
    return assembly.eligibility(policies, _evidence(spark, sf_dir))


@query(f"""with {_ELIGIBLE} select episode_id, sft, preference, off_policy, on_policy, case when not ok then certification when on_policy then 'ON_POLICY_RL_ELIGIBLE'
 when off_policy then 'OFF_POLICY_RL_ELIGIBLE' when sft then 'SFT_ELIGIBLE' when preference then 'PREFERENCE_ELIGIBLE' else 'REJECTED' end as eligibility from eligible""")
def training_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eligible(spark, sf_dir).select("episode_id", "sft", "preference", "off_policy", "on_policy", "eligibility")


@query(f"""with {_ELIGIBLE} select episode_id, 'HARNESS_ANALYSIS' as profile, case when state = 'CORRUPT' then 'REJECTED' else 'ELIGIBLE' end as verdict from eligible
 union all select episode_id, 'EVALUATION', case when not ok then 'INSUFFICIENT_EVIDENCE' when validity <> 'VALID' then 'REJECTED' when not trusted then 'INSUFFICIENT_EVIDENCE' else 'ELIGIBLE' end from eligible
 union all select episode_id, 'SFT', case when sft then 'ELIGIBLE' when certification = 'INSUFFICIENT_EVIDENCE' then certification else 'REJECTED' end from eligible
 union all select episode_id, 'PREFERENCE', case when preference then 'ELIGIBLE' when certification = 'INSUFFICIENT_EVIDENCE' then certification else 'REJECTED' end from eligible
 union all select episode_id, 'OFF_POLICY_RL', case when off_policy then 'ELIGIBLE' when certification = 'INSUFFICIENT_EVIDENCE' then certification else 'REJECTED' end from eligible
 union all select episode_id, 'ON_POLICY_RL', case when on_policy then 'ELIGIBLE' when certification = 'INSUFFICIENT_EVIDENCE' then certification else 'REJECTED' end from eligible""")
def consumer_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.decisions(_eligible(spark, sf_dir))
