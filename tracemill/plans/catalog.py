"""The registered queries, each with its SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import canonical, ranks
from ..operators import actions, groups, reports, rules, sequences
from ..sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

KINDS = ("click", "error", "purchase", "refund", "signup", "view")
LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LINE_SQL = ", ".join(LINE)
_TIMELINE = "row_number() over (partition by user_id order by ts, event_id)"


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# ---- episodes as sequences


_INTEGRITY = """select l_orderkey as episode, case when count(*) > count(distinct l_linenumber) then 'CORRUPT'
 when max(l_linenumber) > count(distinct l_linenumber) then 'PARTIAL' else 'COMPLETE' end as state,
 count(*) as n_events, count(distinct l_linenumber) as n_distinct_seq, max(l_linenumber) - count(distinct l_linenumber) as n_gaps
 from lineitem group by l_orderkey"""


@query(_INTEGRITY)
def episode_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.integrity(tables.event_log(spark, sf_dir), first=1)


@query(f"select state, count(*) as episodes from ({_INTEGRITY}) group by state")
def episode_integrity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episode_integrity(spark, sf_dir).groupBy("state").agg(F.count("*").alias("episodes"))


@query("""select e.episode, g.n as gap_seq from (select l_orderkey as episode, max(l_linenumber) as last from lineitem group by 1) e,
 lateral (select unnest(range(1, e.last + 1)) as n) g
 where not exists (select 1 from lineitem l where l.l_orderkey = e.episode and l.l_linenumber = g.n)""")
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.gaps(tables.event_log(spark, sf_dir), first=1)


@query("select l_orderkey as episode, l_linenumber as seq, count(*) as copies from lineitem group by 1, 2 having count(*) > 1")
def sequence_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.collisions(tables.event_log(spark, sf_dir))


_CLASSIFIED = f"""select case when n = 1 then 'APPENDED' when content = first then 'DUPLICATE' else 'CONFLICT' end as status from (
 select row_number() over w as n, row({_LINE_SQL}) as content, first_value(row({_LINE_SQL})) over w as first
 from lineitem window w as (partition by l_orderkey, l_linenumber order by {_LINE_SQL}))"""


@query(f"select status, count(*) as n from ({_CLASSIFIED}) group by status")
def ingest_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.event_log(spark, sf_dir)
    return sequences.classified(log, ["episode", "seq"], [F.col(c) for c in LINE]).groupBy("status").agg(F.count("*").alias("n"))


@query(f"""select l_orderkey as episode, count(*) as events, round(sum(l_quantity), 2) as quantity from (
 select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(c + ' desc' for c in LINE)}) as n from lineitem)
 where n = 1 group by 1""")
def compact_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = sequences.compacted(tables.event_log(spark, sf_dir), ["episode", "seq"], LINE)
    return last.groupBy("episode").agg(F.count("*").alias("events"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("""select l_orderkey as episode, count(*) as n_events, sha256(string_agg(l_linenumber::varchar, ',' order by l_linenumber)) as ids_sha256
 from lineitem group by 1""")
def partition_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.manifest(tables.event_log(spark, sf_dir))


@query("select o_orderkey as episode from orders where o_orderkey not in (select l_orderkey from lineitem)")
def context_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.event_log(spark, sf_dir).select("episode")
    return tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode")).join(log, "episode", "left_anti")


@query(f"""select user_id, event_id, n + max(clock - n) over (partition by user_id order by n rows unbounded preceding) as repaired from (
 select user_id, event_id, cast(floor(value * 10) as bigint) as clock, {_TIMELINE} as n from events)""")
def monotonic_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.timeline(spark, sf_dir).withColumn("clock", F.floor(F.col("value") * 10).cast("long"))
    return sequences.monotonic(rows, "user_id", actions.ORDER, "clock").select("user_id", "event_id", "repaired")


# ---- timelines


@query("""select user_id, sum(c - 1)::bigint as repeats from (select user_id, props, count(*) as c from events where event_type = 'view' group by 1, 2) group by 1""")
def redundant_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.repeats(tables.timeline(spark, sf_dir), "view")


@query("""select user_id, sum(c - 1)::bigint as repeats from (select user_id, props, count(*) as c from events where event_type = 'error' group by 1, 2) group by 1""")
def repeated_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.repeats(tables.timeline(spark, sf_dir), "error")


@query("""select user_id, (epoch_us(min(ts) filter (event_type = 'purchase')) - epoch_us(min(ts))) // 1000 as ms from events group by 1""")
def time_to_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.time_to(tables.timeline(spark, sf_dir), "purchase")


def _roles_sql(patch: str) -> str:
    return f"""select role, count(*) as n from (select case when n = 1 then 'first-action' when n = last then 'final-answer' {patch}
 when before = 'error' then 'failure-recovery' else 'tool-selection' end as role from (
 select event_type, {_TIMELINE} as n, count(*) over (partition by user_id) as last,
 lag(event_type) over (partition by user_id order by ts, event_id) as before from events)) group by role"""


@query(_roles_sql("when event_type = 'purchase' then 'patch'"))
def decision_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.roles(tables.timeline(spark, sf_dir)).groupBy("role").agg(F.count("*").alias("n"))


@query(_roles_sql(""))
def decision_roles_exporter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.roles(tables.timeline(spark, sf_dir), patch=None).groupBy("role").agg(F.count("*").alias("n"))


@query(f"""select role, count(*) as examples, count(distinct user_id) as episodes, round(sum(value), 2) as tokens from (
 select user_id, value, case when n = 1 then 'first-action' when n = last then 'final-answer' when event_type = 'purchase' then 'patch'
 when before = 'error' then 'failure-recovery' else 'tool-selection' end as role from (
 select user_id, value, event_type, {_TIMELINE} as n, count(*) over (partition by user_id) as last,
 lag(event_type) over (partition by user_id order by ts, event_id) as before from events)) group by role""")
def role_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = actions.roles(tables.timeline(spark, sf_dir))
    return ruled.groupBy("role").agg(F.count("*").alias("examples"), F.countDistinct("user_id").alias("episodes"), F.round(F.sum("value"), 2).alias("tokens"))


@query("""select old, new, count(*) as n from (select lag(event_type) over (partition by user_id order by ts, event_id) as old, event_type as new from events)
 where old is not null group by 1, 2""")
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.transitions(tables.timeline(spark, sf_dir))


@query("""select user_id, coalesce(sum(d), 0)::bigint as dup_count, round(coalesce(sum(d), 0) / count(*), 6) as dup_rate from (
 select user_id, (lag(event_type) over (partition by user_id order by ts, event_id) = event_type)::int as d from events) group by 1""")
def adjacent_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.adjacent(tables.timeline(spark, sf_dir))


@query(f"""select user_id, count(*) filter (c >= 2) as loop_count from (select user_id, event_type, island, count(*) as c from (
 select user_id, event_type, {_TIMELINE} - row_number() over (partition by user_id, event_type order by ts, event_id) as island from events)
 group by 1, 2, 3) group by 1""")
def loop_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.loops(tables.timeline(spark, sf_dir))


@query("""select user_id, round(coalesce(count(*) filter (event_type = 'error' and exists (select 1 from events l where l.user_id = e.user_id and l.event_type <> 'error' and (l.ts, l.event_id) > (e.ts, e.event_id)))
 / nullif(count(*) filter (event_type = 'error'), 0), 0), 6) as rate from events e group by 1""")
def error_recovery_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.recovery(tables.timeline(spark, sf_dir))


@query("""select user_id, arg_max(event_id, (ts, event_id)) filter (event_type = 'purchase') as last_event_id,
 count(*) filter (event_type = 'purchase') as n_terminal from events group by 1""")
def terminal_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.terminal(tables.timeline(spark, sf_dir))


@query("""select user_id, arg_max(case event_type when 'purchase' then 'PASSED' else 'FAILED' end, (ts, event_id)) filter (event_type in ('purchase', 'error')) as verdict
 from events group by 1""")
def latest_attestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.attested(tables.timeline(spark, sf_dir))


@query("""select u.user_id, count(o.props) as n_unclosed from (select distinct user_id from events) u left join (
 select distinct user_id, props from events v where event_type = 'view' and not exists (
 select 1 from events c where c.event_type = 'click' and c.user_id = v.user_id and c.props = v.props)) o on o.user_id = u.user_id group by 1""")
def span_unclosed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.unclosed(tables.timeline(spark, sf_dir))


@query("""select user_id, coalesce(sum(calls) filter (results > 0), 0)::bigint as matched, coalesce(sum(calls) filter (results = 0), 0)::bigint as unmatched from (
 select user_id, props, count(*) filter (event_type = 'click') as calls, count(*) filter (event_type = 'purchase') as results from events group by 1, 2) group by 1""")
def tool_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.paired(tables.timeline(spark, sf_dir))


@query("""select u.user_id, coalesce(string_agg(r.k, ',' order by r.k) filter (e.user_id is null), '') as missing
 from (select distinct user_id from events) u cross join (values ('click'), ('error'), ('refund'), ('view')) r(k)
 left join (select distinct user_id, event_type from events) e on e.user_id = u.user_id and e.event_type = r.k group by 1""")
def missing_capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.lacking(tables.timeline(spark, sf_dir), ("click", "error", "refund", "view"))


@query("""select user_id, event_id, sha256(replace(replace(props, ': ', ':'), ', ', ',')) as signature from events""")
def action_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.timeline(spark, sf_dir).select("user_id", "event_id", canonical.sha256_json(F.col("props")).alias("signature"))


# ---- rewarded groups and datasets


@query("""select g as "group", episode, line, r as reward, round(case when sd > 1e-6 then (r - m) / (sd + 1e-6) else 0 end, 6) as advantage from (
 select l_orderkey as g, l_partkey as episode, l_linenumber as line, case when l_returnflag = 'R' then 1.0::double else 0.0::double end as r,
 avg(case when l_returnflag = 'R' then 1.0::double else 0.0::double end) over (partition by l_orderkey) as m,
 stddev_pop(case when l_returnflag = 'R' then 1.0::double else 0.0::double end) over (partition by l_orderkey) as sd from lineitem)""")
def grpo_advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.advantages(_attempts(spark, sf_dir))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reward = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    return tables.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("group"), F.col("l_partkey").alias("episode"), F.col("l_linenumber").alias("line"), reward.alias("reward"))


@query("""select l_orderkey as "group", count(distinct l_partkey) as size, count(distinct l_returnflag = 'R') as distinct_rewards,
 count(distinct l_partkey) >= 4 and count(distinct l_returnflag = 'R') >= 2 as admitted from lineitem group by 1""")
def group_variance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.gate(_attempts(spark, sf_dir))


@query("""select o_custkey as task, count(distinct o_orderstatus) as n_splits from orders group by 1 having count(distinct o_orderstatus) > 1""")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.leaks(tables.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("task"), F.col("o_orderstatus").alias("split")))


@query("""select "group", reason = '' as valid, reason from (select o_custkey as "group", case when count(*) filter (o_orderstatus = 'F') = 0 then 'no chosen'
 when count(*) filter (o_orderstatus = 'O') = 0 then 'no rejected'
 when count(*) filter (o_orderstatus = 'F') > 1 or count(*) filter (o_orderstatus = 'O') > 1 then 'not a pair'
 when count(*) > 2 then 'other roles' else '' end as reason from orders group by 1)""")
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("o_orderstatus") == "F", "CHOSEN").when(F.col("o_orderstatus") == "O", "REJECTED").otherwise("OTHER")
    return groups.preferences(tables.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("group"), role.alias("role")))


@query("""select p_type as stratum, p_partkey, n as rank from (select p_type, p_partkey, row_number() over (partition by p_type order by sha256('7:' || p_partkey::varchar)) as n from part)
 where n <= 5""")
def stratified_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.picked(tables.read(spark, sf_dir, "part"), "p_type", "p_partkey", 5, "7:").select(F.col("p_type").alias("stratum"), "p_partkey", "rank")


_SCORE = "p_size * 1000000 + least(length(p_name), 999999)"


@query(f"""select p_brand, p_partkey, score from (select p_brand, p_partkey, {_SCORE} as score,
 row_number() over (partition by p_brand order by {_SCORE} desc, p_partkey) as n from part) where n = 1 order by score desc, p_partkey limit 10""")
def topk_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("p_size").cast("long") * 1_000_000 + F.least(F.length("p_name"), F.lit(999_999))
    best = tables.read(spark, sf_dir, "part").groupBy("p_brand").agg(F.max(F.struct(score.alias("score"), (-F.col("p_partkey")).alias("k"))).alias("b"))
    top = best.select("p_brand", (-F.col("b.k")).alias("p_partkey"), F.col("b.score").alias("score"))
    return top.orderBy(F.col("score").desc(), "p_partkey").limit(10)


@query("""select p_partkey, p_type from part where p_size > 0 and p_size % 2 = 0 and length(p_name) between 8 and 12""")
def curriculum_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part")
    return part.filter((F.col("p_size") > 0) & (F.col("p_size") % 2 == 0) & F.length("p_name").between(8, 12)).select("p_partkey", "p_type")


# ---- decisions


#: What a line item stands for in the matrices of rules: values of each input by digits of a number of its own.
_K = "l_partkey * 31 + l_suppkey * 7 + l_linenumber"
_INPUTS: dict[str, tuple[int, tuple]] = {
    "integrity": (1, schemas.INTEGRITY), "attested": (3, (*schemas.ATTESTED, None)), "task": (15, schemas.TASK_STATUS), "validity": (45, schemas.VALIDITY), "scored": (135, (True, False)),
}
_AXES = list(_INPUTS)


def _picked(inputs: dict[str, tuple[int, tuple]], k: str) -> str:
    said = lambda v: "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower()
    return ", ".join(f"[{', '.join(map(said, values))}][(({k}) // {n} % {len(values)})::int + 1] as {name}" for name, (n, values) in inputs.items())


def _matrix(rows: DataFrame, inputs: dict[str, tuple[int, tuple]], k: str) -> DataFrame:
    """How many rows there are of every combination of a rule's inputs."""
    pick = lambda n, values: F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(f"int(({k}) div {n} % {len(values)})") + 1)
    return rows.select(*[pick(n, values).alias(name) for name, (n, values) in inputs.items()]).groupBy(*inputs).agg(F.count("*").alias("n"))


_CERTIFIED = f"""select *, case when integrity = 'CORRUPT' or (attested = 'PASSED' and (task <> 'SUCCESS' or validity <> 'VALID'))
 or (attested = 'FAILED' and (task = 'SUCCESS' or validity <> 'VALID')) or (attested in ('ERROR', 'TIMEOUT') and (task = 'SUCCESS' or scored)) then 'REJECTED'
 when integrity = 'PARTIAL' or (attested is null and task = 'SUCCESS' and validity = 'VALID') then 'INSUFFICIENT_EVIDENCE' else 'CERTIFIED' end as status
 from (select {', '.join(_AXES)}, count(*) as n from (select {_picked(_INPUTS, _K)} from lineitem) group by all)"""


@query(_CERTIFIED)
def certify_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = rules.certification(*[F.col(c) for c in _AXES])
    return _matrix(tables.read(spark, sf_dir, "lineitem"), _INPUTS, _K).withColumn("status", status)


@query(f"""select integrity, attested, task, validity, scored, n, coalesce(status = 'CERTIFIED' and attested = 'PASSED' and task = 'SUCCESS' and validity = 'VALID', false) as sft
 from ({_CERTIFIED})""")
def eligibility_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = certify_matrix(spark, sf_dir)
    return ruled.select(*_AXES, "n", rules.sft_eligible(F.col("status"), F.col("attested"), F.col("task"), F.col("validity"), F.lit(True)).alias("sft"))


_RECOVERY: dict[str, tuple[int, tuple]] = {
    "code": (1, ("FILE_NOT_FOUND", "TIMEOUT", None, "FILE_NOT_FOUND")), "path": (4, ("a/b.py", None)), "cached": (8, (True, False)), "candidates": (16, (0, 1, 2)), "budget": (48, (0, 1)),
}


@query(f"""select code, path, cached, candidates, budget, n, case when code is distinct from 'FILE_NOT_FOUND' then 'NO_ACTION' when path is null then 'TERMINATE'
 when not cached and budget <= 0 then 'TERMINATE' when not cached then 'DISCOVER' when candidates = 1 then 'READ' else 'TERMINATE' end as action
 from (select {', '.join(_RECOVERY)}, count(*) as n from (select {_picked(_RECOVERY, "event_id")} from events) group by all)""")
def recovery_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _matrix(tables.read(spark, sf_dir, "events"), _RECOVERY, "event_id")
    return every.withColumn("action", rules.recovery_action(*[F.col(c) for c in _RECOVERY]))


# ---- reports


@query("""select 'artifacts' as metric, count(*) as value from documents union all select 'duplicates', count(*) - count(distinct text) from documents
 union all select 'eligible', count(*) from labels where quality = 1 and toxic = 0 union all select 'rejected', count(*) from labels where not (quality = 1 and toxic = 0)
 union all select 'reason_low_quality', count(*) from labels where quality = 0 union all select 'reason_toxic', count(*) from labels where quality = 1 and toxic = 1
 union all select 'orphan_decisions', count(*) from labels where doc_id not in (select doc_id from documents)
 union all select 'undecided', count(*) from documents where doc_id not in (select doc_id from labels)""")
def data_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_report(tables.read(spark, sf_dir, "documents").select("doc_id", "text"), tables.decisions(spark, sf_dir))


@query("""select k as event_type, count(event_id) as n from (values ('click'), ('error'), ('purchase'), ('refund'), ('signup'), ('view')) v(k)
 left join events on event_type = k group by 1""")
def capability_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counted(tables.timeline(spark, sf_dir), "event_type", KINDS)


@query("select sha256(text) as sha256, count(*) as copies from documents group by text having count(*) > 1")
def duplicate_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count("*").alias("copies")).filter("copies > 1")


@query("""select doc_id from labels where doc_id not in (select doc_id from documents)""")
def orphan_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "labels").select("doc_id").join(tables.read(spark, sf_dir, "documents").select("doc_id"), "doc_id", "left_anti")


@query("""select l_linestatus as policy, count(*) as attempts, count(*) filter (l_returnflag <> 'N') as valid, count(*) filter (l_returnflag = 'R') as resolved,
 round(count(*) filter (l_returnflag = 'R') / nullif(count(*) filter (l_returnflag <> 'N'), 0), 6) as rate from lineitem group by 1""")
def solve_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.read(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("policy"), "l_returnflag")
    return reports.rates(lines, "policy", F.col("l_returnflag") != "N", F.col("l_returnflag") == "R")


_LATENCY = "select o_orderpriority as p, date_diff('day', o_orderdate, l_shipdate) as d from lineitem join orders on l_orderkey = o_orderkey"


@query(f"""select p as "group", list_sort(list(d))[greatest(1, (count(*) * 50) // 100)] as p50, list_sort(list(d))[greatest(1, (count(*) * 95) // 100)] as p95 from ({_LATENCY}) group by 1""")
def latency_floor_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A group's values are counted, not collected: the few distinct days with running counts hold the ranks.
    from pyspark.sql import Window

    counts = _latencies(spark, sf_dir).groupBy("group", "d").count()
    w = Window.partitionBy("group")
    ranked = counts.withColumn("upto", F.sum("count").over(w.orderBy("d"))).withColumn("n", F.sum("count").over(w))

    def at(percent: int):
        return F.min(F.when(F.col("upto") >= F.greatest(F.lit(1), F.floor(F.col("n") * percent / 100)), F.col("d")))

    return ranked.groupBy("group").agg(at(50).alias("p50"), at(95).alias("p95"))


def _latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = tables.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    days = F.datediff("l_shipdate", "o_orderdate").cast("long")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderpriority").alias("group"), days.alias("d"))


@query(f"""select p as "group", round(quantile_cont(d, 0.5), 6) as p50, round(quantile_cont(d, 0.95), 6) as p95, round(quantile_cont(d, 0.99), 6) as p99 from ({_LATENCY}) group by 1""")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranks.percentiles(_latencies(spark, sf_dir), "group", "d", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return found.withColumns({c: F.round(c, 6) for c in ("p50", "p95", "p99")})


@query("""select o_orderpriority as pair, round(avg(o_totalprice) filter (o_custkey % 2 = 1) - avg(o_totalprice) filter (o_custkey % 2 = 0), 4) as delta,
 round(avg(o_totalprice) filter (o_custkey % 2 = 1) / avg(o_totalprice) filter (o_custkey % 2 = 0), 6) as ratio from orders group by 1""")
def paired_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("o_custkey") % 2 == 1
    a, b = F.avg(F.when(odd, F.col("o_totalprice"))), F.avg(F.when(~odd, F.col("o_totalprice")))
    return tables.read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("pair")).agg(F.round(a - b, 4).alias("delta"), F.round(a / b, 6).alias("ratio"))


@query("""select stratum, base, candidate, case when least(nb, nc) < 3 then 'INCONCLUSIVE' when candidate > base then 'ACCEPT' else 'REJECT' end as verdict from (
 select o_orderpriority as stratum, count(*) filter (o_custkey % 2 = 0) as nb, count(*) filter (o_custkey % 2 = 1) as nc,
 round(avg((o_orderstatus = 'F')::int) filter (o_custkey % 2 = 0), 6) as base, round(avg((o_orderstatus = 'F')::int) filter (o_custkey % 2 = 1), 6) as candidate from orders group by 1)""")
def regression_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd, solved = F.col("o_custkey") % 2 == 1, (F.col("o_orderstatus") == "F").cast("int")
    per = tables.read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("stratum")).agg(
        F.count(F.when(~odd, 1)).alias("nb"), F.count(F.when(odd, 1)).alias("nc"),
        F.round(F.avg(F.when(~odd, solved)), 6).alias("base"), F.round(F.avg(F.when(odd, solved)), 6).alias("candidate"),
    )
    verdict = reports.regression_gate(F.col("candidate"), F.col("base"), F.least("nb", "nc"))
    return per.select("stratum", "base", "candidate", verdict.alias("verdict"))


_SNAPSHOT = "select l_partkey as k, round(sum(l_quantity), 2) as v from lineitem where l_shipdate {} timestamp '1999-01-01' group by 1"


@query(f"""select case when b.k is null then 'ADDED' when a.k is null then 'DELETED' when a.v <> b.v then 'MODIFIED' else 'SAME' end as change, count(*) as n
 from ({_SNAPSHOT.format('<')}) b full join ({_SNAPSHOT.format('>=')}) a on a.k = b.k group by 1""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, cut = tables.read(spark, sf_dir, "lineitem"), F.lit("1999-01-01").cast("timestamp")
    total = F.round(F.sum("l_quantity"), 2).alias("v")
    before, after = (lines.filter(p).groupBy(F.col("l_partkey").alias("k")).agg(total) for p in (F.col("l_shipdate") < cut, F.col("l_shipdate") >= cut))
    return reports.changes(before, after, "k", "v")


@query("""select user_id, count(*) as n, round(sum(value) filter (event_type = 'purchase'), 4) as goodput,
 round(sum(value) filter (event_type = 'purchase') / nullif(sum(value), 0), 6) as share from events group by 1""")
def goodput(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.sum(F.when(F.col("event_type") == "purchase", F.col("value")))
    return tables.timeline(spark, sf_dir).groupBy("user_id").agg(
        F.count("*").alias("n"), F.round(good, 4).alias("goodput"), F.round(F.try_divide(good, F.sum("value")), 6).alias("share")
    )


# ---- texts


@query("""select conv_id, turn, sum(w) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding)::bigint as prompt_tokens, w as tokens
 from (select conv_id, turn, len(list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '')) as w from conversations)""")
def history_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", canonical.token_count(F.col("text")).cast("long").alias("tokens"))
    return turns.select("conv_id", "turn", F.sum("tokens").over(before).alias("prompt_tokens"), "tokens")


_MARKED = " or ".join(f"contains(text, '{m}')" for m in canonical.HOST_MARKERS)


@query(f"""select doc_id, {" || ".join(f"case when contains(text, '{m}') then ' {m}' else '' end" for m in canonical.HOST_MARKERS)} as markers from (select doc_id, case doc_id % 5 when 0 then text || ' /home/u/x'
 when 1 then text || ' /tmp/y /root/z' when 2 then text || ' $WORKSPACE/tmp /home/u' else text end as text from documents) where ({_MARKED}) and not contains(text, '$WORKSPACE')""")
def leak_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a host path, of documents some of which have one put in."""
    d, text = F.col("doc_id") % 5, F.col("text")
    some = F.when(d == 0, F.concat(text, F.lit(" /home/u/x"))).when(d == 1, F.concat(text, F.lit(" /tmp/y /root/z"))).when(d == 2, F.concat(text, F.lit(" $WORKSPACE/tmp /home/u"))).otherwise(text)
    placed = tables.read(spark, sf_dir, "documents").select("doc_id", some.alias("text"))
    return placed.select("doc_id", canonical.host_markers(F.col("text")).alias("markers")).filter("markers <> ''")


@query("""select page_id, len(regexp_extract_all(html, 'https?://[a-z0-9.]+')) as n, sha256(regexp_replace(html, 'href="/[^"]*"', 'href="$ROOT"', 'g')) as replaced_sha256 from pages""")
def path_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return tables.read(spark, sf_dir, "pages").select(
        "page_id", F.regexp_count(html, F.lit("https?://[a-z0-9.]+")).cast("long").alias("n"),
        F.sha2(F.regexp_replace(html, 'href="/[^"]*"', 'href="\\$ROOT"'), 256).alias("replaced_sha256"),
    )


def _shared(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; a local session may use one of its own."""
    import tempfile
    import uuid

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(base or tempfile.mkdtemp(prefix='tracemill-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(f"""with r as (select *, dense_rank() over (partition by l_orderkey, l_linenumber order by {_LINE_SQL}) as content, count(*) over (partition by l_orderkey, l_linenumber, {_LINE_SQL}) as n from lineitem)
 select count(*) filter (content = 1 and c = 1) as appended, 2 * coalesce(sum(n) filter (content = 1 and c = 1), 0)::bigint - count(*) filter (content = 1 and c = 1) as duplicates,
 2 * coalesce(sum(n) filter (content > 1 and c = 1), 0)::bigint as conflicts from (select *, row_number() over (partition by l_orderkey, l_linenumber, {_LINE_SQL} order by n) as c from r)""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items taken by a stream twice over into a store of its own: what was appended, repeated and in conflict."""
    from ..streaming.ingest import ingest_batch

    store = _shared(spark, "ingest")
    log = tables.read(spark, sf_dir, "lineitem").withColumn("id", F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    source = spark.readStream.schema(tables.read(spark, sf_dir, "lineitem").schema).parquet(f"{sf_dir}/lineitem.parquet*")
    stream = source.withColumn("id", F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    started = stream.writeStream.foreachBatch(lambda batch, number: ingest_batch(batch, store, "id", LINE, number)).option("checkpointLocation", f"{store}/progress").trigger(availableNow=True).start()
    started.awaitTermination()
    ingest_batch(log, store, "id", LINE, 1_000_000)
    return spark.read.parquet(f"{store}/counts/*").agg(*[F.sum(c).alias(c) for c in ("appended", "duplicates", "conflicts")])


@query(f"""select l_orderkey % 7 as run, l_orderkey as episode, count(*) as events, round(sum(l_quantity), 2) as quantity from lineitem where l_orderkey % 7 = 3 group by 1, 2""")
def partition_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written by run and read back for one run: only its folders are listed and read."""
    from ..sources import store

    log = tables.event_log(spark, sf_dir).withColumn("run", F.col("episode") % 7)
    path = _shared(spark, "store")
    store.write(log, path, "run", "episode")
    return store.read_run(spark, path, 3).groupBy("run", "episode").agg(F.count("*").alias("events"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("""select code, count(*) as n from (select event_id, case event_id % 9 when 1 then 'MALFORMED_EVENT' when 2 then 'UNKNOWN_FIELD' when 3 then 'MISSING_FIELD' when 4 then 'BLANK_SPAN_ID' when 5 then 'BAD_SEQUENCE'
 when 6 then 'TIMESTAMP_NOT_UTC' when 7 then 'UNKNOWN_STATUS' when 8 then 'REPEATED_ARTIFACT_REF' else 'EVENT' end as code from events) group by 1""")
def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines, eight of nine with a fault, and read back strictly."""
    from ..sources import jsonl

    n, text = F.col("event_id") % 9, lambda c: F.col(c).cast("string")
    good = F.struct(
        F.lit(schemas.SCHEMA_VERSION).alias("schema_version"), text("event_id").alias("event_id"), F.lit("run").alias("run_id"), text("user_id").alias("episode_id"), text("user_id").alias("trace_id"),
        F.when(n == 4, F.lit(" ")).otherwise(text("event_id")).alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"), F.when(n == 5, F.lit(-1)).otherwise(F.lit(3)).alias("sequence"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(n == 6, "+02:00").otherwise("Z")).alias("timestamp"), F.lit("TOOL_CALL").alias("event_type"), F.lit("TOOL").alias("component"),
        F.when(n == 7, "DONE").otherwise("STARTED").alias("status"), F.lit(1).alias("attempt"), F.struct("value").alias("attributes"),
        F.when(n == 8, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"))).alias("artifact_refs"),
    )
    json = F.to_json(good, {"ignoreNullFields": "false"})
    line = F.when(n == 1, F.substring(json, 1, 40)).when(n == 2, F.regexp_replace(json, r"^\{", '{"extra":1,')).when(n == 3, F.regexp_replace(json, '"attempt":1,', "")).otherwise(json)
    path = _shared(spark, "log")
    tables.read(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    events, issues = jsonl.read_events(spark, path)
    return events.select(F.lit("EVENT").alias("code")).unionAll(issues.select("code")).groupBy("code").agg(F.count("*").alias("n"))


from . import agents, capture, evidence, exports, generations, pairing, recovery, release, streams, training, workspace  # noqa: E402,F401  (they register their queries)
