"""Registered queries on datasets, policies, failures, gates and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calls, ranks
from ..operators import release
from ..sources import tables
from .catalog import query

_MEMBERS = """select l_orderkey as episode, l_linenumber as line, ['ON_POLICY_RL', 'SFT', 'ON_POLICY_RL'][(l_partkey % 3)::int + 1] as profile, case when l_suppkey % 5 > 0 then 'ELIGIBLE' else 'REJECTED' end as verdict,
 case when l_partkey % 11 = 0 then -1 else l_orderkey end as decision_episode, case when l_suppkey % 7 > 0 then l_suppkey end as bundle, case when l_partkey % 13 = 0 then -1 else l_partkey end as decided_artifact,
 l_partkey as artifact, l_returnflag as split, l_linestatus as role from lineitem"""


@query(f"""select *, case when reason = '' then sha256(episode::varchar || '|' || artifact::varchar || '|' || split || '|' || role) end as member_id from (select *, case when verdict <> 'ELIGIBLE' then 'NOT_ELIGIBLE' when profile <> 'ON_POLICY_RL'
 then 'PROFILE_DIFFERS' when episode <> decision_episode then 'EPISODE_DIFFERS' when bundle is null then 'NOT_BOUND' when artifact <> decided_artifact then 'ARTIFACT_DIFFERS' else '' end as reason from ({_MEMBERS}))""")
def dataset_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rows = tables.read(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("episode"), c("l_linenumber").alias("line"), F.when(c("l_partkey") % 3 == 1, "SFT").otherwise("ON_POLICY_RL").alias("profile"), F.when(c("l_suppkey") % 5 > 0, "ELIGIBLE").otherwise("REJECTED").alias("verdict"),
        F.when(c("l_partkey") % 11 == 0, -1).otherwise(c("l_orderkey")).alias("decision_episode"), F.when(c("l_suppkey") % 7 > 0, c("l_suppkey")).alias("bundle"),
        F.when(c("l_partkey") % 13 == 0, -1).otherwise(c("l_partkey")).alias("decided_artifact"), c("l_partkey").alias("artifact"), c("l_returnflag").alias("split"), c("l_linestatus").alias("role"),
    )
    return release.compiled(rows, "ON_POLICY_RL")


@query("""select p_partkey as policy, concat_ws(',', case when p_size % 9 = 0 then 'adapter_revision' end, case when p_size % 7 = 0 then 'temperature' end, case when p_size % 5 = 0 then 'policy_generation' end) as missing,
 p_size % 9 > 0 and p_size % 7 > 0 and p_size % 5 > 0 and p_size % 4 < 2 as matches from part""")
def policy_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")

    def policy(other: bool) -> Column:
        changed = {"adapter_revision": F.when(size % 9 > 0, F.lit("a")), "policy_generation": F.when(size % 5 > 0, F.lit("g"))}
        numbers = {"temperature": F.when(size % 7 > 0, F.lit(0.7)), "top_p": F.lit(0.9)}
        if other:  # less than the tolerance, more, or another name
            numbers["top_p"] = numbers["top_p"] + F.when(size % 4 == 1, 5e-10).when(size % 4 == 2, 1e-6).otherwise(0.0)
            changed["adapter_revision"] = F.when(size % 4 == 3, F.lit("b")).otherwise(changed["adapter_revision"])
        fields = {f: F.lit(f) for f in release.POLICY_FIELDS} | changed | numbers
        return F.struct(*[fields[f].alias(f) for f in release.POLICY_FIELDS])

    both = tables.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("policy"), policy(False).alias("a"), policy(True).alias("b"))
    return both.select("policy", release.missing_fields(F.col("a")).alias("missing"), release.same_policy(F.col("a"), F.col("b")).alias("matches"))


@query("""select o_orderkey as episode, case when o_custkey % 10 = 0 then 'CAPTURE' when o_custkey % 7 = 0 then 'SANDBOX' when o_custkey % 3 = 0 and o_orderkey % 2 = 0 then 'HARNESS' else 'UNKNOWN' end as cause,
 case when o_custkey % 10 = 0 then 'INTEGRITY_CORRUPT' when o_custkey % 7 = 0 then 'INFRASTRUCTURE' when o_custkey % 3 = 0 and o_orderkey % 2 = 0 then 'TOOL_ERROR_FEEDBACK_LOSS' when o_custkey % 3 = 0 then 'OBSERVED_TOOL_ERROR_LOOP' else 'UNATTRIBUTED' end as code,
 case when o_custkey % 10 = 0 then 1.0::double when o_custkey % 7 = 0 then 0.9::double when o_custkey % 3 = 0 and o_orderkey % 2 = 0 then 0.8::double when o_custkey % 3 = 0 then 0.5::double else 0.0::double end as confidence from orders""")
def failure_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    episodes = tables.read(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("episode"), F.when(c("o_custkey") % 10 == 0, "CORRUPT").otherwise("COMPLETE").alias("state"), F.when(c("o_custkey") % 7 == 0, "SANDBOX").alias("infra_component"),
        F.when(c("o_custkey") % 3 == 0, 1).otherwise(0).alias("loops"), (c("o_orderkey") % 2 == 0).alias("decisions"),
    )
    return release.attributed(episodes).select("episode", "cause", "code", "confidence")


_SIDE = "select o_custkey as task, min(o_orderpriority) as slice, max((o_orderstatus = 'F')::int) as success, sum(o_orderkey % 100) as tokens, sum(o_orderkey % 17) as latency, sum((o_orderkey % 23 = 0)::int) as infra, sum(o_orderkey % 3) as loops from orders where o_orderkey % 2 = {} group by 1"


@query(f"""with b as ({_SIDE.format(0)}), c as ({_SIDE.format(1)}), p as (select coalesce(b.task, c.task) % 4 as slice, b.success as bs, c.success as cs, b.tokens as bt, c.tokens as ct, b.latency as bl, c.latency as cl, b.infra as bi, c.infra as ci, b.loops as bo, c.loops as co
 from b full join c on b.task = c.task), g as (select slice, count(*) as n, count(*) filter (bs is not null and cs is not null) as pairs, sum(bs) filter (w) as bs, sum(cs) filter (w) as cs, sum(bt) filter (w) as bt, sum(ct) filter (w) as ct, sum(bl) filter (w) as bl,
 sum(cl) filter (w) as cl, sum(bi) filter (w) as bi, sum(ci) filter (w) as ci, sum(bo) filter (w) as bo, sum(co) filter (w) as co, count(*) filter (w and bs > cs) as bad from (select *, bs is not null and cs is not null as w from p) group by 1),
 r as (select slice, n, pairs, coalesce(cs >= bs, false) as success_ok, coalesce(co < bo, false) as slice_ok, coalesce(ct <= bt * 1.2::double, false) as tokens_ok, coalesce(cl <= bl * 1.25::double, false) as latency_ok, coalesce(ci <= bi, false) as infra_ok, bad = 0 as no_regression from g)
 select *, case when pairs < 3 or pairs < n then 'INSUFFICIENT_EVIDENCE' when success_ok and slice_ok and tokens_ok and latency_ok and infra_ok and no_regression then 'ACCEPT' else 'REJECT' end as verdict from r""")
def release_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, orders = F.col("o_orderkey"), tables.read(spark, sf_dir, "orders")

    def side(odd: int, name: str) -> DataFrame:
        return orders.filter(key % 2 == odd).groupBy(F.col("o_custkey").alias("task")).agg(
            F.max((F.col("o_orderstatus") == "F").cast("int")).alias(f"{name}_success"), F.sum(key % 100).alias(f"{name}_tokens"), F.sum(key % 17).alias(f"{name}_latency"),
            F.sum((key % 23 == 0).cast("int")).alias(f"{name}_infra"), F.sum(key % 3).alias(f"{name}_loops"),
        )

    return release.gate(side(0, "b").join(side(1, "c"), "task", "full").withColumn("slice", F.col("task") % 4), "slice")


_TIMES = " + ".join(f"(u > {p})::int" for p in release.POISSON)


@query(f"""with d as (select o_orderpriority as slice, s, o_totalprice as v, ('0x' || substr(sha256(s::varchar || ':' || o_orderkey::varchar), 1, 8))::bigint / 4294967296.0::double as u from orders, (select unnest(range(0, 20)) as s)),
 m as (select slice, s, sum(v * ({_TIMES})) / nullif(sum({_TIMES}), 0) as m from d group by 1, 2), b as (select slice, round(quantile_cont(m, 0.025), 6) as low, round(quantile_cont(m, 0.975), 6) as high from m group by 1)
 select slice, count(*) as n, round(avg(o_totalprice), 6) as mean, any_value(low) as low, any_value(high) as high from orders join b on slice = o_orderpriority group by 1""")
def bootstrap_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("slice"), "o_orderkey", "o_totalprice")
    return release.bootstrap(rows, "slice", "o_orderkey", "o_totalprice")


@query("""select event_type, count(*) as n, round(avg(value), 6) as mean, round(quantile_cont(value, 0.95), 6) as p95, round(quantile_cont(value, 0.99), 6) as p99, max(value) as max from events group by 1""")
def ingest_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.timeline(spark, sf_dir).select("event_type", "value")
    per = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("max"))
    found = ranks.percentiles(rows, "event_type", "value", {"p95": 0.95, "p99": 0.99})
    return per.join(found, "event_type", "left").withColumns({c: F.round(c, 6) for c in ("p95", "p99")})


@query("""select doc_id from documents where doc_id % 7 <> 0 and doc_id % 4 = doc_id % 3 and doc_id % 4 > 0 and length(text) between 80 and 3500""")
def curriculum_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks without a function's name, with as many inputs as outputs and a question of fit length."""
    doc = F.col("doc_id")
    tasks = tables.read(spark, sf_dir, "documents").select(
        "doc_id", F.when(doc % 7 == 0, "f").otherwise("").alias("fn_name"), F.array_repeat(F.lit(1), (doc % 4).cast("int")).alias("inputs"), F.array_repeat(F.lit(1), (doc % 3).cast("int")).alias("outputs"), F.col("text").alias("question"),
    )
    fit = (F.col("fn_name") == "") & (F.size("inputs") == F.size("outputs")) & (F.size("inputs") > 0) & F.length("question").between(80, 3500)
    return tasks.filter(fit).select("doc_id")


@query("""select 'artifact-' || substr(sha256(coalesce(text, '')), 1, 20) as artifact_id, sha256(coalesce(text, '')) as sha256, strlen(coalesce(text, '')) as size_bytes, count(*) as puts from documents group by coalesce(text, '')""")
def artifact_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents by address: the same content is one artifact, however often it is put."""
    content = F.coalesce("text", F.lit(""))
    keyed = tables.read(spark, sf_dir, "documents").select(F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("size_bytes"))
    return keyed.groupBy("sha256", "size_bytes").agg(F.count("*").alias("puts")).select(F.concat(F.lit("artifact-"), F.substring("sha256", 1, 20)).alias("artifact_id"), "sha256", "size_bytes", "puts")


_SAID = (
    '<tool_call>{"name": "ls", "arguments": {"path": "a b"}}</tool_call> and {"name": "read", "arguments": {"n": 1}}', '{"name": "ls", "arguments": {}} {"name": "rm", "arguments": {"x": 1}}',
    'text { broken {"name": "read", "arguments": {"q": {"name": "ls", "arguments": {"z": "}"}}}}', '<tool_call>{"name": "ls"</tool_call>', "none",
)
_FOUND = ("ls {\"path\":\"a b\"};read {\"n\":1}", "", "read {\"q\":{\"name\":\"ls\",\"arguments\":{\"z\":\"}\"}}};ls {\"z\":\"}\"}", "", "")


@query(f"""select doc_id, [{', '.join(repr(x) for x in _FOUND)}][(doc_id % {len(_FOUND)})::int + 1] as calls from documents""")
def text_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls after the texts of documents, which have braces of their own but no calls."""
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), F.element_at(F.array(*[F.lit(x) for x in _SAID]), (F.col("doc_id") % len(_SAID)).cast("int") + 1))
    found = tables.read(spark, sf_dir, "documents").select("doc_id", calls.tool_calls(said, ("ls", "read")).alias("c"))
    return found.select("doc_id", F.array_join(F.transform("c", lambda x: F.concat_ws(" ", x["name"], x["arguments"])), ";").alias("calls"))
