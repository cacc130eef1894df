"""Queries on episodes of several agents, drawn from orders and line items: an order is an episode, a line number an agent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import agents
from ..sources import tables
from .catalog import query


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.read(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("episode"), F.col("l_linenumber").cast("long").alias("agent")).agg((F.min("l_suppkey") % 2).alias("policy"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five relations a line."""
    lines, n = tables.read(spark, sf_dir, "lineitem"), F.col("l_linenumber").cast("long")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    said = F.when(F.col("l_quantity") > 1, F.concat(F.lit("e"), part.cast("string")))
    one = lambda kind, source, target, when: F.when(when, F.struct(F.lit(kind).alias("kind"), source.cast("string").alias("source"), target.cast("string").alias("target"), said.alias("evidence")))
    parent = F.when(part % 16 == 1, 1 + supplier % 7).otherwise(n - 1)
    every = F.array(
        one(agents.PARENT, parent, n, (part % 40 != 0) & (parent > 0)), one(agents.MESSAGE, n, F.lit(1), supplier % 3 != 0), one(agents.TOOL, n, F.concat(F.lit("tool-"), (part % 50).cast("string")), F.col("l_linestatus") == "F"),
        one(agents.REWARD, n, F.lit("reward"), F.col("l_discount") >= 0.05), one(agents.CREDIT, F.when(part % 16 == 2, 1 + part % 7).otherwise(n - 1), n, (n > 1) & (F.col("l_tax") > 0.02)),
    )
    return lines.select(F.col("l_orderkey").alias("episode"), F.explode(F.array_compact(every)).alias("r")).select("episode", "r.*")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("o_custkey")
    held = F.array_compact(F.array(F.when(customer % 3 > 0, F.lit("MODEL_TOKEN_IDS")), F.when(customer % 4 > 0, F.lit("MODEL_LOGPROBS"))))
    return tables.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("episode"), F.when(customer % 11 > 0, "COMPLETE").otherwise("PARTIAL").alias("integrity"), F.when(customer % 7 > 0, "VALID").otherwise("UNKNOWN").alias("validity"),
        F.when(F.col("o_orderstatus") != "P", "SUCCESS").otherwise("FAILURE").alias("task_status"), (customer % 2).cast("string").alias("target_policy"), held.alias("capabilities"),
    )


_GRAPH = """recursive a as (select l_orderkey as episode, l_linenumber::bigint as agent, min(l_suppkey) % 2 as policy from lineitem group by 1, 2),
 l as (select l_orderkey as episode, l_linenumber::bigint as n, l_partkey as p, l_suppkey as s, l_quantity > 1 as proof, l_linestatus, l_discount, l_tax from lineitem),
 parent as (select distinct episode, case when p % 16 = 1 then 1 + s % 7 else n - 1 end as up, n as agent from l where p % 40 <> 0 and case when p % 16 = 1 then 1 + s % 7 else n - 1 end > 0),
 credit as (select distinct episode, case when p % 16 = 2 then 1 + p % 7 else n - 1 end as up, n as agent from l where n > 1 and l_tax > 0.02),
 edge as (select 'parent' as kind, * from parent union all select 'credit', * from credit),
 single as (select kind, e.episode, e.agent, count(*) > 1 as several, max(k.agent is null) as strange, max(up) as one from edge e left join a k on k.episode = e.episode and k.agent = e.up group by all),
 up as (select k.kind, a.episode, a.agent, case when not several and not strange then one end as up from a cross join (values ('parent'), ('credit')) k(kind) left join single s on s.kind = k.kind and s.episode = a.episode and s.agent = a.agent),
 climb as (select kind, episode, agent, agent as at, 0 as depth from up union all select c.kind, c.episode, c.agent, u.up, depth + 1 from climb c join up u on u.kind = c.kind and u.episode = c.episode and u.agent = c.at where u.up is not null and depth < 8),
 top as (select c.kind, c.episode, c.agent, c.at as root, c.depth from climb c join up u on u.kind = c.kind and u.episode = c.episode and u.agent = c.at where u.up is null),
 wrong as (select kind, episode, max(several or strange) as wrong from single group by 1, 2),
 own as (select a.*, t.root, t.depth, c.root as credit_root, c.depth is null as credit_cyclic, exists (select 1 from l where l.episode = a.episode and l.n = a.agent and s % 3 <> 0) as sends,
  a.agent = 1 and exists (select 1 from l where l.episode = a.episode and s % 3 <> 0) as receives, exists (select 1 from l where l.episode = a.episode and l.n = a.agent and l_linestatus = 'F') as tools,
  exists (select 1 from l where l.episode = a.episode and l.n = a.agent and l_discount >= 0.05 and proof) as rewarded from a left join top t on t.kind = 'parent' and t.episode = a.episode and t.agent = a.agent left join top c on c.kind = 'credit' and c.episode = a.episode and c.agent = a.agent),
 paid as (select o.*, coalesce(r.rewarded, false) as credited from own o left join own r on r.episode = o.episode and r.agent = o.credit_root),
 g as (select episode, count(*) as n_agents, count(*) filter (depth = 0) as roots, max(depth is null) as cyclic, max(credit_cyclic) as credit_cyclic, min(credited) as all_credited, max(agent = 1) as first from paid group by 1),
 f as (select episode, max(proof) filter (s % 3 <> 0) as m, min(proof) filter (s % 3 <> 0) as mp, min(proof) filter (l_discount >= 0.05) as rp, min(proof) filter (l_linestatus = 'F') as tp from l group by 1),
 tool as (select episode, max(n) > 1 as shared from (select episode, p % 50 as t, count(distinct n) as n from l where l_linestatus = 'F' group by 1, 2) group by 1),
 fields as (select g.episode, n_agents, 'OBSERVED' as agent_identity,
  case when w.wrong is null then 'NOT_OBSERVABLE' when w.wrong or cyclic then 'INVALID' when roots = 1 then 'OBSERVED' else 'INSUFFICIENT_EVIDENCE' end as parent_child,
  case when mp is null then 'NOT_OBSERVABLE' when not first then 'INVALID' when mp then 'OBSERVED' else 'INSUFFICIENT_EVIDENCE' end as message_routing,
  case when tp is null then 'NOT_OBSERVABLE' when shared then 'INVALID' when tp then 'OBSERVED' else 'INSUFFICIENT_EVIDENCE' end as tool_ownership,
  case when rp is null then 'NOT_OBSERVABLE' when rp then 'OBSERVED' else 'INSUFFICIENT_EVIDENCE' end as reward_ownership,
  case when c.wrong is null then 'NOT_OBSERVABLE' when c.wrong or credit_cyclic then 'INVALID' when all_credited then 'OBSERVED' else 'INSUFFICIENT_EVIDENCE' end as credit_assignment
  from g join f using (episode) left join tool using (episode) left join wrong w on w.kind = 'parent' and w.episode = g.episode left join wrong c on c.kind = 'credit' and c.episode = g.episode),
 graphs as (select *, case when 'INVALID' in (parent_child, message_routing, tool_ownership, credit_assignment) then 'INVALID' when n_agents = 1 and parent_child = 'NOT_OBSERVABLE' then 'OBSERVED'
  when parent_child = 'INSUFFICIENT_EVIDENCE' then parent_child when parent_child = 'NOT_OBSERVABLE' then parent_child else 'OBSERVED' end as status from fields)"""


@query(f"with {_GRAPH} select * from graphs")
def agent_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each order's relations between its lines show, field by field."""
    named = members(spark, sf_dir).withColumns({"agent": F.col("agent").cast("string"), "policy": F.col("policy").cast("string")})
    return agents.graph(named, relations(spark, sf_dir))[0]


@query(f"""with {_GRAPH}, seen as (select p.episode, p.agent, g.status as graph_status, p.root, p.depth, p.depth is null as cyclic, receives or (p.depth is not null and p.depth = 0 and parent_child = 'OBSERVED') as observes, tools or sends as acts, rewarded, credited,
  p.policy, o_custkey as c, o_orderstatus as s from paid p join graphs g on g.episode = p.episode left join orders on o_orderkey = p.episode),
 sft as (select *, list_filter([case when c is null or c % 11 = 0 then 'INTEGRITY' end, case when c is null or c % 7 = 0 then 'VALIDITY' end, case when s is null or s = 'P' then 'TASK_STATUS' end, case when graph_status <> 'OBSERVED' then 'GRAPH_STATUS' end,
  case when not observes then 'OBSERVATION_OWNERSHIP' end, case when not acts then 'ACTION_OWNERSHIP' end], lambda x: x is not null) as r from seen),
 rl as (select *, r || list_filter([case when c is null or policy <> c % 2 then 'POLICY' end, case when not rewarded then 'REWARD_OWNERSHIP' end, case when not credited then 'CREDIT_ASSIGNMENT' end,
  case when c is null or c % 3 = 0 then 'MODEL_TOKEN_IDS' end, case when c is null or c % 4 = 0 then 'MODEL_LOGPROBS' end], lambda x: x is not null) as q from sft)
select episode, agent::varchar as agent, graph_status, root::varchar as parent_root, depth::bigint as parent_depth, cyclic as parent_cyclic, observes, acts, rewarded, credited, array_to_string(r, ',') as sft_reasons, array_to_string(q, ',') as rl_reasons, len(r) = 0 as sft, len(q) = 0 as rl from rl""")
def agent_training_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines of an order may be learnt from, and why others not."""
    named = members(spark, sf_dir).withColumns({"agent": F.col("agent").cast("string"), "policy": F.col("policy").cast("string")})
    found = agents.training_views(named, relations(spark, sf_dir), facts(spark, sf_dir))
    return found.withColumns({c: F.array_join(c, ",") for c in ("sft_reasons", "rl_reasons")})
