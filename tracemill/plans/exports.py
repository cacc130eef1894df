"""Registered queries on training views, bundles and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import exports
from ..sources import tables
from .catalog import _shared, query

_ACTIONS = """a as (select conv_id as episode, conv_id % 10 as task, turn as position, coalesce(role, 'none') as tool, '{"n":' || length(coalesce(text, ''))::varchar || '}' as arguments,
 case when turn % 3 = 0 then 'FAILED' else 'SUCCEEDED' end as status, '/ws/repo/' || turn::varchar as observation from conversations where conv_id is not null),
 s as (select distinct conv_id % 10 as id, case when conv_id % 10 = 3 then ' ' when conv_id % 10 = 4 then null else ' Do ' || (conv_id % 10)::varchar || ' ' end as statement from conversations where conv_id % 10 <> 5),
 l as (select *, row_number() over (partition by episode order by position) - 1 as done, '  ' || tool || '(' || arguments || ') -> ' || case when status = 'SUCCEEDED' then 'ok' else lower(status) end || chr(10) || '    observation: ' || replace(observation, '/ws/repo', '$WORKSPACE') as line from a),
 h as (select *, string_agg(line, chr(10)) over (partition by episode order by position rows between unbounded preceding and 1 preceding) as history from l),
 e as (select h.episode, h.task, h.position, 'Task id: ' || h.task::varchar || chr(10) || chr(10) || 'Problem statement:' || chr(10) || trim(coalesce(case when trim(t.statement) <> '' then t.statement end, case when trim(u.statement) <> '' then u.statement end))
 || chr(10) || chr(10) || 'Progress so far (' || done::varchar || ' completed action):' || chr(10) || case when done = 0 then '(no prior actions)' else history end || chr(10) || chr(10) || 'Choose the next canonical action.' as prompt,
 '{"action_type":"' || tool || '","arguments":' || arguments || '}' as expected from h left join s t on t.id = h.task left join s u on u.id = h.episode)"""


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    actions = tables.read(spark, sf_dir, "conversations").filter("conv_id is not null").select(
        c("conv_id").alias("episode"), (c("conv_id") % 10).alias("task"), c("turn").alias("position"), F.coalesce("role", F.lit("none")).alias("tool"),
        F.concat(F.lit('{"n":'), F.length(F.coalesce("text", F.lit(""))).cast("string"), F.lit("}")).alias("arguments"), F.when(c("turn") % 3 == 0, "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.concat(F.lit("/ws/repo/"), c("turn").cast("string")).alias("observation"),
    )
    task = c("conv_id") % 10
    said = F.when(task == 3, " ").when(task != 4, F.concat(F.lit(" Do "), task.cast("string"), F.lit(" ")))
    statements = tables.read(spark, sf_dir, "conversations").filter("conv_id % 10 <> 5").select(task.alias("id"), said.alias("statement")).distinct()
    return exports.examples(actions, statements)


@query(f"with {_ACTIONS} select episode, position, sha256(prompt || chr(10) || expected) as sha256, length(prompt) as prompt_chars, expected from e where prompt is not null")
def sft_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _examples(spark, sf_dir).filter("prompt is not null")
    return made.select("episode", "position", "sha256", F.length("prompt").cast("long").alias("prompt_chars"), "expected")


@query(f"""with {_ACTIONS} select count(*) as examples, count(distinct sha256(prompt || chr(10) || expected)) as "distinct", count(*) - count(distinct sha256(prompt || chr(10) || expected)) as duplicates,
 (select count(*) from e where prompt is null) as without_statement from e where prompt is not null""")
def sft_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _examples(spark, sf_dir)
    whole = F.col("prompt").isNotNull()
    return made.agg(
        F.count(F.when(whole, 1)).alias("examples"), F.count_distinct(F.when(whole, F.col("sha256"))).alias("distinct"),
        (F.count(F.when(whole, 1)) - F.count_distinct(F.when(whole, F.col("sha256")))).alias("duplicates"), F.count(F.when(~whole, 1)).alias("without_statement"),
    )


@query(r"""select event_id, '{"name":"' || event_type || '","arguments":' || props || '}' as qwen, '{"type":"function","function":{"name":"' || event_type || '","arguments":"' || replace(props, '"', '\"') || '"}}' as openai,
 '{"action_type":"' || event_type || '","arguments":' || props || '}' as json from events""")
def rendered_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.timeline(spark, sf_dir)
    return rows.select("event_id", *[exports.rendered(F.col("event_type"), F.col("props"), s).alias(s) for s in ("qwen", "openai", "json")])


@query("""with i as (select o_orderkey as episode, o_custkey % 5 as run, o_orderkey % 3 as attempt, case when o_custkey % 4 > 0 then o_clerk_like end as verifier_report from (select *, o_custkey::varchar as o_clerk_like from orders)),
 a as (select l_orderkey as episode, o_custkey % 5 as run, case when l_partkey % 9 = 0 then 7 else l_orderkey % 3 end as attempt, sha256((l_partkey % 20)::varchar) as checksum, l_returnflag = 'R' as tokens, l_linestatus = 'F' as verifies from lineitem join orders on o_orderkey = l_orderkey),
 p as (select run, episode, attempt, count(*) as n, count(distinct checksum) as d, list(distinct checksum) as own, string_agg(checksum, ',' order by checksum) filter (tokens) as policies, bool_or(verifies) as verifies from a group by 1, 2, 3)
 select i.run, i.episode, i.attempt, array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), [sha256(i.episode::varchar)]))), ',') as source_checksums, coalesce(policies, '') as policy_checksums,
 case when n is null then 'NO_PRODUCER_ARTIFACT' when d <> n then 'REPEATED_ARTIFACT' when verifies and verifier_report is null then 'VERIFIER_REPORT_MISSING' else '' end as reason
 from i left join p on p.run = i.run and p.episode = i.episode and p.attempt = i.attempt""")
def execution_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, orders = F.col, tables.read(spark, sf_dir, "orders")
    identities = orders.select((c("o_custkey") % 5).alias("run"), c("o_orderkey").alias("episode"), (c("o_orderkey") % 3).alias("attempt"), F.when(c("o_custkey") % 4 > 0, c("o_custkey").cast("string")).alias("verifier_report"))
    lines = tables.read(spark, sf_dir, "lineitem").join(orders.select(c("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    artifacts = lines.select(
        (c("o_custkey") % 5).alias("run"), c("l_orderkey").alias("episode"), F.when(c("l_partkey") % 9 == 0, 7).otherwise(c("l_orderkey") % 3).alias("attempt"), F.sha2((c("l_partkey") % 20).cast("string"), 256).alias("checksum"),
        (c("l_returnflag") == "R").alias("tokens"), (c("l_linestatus") == "F").alias("verifies"),
    )
    sources = identities.select("run", "episode", "attempt", F.sha2(c("episode").cast("string"), 256).alias("checksum"))
    return exports.bundles(identities, artifacts, sources)


@query("""select o_custkey as "group", count(*) filter (o_orderkey % 8 = 0) as unbound, count(distinct case when o_orderkey % 8 > 0 then o_orderpriority end) as tasks,
 count(*) filter (o_orderkey % 8 = 0) = 0 and count(distinct case when o_orderkey % 8 > 0 then o_orderpriority end) = 1 as bound from orders group by 1""")
def group_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("group"), F.col("o_orderkey").alias("episode"), F.when(F.col("o_orderkey") % 8 > 0, F.col("o_orderpriority")).alias("task"))
    return exports.bound_groups(rows)


@query("""with g as (select l_orderkey, count(*) as n, count(distinct l_returnflag = 'R') as rewards, sum(l_partkey % 4)::bigint as tokens, sum((l_returnflag = 'R')::int) as s from lineitem group by 1)
 select sum(n)::bigint as traces, count(*) as groups, count(*) filter (rewards > 1) as groups_with_variance, sum(tokens)::bigint as tokens, round(sum(s) / sum(n), 6) as mean_reward from g""")
def grpo_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    traces = tables.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("group"), (F.col("l_returnflag") == "R").cast("int").alias("reward"), F.concat(F.array_repeat(F.lit(1), (F.col("l_partkey") % 4).cast("int")), F.array(F.lit(0))).alias("mask")
    )
    return exports.preflight(traces)


@query("""select doc_id, case when doc_id % 3 = 0 then null else epoch_ms(timestamp '2026-01-01') + doc_id * 1000 end as ms, right(coalesce(text, ''), 80) as tail,
 case when doc_id % 5 = 0 then 'n/a' else printf('%.2f', (doc_id % 8) / 8.0::double * 100) || '%' end as share from documents""")
def report_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    moment = F.when(doc % 3 == 0, "no time").otherwise(F.concat(F.date_format(F.timestamp_seconds(F.lit(1767225600) + doc), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return tables.read(spark, sf_dir, "documents").select(
        "doc_id", exports.millis(moment).alias("ms"), F.right(F.coalesce("text", F.lit("")), F.lit(80)).alias("tail"), exports.percent(F.when(doc % 5 != 0, (doc % 8) / 8.0)).alias("share")
    )


@query("""select o_orderstatus as status, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1""")
def document_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as JSON documents, and the folder read back as a table."""
    path = _shared(spark, "documents")
    tables.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").repartition(8).write.json(path)
    read = spark.read.schema("o_orderkey long, o_orderstatus string, o_totalprice double").json(path)
    return read.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
