"""Registered queries on paths, call pairing, token sequences, admission and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical, paths
from ..operators import training
from ..sources import tables
from .catalog import query
from .evidence import _KINDS

_ROOT = "/ws/repo"
_PATHS = ("/ws/repo/a/../b/{}", "src/./x//{}", "/ws/repo/", "/etc/{}/../p", "/ws/repository/{}", "../up/{}", "~/{}", "/ws/repo/../out/{}", "./")
_COMMANDS = ("cd /ws/repo/src && make {}", "ls /ws/repo", "cat /etc/hosts {}", "X=/ws/repo/a cp /tmp/b .", "echo {} > /dev/null", "cd /ws/repo; ls")
_TOOLS = ("read", "grep", "bash", "teleport", "finish", "ls")


def _cases(values: tuple[str, ...]) -> str:
    """One of the values by doc_id, with it put in: as SQL."""
    return f"replace([{', '.join(repr(v) for v in values)}][(doc_id % {len(values)})::int + 1], '{{}}', doc_id::varchar)"


def _case(values: tuple[str, ...]) -> Column:
    """The same as a column."""
    one = F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % len(values)).cast("int") + 1)
    return F.replace(one, F.lit("{}"), F.col("doc_id").cast("string"))


_NORMAL = """(case when p like '/%' then '/' else '' end) || list_reduce(list_prepend('', list_filter(string_split(p, '/'), lambda x: x not in ('', '.'))), lambda a, x: case when x = '..' then
 case when a <> '' and not regexp_matches(a, '(^|/)\\.\\.$') then regexp_replace(a, '/?[^/]+$', '') when p like '/%' then a when a = '' then '..' else a || '/..' end when a = '' then x else a || '/' || x end)"""


@query(f"""select doc_id, case when p like '~%' then p when p not like '/%' then c when c = '{_ROOT}' then '.' when starts_with(c, '{_ROOT}/') then substr(c, {len(_ROOT) + 2}) else p end as path,
 p like '~%' or (p like '/%' and c <> '{_ROOT}' and not starts_with(c, '{_ROOT}/')) as lossy from (select doc_id, p, case when n = '' then '.' else n end as c from (
 select doc_id, p, {_NORMAL} as n from (select doc_id, {_cases(_PATHS)} as p from documents)))""")
def path_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", _case(_PATHS).alias("p"))
    return docs.select("doc_id", paths.relative(F.col("p"), _ROOT).alias("r")).select("doc_id", "r.path", "r.lossy")


_WORDS = r"list_filter(regexp_split_to_array(translate(p, '=' || chr(10), '  '), '\s+'), lambda w: starts_with(w, '/'))"


@query(f"""select doc_id, case when contains(p, '{_ROOT}') then '$WORKSPACE' || substr(p, instr(p, '{_ROOT}') + {len(_ROOT)}) else p end as command,
 len(list_filter({_WORDS}, lambda w: case when contains(p, '{_ROOT}') then not starts_with(w, '{_ROOT}') else not starts_with(w, '/dev/') end)) > 0 as lossy
 from (select doc_id, {_cases(_COMMANDS)} as p from documents)""")
def command_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", _case(_COMMANDS).alias("p"))
    return docs.select("doc_id", paths.command(F.col("p"), _ROOT).alias("r")).select("doc_id", "r.command", "r.lossy")


_NAMED = ", ".join(f"('{k}', '{v}')" for k, v in paths.TOOLS.items())


@query(f"""select coalesce(c, 'UNKNOWN') as tool, count(*) as n from (select {_cases(_TOOLS)} as t from documents) left join (values {_NAMED}) m(s, c) on s = t group by 1""")
def tool_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select(_case(_TOOLS).alias("t"))
    return docs.groupBy(F.coalesce(paths.tool(F.col("t")), F.lit("UNKNOWN")).alias("tool")).agg(F.count("*").alias("n"))


@query("""select doc_id, case when length(text) > 500 then substr(text, 1, 250) || chr(10) || '...[+' || (length(text) - 500)::varchar || ' chars truncated]...' || chr(10) || right(text, 250) else text end as text
 from documents where text is not null""")
def capped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "documents").filter("text is not null").select("doc_id", canonical.cap_text(F.col("text"), 500).alias("text"))


@query("""with t as (select user_id as trajectory, row_number() over (partition by user_id order by ts, event_id) as position, case when event_type in ('view', 'signup') then 'assistant' else 'tool' end as role,
 event_id % 3 as call from events), b as (select *, sum((role = 'assistant')::int) over (partition by trajectory order by position) as turn from t),
 m as (select trajectory, turn, call, count(*) filter (role = 'assistant') as c, count(*) filter (role = 'tool') as r from b group by 1, 2, 3)
 select trajectory, sum(c)::bigint as calls, sum(least(c, r))::bigint as matched, sum(greatest(r - c, 0))::bigint as stray_results, sum(greatest(c - r, 0))::bigint as open_calls,
 count(distinct call) filter (c > 0) as distinct_calls, sum(greatest(r - c, 0)) = 0 and sum(greatest(c - r, 0)) = 0 and count(distinct call) filter (c > 0) = sum(c) as paired from m group by 1""")
def call_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    messages = tables.timeline(spark, sf_dir).select(
        F.col("user_id").alias("trajectory"), F.row_number().over(order).alias("position"), F.when(F.col("event_type").isin("view", "signup"), "assistant").otherwise("tool").alias("role"),
        (F.col("event_id") % 3).alias("call"),
    )
    return training.pairing(messages)


@query("""select trajectory, position, signature, has_text from (select user_id as trajectory, event_id as position, case when event_type <> 'signup' then event_type || (event_id % 2)::varchar end as signature,
 event_id % 7 = 0 as has_text from events) e where has_text or (signature is not null and position = (select min(event_id) from events f where f.user_id = e.trajectory and f.event_type <> 'signup'
 and f.event_type || (f.event_id % 2)::varchar = e.signature))""")
def duplicate_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    signature = F.when(F.col("event_type") != "signup", F.concat("event_type", (F.col("event_id") % 2).cast("string")))
    turns = tables.timeline(spark, sf_dir).select(
        F.col("user_id").alias("trajectory"), F.col("event_id").alias("position"), signature.alias("signature"), (F.col("event_id") % 7 == 0).alias("has_text")
    )
    return training.suppressed(turns)


@query("""with p as (select user_id as trajectory, count(s) as tool_steps, count(*) filter (event_type = 'error') as errors, count(distinct s) as "distinct", count(*) filter (s is not null and event_type = 'view') as unpaired,
 count(*) as messages from (select *, case when event_type <> 'signup' then event_type || (event_id % 5)::varchar end as s from events) group by 1),
 r as (select *, tool_steps - "distinct" as duplicates, coalesce(errors / nullif(tool_steps, 0), 0) as e, coalesce((tool_steps - "distinct") / nullif(tool_steps, 0), 0) as d from p)
 select trajectory, tool_steps, errors, "distinct", unpaired, messages, duplicates, round(e, 6) as error_rate, round(d, 6) as duplicate_rate,
 round(greatest(0, 1 - (e * 0.35 + d * 0.25 + greatest(tool_steps - 48, 0) / 96 * 0.2 + greatest(messages - 96, 0) / 200 * 0.2)), 6) as score,
 case when unpaired > 0 then 'UNPAIRED_STEPS' when tool_steps > 96 then 'TOO_MANY_STEPS' when e > 0.35 then 'ERROR_RATE' when d > 0.4 then 'DUPLICATE_RATE' when messages > 200 then 'TOO_MANY_MESSAGES' else '' end as reason from r""")
def trajectory_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = tables.timeline(spark, sf_dir).select(
        F.col("user_id").alias("trajectory"), F.when(F.col("event_type") != "signup", F.concat("event_type", (F.col("event_id") % 5).cast("string"))).alias("signature"),
        (F.col("event_type") == "error").alias("failed"), F.when(F.col("event_type") != "view", 1).alias("result"),
    )
    return training.quality(steps)


_CALLS = """with n as (select l_orderkey as episode, l_linenumber as line, l_partkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as i from lineitem),
 c as (select episode, i, l_partkey % 23 = 0 as bad, case when l_partkey % 23 = 0 then -1 else 1 end as sign from n)"""


@query(f"""{_CALLS}, w as (select episode, count(*) as k, max(case when i > 1 and bad then 1 else 0 end) = 0 as trainable from c group by 1)
 select episode, trainable, case when trainable then list_sum(range(0, 3 * k::bigint)) * 1.0 end as token_sum, case when trainable then 3 * k - 1 end as n_tokens, case when trainable then 2 * k end as ones, k - 1 as rounds from w""")
def sequence_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call i of an episode sees 3 * (i - 1) + 1 tokens, those before and its own last, and answers with 2; some rewrite the first token."""
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = tables.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode"), "l_partkey", F.row_number().over(order).alias("i"))
    upto = F.sequence(F.lit(0).cast("long"), 3 * (F.col("i") - 1).cast("long"))
    prompt = F.when((F.col("l_partkey") % 23 == 0) & (F.col("i") > 1), F.transform(upto, lambda x: -x - 1)).otherwise(upto)
    calls = lines.select("episode", F.col("i").alias("position"), prompt.alias("prompt"), F.array(3 * (F.col("i") - 1) + 1, 3 * (F.col("i") - 1) + 2).cast("array<bigint>").alias("response"))
    whole = training.sequences(calls)
    total = F.aggregate("tokens", F.lit(0).cast("long"), lambda s, x: s + x)
    return whole.select(
        "episode", "trainable", total.cast("double").alias("token_sum"), F.when(F.col("trainable"), F.size("tokens").cast("long")).alias("n_tokens"),
        F.when(F.col("trainable"), F.aggregate("mask", F.lit(0), lambda s, x: s + x).cast("long")).alias("ones"), "rounds",
    )


@query("""select o_orderkey as episode, stored, rebuilt, case when d < least(stored, rebuilt) then d end as first_difference, stored = rebuilt and not d < stored as equal from (
 select o_orderkey, 3 + o_custkey % 5 as stored, 3 + o_orderkey % 5 as rebuilt, o_custkey % 9 as d from orders)""")
def sequence_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tokens(n: Column, changed: Column | None = None) -> Column:
        return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: i if changed is None else F.when(i == changed, -1).otherwise(i))

    orders = tables.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("episode"), tokens(3 + F.col("o_custkey") % 5, F.col("o_custkey") % 9).alias("a"), tokens(3 + F.col("o_orderkey") % 5).alias("b")
    )
    return orders.select(
        "episode", F.size("a").cast("long").alias("stored"), F.size("b").cast("long").alias("rebuilt"), training.first_difference(F.col("a"), F.col("b")).cast("long").alias("first_difference"),
        (F.col("a") == F.col("b")).alias("equal"),
    )


@query("""select l_returnflag as policy, count(*) as n, round(avg(x), 6) as mean, round(max(x), 6) as max, round(quantile_cont(x, 0.5), 6) as p50, round(quantile_cont(x, 0.9), 6) as p90, round(quantile_cont(x, 0.95), 6) as p95,
 round(quantile_cont(x, 0.99), 6) as p99, avg(x) <= 0.05 and quantile_cont(x, 0.99) <= 0.5 as within from (select l_returnflag, abs(l_discount - l_tax) as x from lineitem where l_quantity > 20) group by 1""")
def logprob_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tables.read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("policy"), F.col("l_discount").alias("a"), F.col("l_tax").alias("b"), (F.col("l_quantity") > 20).cast("int").alias("mask")
    )
    return training.drift(tokens, "policy")


_MEMBERS = """m as (select l_orderkey::varchar || '/' || l_linenumber::varchar as member, l_orderkey as episode, l_partkey as certification, l_suppkey as bundle, l_orderkey as artifact, case when l_partkey % 7 > 0 then l_orderkey % 50 end as grp,
 case when l_suppkey % 9 > 0 then l_suppkey % 3 end as policy, (l_returnflag = 'R')::int as reward from lineitem),
 d as (select p_partkey as decision, case when p_size % 4 > 0 then 'ELIGIBLE' else 'REJECTED' end as verdict, p_partkey % 3 as de from part where p_partkey % 10 > 0),
 b as (select s_suppkey as bundle_sum, s_suppkey % 2 as be from supplier where s_suppkey % 6 > 0), a as (select o_orderkey as artifact_sum, case when o_orderstatus <> 'P' then 'COMPLETED' else 'FAILED' end as status from orders where o_orderkey % 13 > 0),
 j as (select m.*, case when decision is null then 'DECISION_MISSING' when verdict <> 'ELIGIBLE' then 'NOT_ELIGIBLE' when de <> episode % 3 then 'DECISION_EPISODE_DIFFERS' when bundle_sum is null then 'BUNDLE_MISSING'
 when artifact_sum is null then 'ARTIFACT_MISSING' when be <> episode % 2 then 'BUNDLE_EPISODE_DIFFERS' when not (artifact % 5 in (bundle % 5, (bundle + 1) % 5)) then 'ARTIFACT_NOT_BOUND' when status <> 'COMPLETED' then 'ARTIFACT_NOT_COMPLETED'
 when grp is null or policy is null then 'NO_GROUP_OR_POLICY' else '' end as reason from m left join d on certification = decision left join b on bundle = bundle_sum left join a on artifact = artifact_sum)"""


def _cited(spark: SparkSession, sf_dir: str) -> tuple:
    """Members, what they cite, and how these are compared."""
    lines, c = tables.read(spark, sf_dir, "lineitem"), F.col
    members = lines.select(
        F.concat_ws("/", c("l_orderkey").cast("string"), c("l_linenumber").cast("string")).alias("member"), c("l_orderkey").alias("episode"), c("l_orderkey").alias("artifact"), c("l_partkey").alias("certification"), c("l_suppkey").alias("bundle"),
        F.when(c("l_partkey") % 7 > 0, c("l_orderkey") % 50).alias("group"), F.when(c("l_suppkey") % 9 > 0, c("l_suppkey") % 3).alias("policy"), (c("l_returnflag") == "R").cast("int").alias("reward"),
    )
    # What a certification and a bundle are of is a class of episodes here.
    decisions = tables.read(spark, sf_dir, "part").filter("p_partkey % 10 > 0").select(c("p_partkey").alias("decision"), F.when(c("p_size") % 4 > 0, "ELIGIBLE").otherwise("REJECTED").alias("verdict"), (c("p_partkey") % 3).alias("decision_episode"))
    bundles = tables.read(spark, sf_dir, "supplier").filter("s_suppkey % 6 > 0").select(c("s_suppkey").alias("bundle_sum"), (c("s_suppkey") % 2).alias("bundle_class"), F.array(c("s_suppkey") % 5, (c("s_suppkey") + 1) % 5).alias("bound_class"))
    artifacts = tables.read(spark, sf_dir, "orders").filter("o_orderkey % 13 > 0").select(c("o_orderkey").alias("artifact_sum"), F.when(c("o_orderstatus") != "P", "COMPLETED").otherwise("FAILED").alias("status"))
    told = bundles.select("bundle_sum", c("bundle_class").alias("bundle_episode"), c("bound_class").alias("bound"))
    return members, decisions, told, artifacts, c("decision_episode") == c("episode") % 3, c("bundle_episode") == c("episode") % 2, F.array_contains("bound", c("artifact") % 5)


@query(f"with {_MEMBERS} select member, episode, reason, count(*) as n from j group by 1, 2, 3")
def admission_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.admitted(*_cited(spark, sf_dir)).groupBy("member", "episode", "reason").agg(F.count("*").alias("n"))


@query(f"""with {_MEMBERS}, t as (select * from j where reason = ''), g as (select count(*) filter (size < 4) as undersized, count(*) as groups from (select grp, count(distinct episode) as size from t group by 1)),
 w as (select count(distinct policy) as policies, count(distinct reward) as rewards, count(*) as members from t)
 select policies, rewards, members, undersized, groups, case when members = 0 then 'EMPTY' when policies <> 1 then 'MIXED_POLICIES' when undersized > 0 then 'UNDERSIZED_GROUPS' when rewards < 2 then 'NO_REWARD_VARIANCE' else '' end as reason from w, g""")
def admission_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.batch_gate(training.admitted_only(*_cited(spark, sf_dir)))


@query("""with b as (select o_custkey as task, max(o_orderstatus) as harness, min(o_orderpriority) as snapshot, max((o_orderstatus = 'F')::int) as solved from orders where o_orderkey % 2 = 0 group by 1),
 c as (select o_custkey as task, max(o_orderstatus) as harness, min(o_orderpriority) as snapshot, max((o_orderstatus = 'F')::int) as solved from orders where o_orderkey % 2 = 1 group by 1),
 j as (select coalesce(b.task, c.task) as task, b.solved as x, c.solved as y, case when b.task is null or c.task is null then '' else concat_ws(',', case when b.harness <> c.harness then 'harness' end, case when b.snapshot <> c.snapshot then 'snapshot' end) end as differs
 from b full join c on b.task = c.task)
 select task, case when x is null then 'NO_BASELINE' when y is null then 'NO_CANDIDATE' when differs <> '' then 'CONTROLS_DIFFER' else 'PAIRED' end as state, differs, case when differs = '' then y - x end as delta from j""")
def policy_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.read(spark, sf_dir, "orders")

    def side(odd: int) -> DataFrame:
        return orders.filter(F.col("o_orderkey") % 2 == odd).groupBy(F.col("o_custkey").alias("task")).agg(
            F.max("o_orderstatus").alias("harness"), F.min("o_orderpriority").alias("snapshot"), F.max((F.col("o_orderstatus") == "F").cast("int")).alias("solved")
        )

    return training.paired_controls(side(0), side(1), "task", ["harness", "snapshot"])


@query("""select l_orderkey as episode from lineitem group by 1 having bool_and(l_discount < 0.08 and l_tax < 0.07)""")
def evidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.every(tables.read(spark, sf_dir, "lineitem"), "l_orderkey", (F.col("l_discount") < 0.08) & (F.col("l_tax") < 0.07)).select(F.col("l_orderkey").alias("episode"))


@query("select o_orderkey as task from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def remaining_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = tables.read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("task"))
    return tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task")).join(done, "task", "left_anti")


@query("""with p as (select user_id as key, min(ts) filter (event_type = 'signup') as a, min(ts) filter (event_type = 'view') as b, min(ts) filter (event_type = 'click') as c, min(ts) filter (event_type = 'purchase') as d from events group by 1)
 select key, case when a is not null then greatest(0, epoch_us(coalesce(b, c, d, timestamp '2030-01-01')) - epoch_us(a)) // 1000000 end as queued_s,
 case when b is not null then greatest(0, epoch_us(coalesce(c, d, timestamp '2030-01-01')) - epoch_us(b)) // 1000000 end as init_s, case when c is not null then greatest(0, epoch_us(coalesce(d, timestamp '2030-01-01')) - epoch_us(c)) // 1000000 end as run_s,
 coalesce(a <= b, true) and coalesce(b <= c, true) and coalesce(c <= d, true) as in_order from p""")
def stage_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.element_at(F.create_map(*[F.lit(x) for x in ("signup", "QUEUED", "view", "INIT", "click", "RUN", "purchase", "POSTRUN", "error", "-", "refund", "-")]), F.col("event_type"))
    rows = tables.timeline(spark, sf_dir).select(F.col("user_id").alias("key"), stage.alias("stage"), F.col("ts").alias("at"))
    return training.stage_times(rows, ("QUEUED", "INIT", "RUN", "POSTRUN"), "2030-01-01")


@query("""select user_id, event_type, arg_max(value, (ts, event_id)) as value from events group by 1, 2""")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.timeline(spark, sf_dir).groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


@query("""with r as (select s, k, d, row_number() over (partition by s order by d) as rank, case s when 'A' then 14 when 'B' then 22 when 'C' then 4 else 0 end as quota from (
 select case when p_size % 10 = 0 then 'C' when p_size % 2 = 0 then 'A' else 'B' end as s, p_partkey as k, sha256('q:' || p_partkey::varchar) as d from part)),
 x as (select * from r where rank <= quota), l as (select *, row_number() over (order by d) as place from (select * from r where rank > quota and rank <= quota + 80)),
 h as (select count(*) as have from x)
 select s as stratum, k as p_partkey, 'DRAWN' as part from x union all select s, k, case when place <= 40 - have then 'FILLED' else 'HELD_OUT' end from l, h where place <= 80 - have""")
def curriculum_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    stratum = F.when(F.col("p_size") % 10 == 0, "C").when(F.col("p_size") % 2 == 0, "A").otherwise("B")
    pool = tables.read(spark, sf_dir, "part").select(stratum.alias("stratum"), "p_partkey")
    return training.quotas(pool, "stratum", "p_partkey", {"A": 0.35, "B": 0.55, "C": 0.1}, 40, "q:")


@query("""select o_orderpriority as bench, count(*) as total, count(*) filter (o_orderstatus = 'F') as passed, round(count(*) filter (o_orderstatus = 'F') / greatest(1, count(*)), 4) as pass_at_1,
 case when count(*) % 3 = 0 then 3 when count(*) % 4 = 0 then 4 when count(*) % 5 = 0 then 5 when count(*) % 2 = 0 then 2 else 1 end as accumulation from orders group by 1""")
def pass_at_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = tables.read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("bench")).agg(F.count("*").alias("total"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("passed"))
    return per.withColumn("pass_at_1", F.round(F.col("passed") / F.greatest(F.lit(1), "total"), 4)).withColumn("accumulation", training.accumulation(F.col("total")))


@query("""select l_orderkey as episode, case when k = n then 1.0::double when k > 0 then round(0.2 + 0.6 * k / n, 4) else 0.0::double end as reward from (
 select l_orderkey, count(*) as n, count(*) filter (l_returnflag <> 'R') as k from lineitem group by 1)""")
def partial_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = tables.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode")).agg(F.count("*").alias("n"), F.count(F.when(F.col("l_returnflag") != "R", 1)).alias("k"))
    return per.select("episode", training.partial_credit(F.col("k"), F.col("n")).alias("reward"))


@query("""with t as (select l_orderkey as episode, l_shipdate as happened, (l_partkey * 31 + l_suppkey * 7 + l_linenumber) as k, l_partkey, l_suppkey, l_quantity from lineitem),
 a as (select *, ['MODEL_REQUEST', 'MODEL_RESPONSE', 'TOOL_CALL', 'TOOL_RESULT', 'VERIFICATION_STARTED', 'VERIFICATION_FINISHED', 'EPISODE_FINISHED', 'SANDBOX_STARTED', 'SANDBOX_FINISHED', 'HARNESS_DECISION'][(k % 10)::int + 1] as kind from t),
 b as (select *, coalesce(kind = 'TOOL_CALL' and lag(l_suppkey % 3) over o = l_suppkey % 3, false) as repeated from a window o as (partition by episode, kind = 'TOOL_CALL' order by happened, l_partkey * 1000000 + l_suppkey)),
 o as (select *, repeated and not coalesce(lag(repeated) over (partition by episode, kind = 'TOOL_CALL' order by happened, l_partkey * 1000000 + l_suppkey), false) as opens from b),
 p as (select episode, (epoch_us(max(happened)) - epoch_us(min(happened))) / 1000.0 as duration_ms, count(*) filter (kind = 'MODEL_REQUEST') as turn_count, count(*) filter (kind = 'VERIFICATION_FINISHED') as verification_attempts,
 count(*) filter (kind = 'TOOL_CALL') as c, count(*) filter (kind = 'TOOL_RESULT' and (k // 10) % 4 > 0) as e, count(*) filter (repeated) as d, count(*) filter (opens) as loops, sum(case when kind = 'MODEL_RESPONSE' then l_partkey end)::bigint as tokens,
 sum(l_quantity) filter (kind = 'MODEL_RESPONSE') as model_latency_ms, sum(l_quantity) filter (kind = 'TOOL_RESULT') as tool_latency_ms, sum(l_quantity) filter (kind = 'VERIFICATION_FINISHED') as verifier_latency_ms from o group by 1)
 select episode, duration_ms, turn_count, verification_attempts, case when c > 0 then c end as tool_call_count, case when c > 0 then e end as tool_error_count, case when c > 0 then d end as duplicate_action_count,
 case when c > 0 then round(d / c, 6) end as duplicate_action_rate, case when c > 0 then loops end as loop_count, tokens, model_latency_ms, tool_latency_ms, verifier_latency_ms,
 concat_ws(',', case when c = 0 then 'tool_call_count,tool_error_count,duplicate_action_rate' end, case when tokens is null then 'tokens' end, 'estimated_cost') as not_observable from p""")
def episode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.read(spark, sf_dir, "lineitem")
    k = F.col("l_partkey") * 31 + F.col("l_suppkey") * 7 + F.col("l_linenumber")
    kind = F.element_at(F.array(*[F.lit(x) for x in _KINDS]), (k % 10).cast("int") + 1)
    actions = lines.select(
        F.col("l_orderkey").alias("episode"), kind.alias("kind"), (F.floor(k / 10) % 4 > 0).alias("failed"), (F.col("l_suppkey") % 3).alias("signature"), F.col("l_shipdate").alias("at"), (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("place"),
        F.col("l_quantity").alias("latency_ms"), F.when(kind == "MODEL_RESPONSE", F.col("l_partkey")).alias("tokens"),
    )
    return training.episode_metrics(actions)


@query("""select state, count(*) as n from (select o_orderstatus || '->' || coalesce(r, 'MISSING') as state from orders left join (select l_orderkey, max(l_returnflag) as r from lineitem group by 1) on l_orderkey = o_orderkey) group by 1""")
def reverify_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = tables.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_returnflag").alias("r"))
    joined = tables.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(again, "o_orderkey", "left")
    return joined.groupBy(F.concat_ws("->", "o_orderstatus", F.coalesce("r", F.lit("MISSING"))).alias("state")).agg(F.count("*").alias("n"))
