"""Episodes of several agents: typed relations between them, what each field of the graph shows, and which agents may train.

Agents have episode, agent and policy. Relations have episode, kind, source, target and evidence (null, if it is only
claimed). Nothing is inferred from an agent's name: a field without facts is NOT_OBSERVABLE, with facts that don't tell all
INSUFFICIENT_EVIDENCE, with facts that contradict each other INVALID.

What is said of an agent, or of a tool, is one row before anything is joined. Episodes of few agents are then solved as one row
each, where they lie; those of many by joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import settle, shuffled

#: Kinds of relations, and what a field or a graph may be.
PARENT, MESSAGE, TOOL, REWARD, CREDIT = KINDS = ("PARENT_CHILD", "MESSAGE_ROUTE", "TOOL_OWNERSHIP", "REWARD_OWNERSHIP", "CREDIT_ASSIGNMENT")
OBSERVED, NOT_OBSERVABLE, INSUFFICIENT, INVALID = ("OBSERVED", "NOT_OBSERVABLE", "INSUFFICIENT_EVIDENCE", "INVALID")
KEY = ["episode", "agent"]

#: Agents up to which an episode is one row.
FEW = 64

#: What is said of an agent: that it is one; what it is the source of, a reward with evidence; that a message leads to it; that it has
#: parents or credit, and from none by name; that what it is the source of is only claimed.
_IS, _SENDS, _ACTS, _REWARDS, _PAID, _RECEIVES, _PARENT, _CREDIT, _PARENT_NULL, _CREDIT_NULL, _SENT_CLAIM, _TOOL_CLAIM, _REWARD_CLAIM = (1 << i for i in range(13))


def closure(edges: DataFrame) -> DataFrame:
    """episode, agent, root, depth, cyclic of (episode, agent, up), one row an agent; up is null at a root.

    Pointers jump: each round doubles how far up every agent has looked, so chains of n agents take log n joins. Whoever
    has not met a root after as many rounds as the largest episode needs is on a cycle, or below one.
    """
    most = edges.groupBy("episode").count().agg(F.max("count")).first()[0] or 1
    up = F.col("up")
    state = settle(edges.select(*KEY, F.coalesce(up, F.col("agent")).alias("at"), up.isNotNull().cast("long").alias("depth"), up.isNull().alias("done")), "closure")
    for _ in range(math.ceil(math.log2(most)) + 1):
        active = state.filter("not done")
        if active.isEmpty():
            break
        over = state.select("episode", F.col("agent").alias("at"), F.col("at").alias("_at"), F.col("depth").alias("_depth"), F.col("done").alias("_done"))
        moved = active.drop("done").join(over, ["episode", "at"]).select(*KEY, F.col("_at").alias("at"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_done").alias("done"))
        state = settle(state.filter("done").unionByName(moved), "closure")
    cyclic = ~F.col("done")
    return state.select(*KEY, F.when(~cyclic, F.col("at")).alias("root"), F.when(~cyclic, F.col("depth")).alias("depth"), cyclic.alias("cyclic"))


def _single(agents: DataFrame, relations: DataFrame, kind: str) -> DataFrame:
    """Per agent that relations of a kind lead to: up (its one known source), and whether sources are unknown or several."""
    own = relations.filter(F.col("kind") == kind).select("episode", F.col("source").alias("up"), F.col("target").alias("agent")).distinct()
    known = agents.select("episode", F.col("agent").alias("up"), F.lit(True).alias("known"))
    per = own.join(known, ["episode", "up"], "left").groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("sources"), F.max("up").alias("one"), F.max(F.col("known").isNull()).alias("unknown")
    )
    return per.select(*KEY, F.when((F.col("sources") == 1) & ~F.col("unknown"), F.col("one")).alias("up"), "unknown", (F.col("sources") > 1).alias("several"))


def _field(facts: Column, wrong: Column, whole: Column) -> Column:
    return F.when(F.coalesce(facts, F.lit(0)) == 0, NOT_OBSERVABLE).when(F.coalesce(wrong, F.lit(False)), INVALID).when(F.coalesce(whole, F.lit(False)), OBSERVED).otherwise(INSUFFICIENT)


def _said(agents: DataFrame, relations: DataFrame) -> DataFrame:
    """One row for each agent, known or only named, and each tool of an episode: its bits, and the least and greatest name of its
    parents (of a tool: its owners) and of where its credit comes from."""
    kind, source, target, proof = F.col("kind"), F.col("source"), F.col("target"), F.col("evidence").isNotNull()
    bits = lambda when, yes, no=0: F.when(when, F.lit(yes)).otherwise(F.lit(no))
    none = F.lit(None).cast(relations.schema["source"].dataType)
    row = lambda when, name, bits, tool=False, p=none, c=none: F.when(when, F.struct(F.lit(tool).alias("tool"), name.alias("name"), bits.alias("bits"), p.alias("p"), c.alias("c")))
    own = F.when(kind == MESSAGE, bits(proof, _SENDS, _SENDS | _SENT_CLAIM)).when(kind == TOOL, bits(proof, _ACTS, _ACTS | _TOOL_CLAIM)).otherwise(bits(proof, _REWARDS | _PAID, _REWARDS | _REWARD_CLAIM))
    rows = F.array(
        row(kind.isin(MESSAGE, TOOL, REWARD), source, own), row(kind == MESSAGE, target, F.lit(_RECEIVES)), row(kind == TOOL, target, F.lit(0), True, source),
        row(kind == PARENT, target, bits(source.isNull(), _PARENT | _PARENT_NULL, _PARENT), p=source), row(kind == CREDIT, target, bits(source.isNull(), _CREDIT | _CREDIT_NULL, _CREDIT), c=source),
    )
    told = relations.select("episode", F.explode(F.array_compact(rows)).alias("r")).select("episode", "r.*")
    named = agents.select("episode", F.lit(False).alias("tool"), F.col("agent").alias("name"), F.lit(_IS).alias("bits"), "policy")
    return told.unionByName(named, allowMissingColumns=True).groupBy("episode", "tool", "name").agg(
        F.bit_or("bits").alias("bits"), *[f(x).alias(f"{n}_{x}") for x in "pc" for f, n in ((F.min, "least"), (F.max, "most"))], F.max("policy").alias("policy")
    )


def _climbed(up: Column) -> Column:
    """Of an array that has for each place that of its parent (0: none), counted from 1: at and depth, as far up as pointers jump in
    enough rounds."""
    start = F.struct(F.transform(up, lambda j, i: F.when(j == 0, (i + 1).cast("long")).otherwise(j)).alias("at"), F.transform(up, lambda j: (j > 0).cast("long")).alias("depth"))
    jump = lambda s, _: F.struct(F.transform(s["at"], lambda j: F.element_at(s["at"], j.cast("int"))).alias("at"), F.zip_with(s["at"], s["depth"], lambda j, d: d + F.element_at(s["depth"], j.cast("int"))).alias("depth"))
    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.size(up))).cast("int")), start, jump)


def _few(said: DataFrame) -> DataFrame:
    """Graphs of episodes of few agents, with an array of their members."""
    has = lambda bit, bits=F.col("bits"): bits.bitwiseAND(bit) != 0
    agent, stranger, names = ~F.col("tool"), ~F.col("tool") & ~has(_IS), (("parent", "p", _PARENT, _PARENT_NULL), ("credit", "c", _CREDIT, _CREDIT_NULL))
    differ = {x: F.coalesce(F.col(f"least_{x}") != F.col(f"most_{x}"), F.lit(False)) for x in "pc"}
    any_ = lambda c: F.max(F.coalesce(c, F.lit(False)))
    per = said.groupBy("episode").agg(
        F.bit_or("bits").alias("bits"), any_(stranger & has(_SENDS | _RECEIVES)).alias("message_wrong"), any_(stranger & has(_REWARDS)).alias("reward_wrong"),
        any_(stranger & has(_ACTS)).alias("tool_strange"), any_(~agent & differ["p"]).alias("tool_shared"),
        *[any_(agent & has(told) & (stranger | has(null) | differ[x])).alias(f"{name}_wrong") for name, x, told, null in names],
        F.collect_list(F.when(agent & has(_IS), F.struct(F.col("name").alias("agent"), "policy", "bits", *[F.when(~differ[x] & ~has(null), F.col(f"least_{x}")).alias(x) for _, x, _, null in names]))).alias("a"),
    ).filter(F.size("a") > 0)
    per = per.withColumn("names", F.transform("a", lambda m: m["agent"]))
    per = per.withColumns({f"up_{x}": F.transform("a", lambda m: F.coalesce(F.array_position(F.col("names"), m[x]), F.lit(0).cast("long"))) for x in "pc"})
    per = per.withColumns({x: _climbed(F.col(f"up_{x}")) for x in "pc"})

    def member(m: Column, i: Column) -> Column:
        parts, bits = [m["agent"].alias("agent"), m["policy"].alias("policy")], m["bits"]
        for name, x, told, _ in names:
            at = F.element_at(F.col(f"{x}.at"), i + 1).cast("int")
            done = F.element_at(F.col(f"up_{x}"), at) == 0
            parts += [F.when(done, F.element_at(F.col("names"), at)).alias(f"{name}_root"), F.when(done, F.element_at(F.col(f"{x}.depth"), i + 1)).alias(f"{name}_depth"), (~done).alias(f"{name}_cyclic"), has(told, bits).alias(f"{name}_told")]
        owns = {"sends": _SENDS, "acts": _ACTS, "rewarded": _PAID, "receives": _RECEIVES}
        credited = done & has(_PAID, F.element_at(F.col("a"), at)["bits"])
        return F.struct(*parts, *[has(bit, bits).alias(n) for n, bit in owns.items()], credited.alias("credited"))

    per = per.withColumn("members", F.transform("a", member))
    held = F.col("members")
    some = lambda of: F.exists(held, of)
    lost = lambda x: F.exists(F.arrays_zip("a", f"up_{x}"), lambda z: z["a"][x].isNotNull() & (z[f"up_{x}"] == 0))
    facts = {PARENT: _PARENT, MESSAGE: _SENDS, TOOL: _ACTS, REWARD: _REWARDS, CREDIT: _CREDIT}
    return _statuses(per.select(
        "episode", F.size("a").cast("long").alias("n_agents"), *[has(bit).cast("int").alias(f"n_{k}") for k, bit in facts.items()], "message_wrong", "reward_wrong", "tool_strange", "tool_shared",
        has(_SENT_CLAIM).alias("message_claimed"), has(_TOOL_CLAIM).alias("tool_claimed"), has(_REWARD_CLAIM).alias("reward_claimed"), some(lambda m: m["policy"].isNull()).alias("unnamed"),
        F.size(F.filter(held, lambda m: m["parent_depth"] == 0)).alias("roots"), *[(F.col(f"{n}_wrong") | lost(x)).alias(f"{n}_wrong") for n, x, _, _ in names],
        *[some(lambda m: m[f"{n}_cyclic"]).alias(f"{n}_cyclic") for n, *_ in names], F.forall(held, lambda m: m["credited"]).alias("all_credited"), "members",
    ), "members")


def _solved(agents: DataFrame, relations: DataFrame) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """Graphs of episodes of few agents, with their members; and (graphs, members) of those of many, if there are any."""
    agents = agents.select(*KEY, "policy").filter(F.col("episode").isNotNull() & F.col("agent").isNotNull())
    relations = relations.filter(F.col("kind").isin(*KINDS) & F.col("episode").isNotNull())
    said = settle(_said(agents, relations), "said")
    many = settle(said.filter(F.col("bits").bitwiseAND(_IS) != 0).groupBy("episode").count().filter(F.col("count") > FEW).select("episode"), "many")
    if many.isEmpty():
        return _few(said), None
    of = lambda df: shuffled(df).join(many, "episode", "left_semi")
    return _few(said.join(many, "episode", "left_anti")), _many(of(agents), of(relations))


def graph(agents: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(graphs, members). A graph has its episode, the status of each field and of the whole; a member its parent's root and depth,
    whether its chain of credit ends at an owner of a reward, and what it owns.

    Parents: a source that is no agent, two parents of one, or a cycle are INVALID; one root is OBSERVED, several are
    INSUFFICIENT_EVIDENCE. Messages and rewards: an unknown agent is INVALID, a fact without evidence INSUFFICIENT. Tools: one tool of
    two owners is INVALID. Credit: as parents; OBSERVED where every chain ends at an owner of a reward.
    """
    few, many = _solved(agents, relations)
    graphs, members = few.drop("members"), few.select("episode", F.explode_outer("members").alias("m")).select("episode", "m.*")
    return (graphs.unionByName(many[0]), members.unionByName(many[1])) if many else (graphs, members)


def _many(agents: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same by joins, for episodes of any number of agents."""
    relations = settle(relations, "relations")
    agents = settle(agents.select(*KEY, "policy").dropDuplicates(KEY), "agents")
    members, wrong = agents, {}
    for kind, name in ((PARENT, "parent"), (CREDIT, "credit")):
        single = settle(agents.select(*KEY).join(_single(agents, relations, kind), KEY, "full"), "single")
        inside = agents.select(*KEY).join(single, KEY, "left")
        chains = closure(inside.select(*KEY, "up"))
        members = members.join(chains.select(*KEY, F.col("root").alias(f"{name}_root"), F.col("depth").alias(f"{name}_depth"), F.col("cyclic").alias(f"{name}_cyclic")), KEY).join(shuffled(inside.select(*KEY, F.col("unknown").isNotNull().alias(f"{name}_told"))), KEY)
        lost = single.join(agents.select(*KEY, F.lit(True).alias("is")), KEY, "left")
        wrong[name] = lost.groupBy("episode").agg(F.max(F.coalesce("unknown", F.lit(False)) | F.coalesce("several", F.lit(False)) | F.col("is").isNull()).alias(f"{name}_wrong"))
    known = agents.select("episode", F.col("agent").alias("source"), F.lit(True).alias("_s")), agents.select("episode", F.col("agent").alias("target"), F.lit(True).alias("_t"))
    facts = relations.join(known[0], ["episode", "source"], "left").join(known[1], ["episode", "target"], "left")
    kind = F.col("kind")
    strange = F.col("_s").isNull() | ((kind == MESSAGE) & F.col("_t").isNull())
    owned = facts.filter("_s").groupBy("episode", F.col("source").alias("agent")).agg(
        F.max(kind == MESSAGE).alias("sends"), F.max(kind == TOOL).alias("acts"), F.max((kind == REWARD) & F.col("evidence").isNotNull()).alias("rewarded")
    )
    told = facts.filter((kind == MESSAGE) & F.col("_t")).groupBy("episode", F.col("target").alias("agent")).agg(F.lit(True).alias("receives"))
    members = settle(members.join(shuffled(owned), KEY, "left").join(shuffled(told), KEY, "left").na.fill(False, ["sends", "acts", "rewarded", "receives"]), "members")
    owner = members.filter("rewarded").select("episode", F.col("agent").alias("credit_root"), F.lit(True).alias("_paid"))
    members = settle(members.join(owner, ["episode", "credit_root"], "left").withColumn("credited", F.coalesce("_paid", F.lit(False))).drop("_paid"), "members")
    tools = relations.filter(kind == TOOL).groupBy("episode", "target").agg((F.count_distinct("source") > 1).alias("shared")).groupBy("episode").agg(F.max("shared").alias("tool_shared"))
    # Relations may be many an episode: counted before anything is joined.
    of = lambda k, x: F.max(F.when(kind == k, x))
    per = facts.groupBy("episode").agg(
        *[F.count(F.when(kind == k, 1)).alias(f"n_{k}") for k in KINDS], of(MESSAGE, strange).alias("message_wrong"), of(REWARD, strange).alias("reward_wrong"), of(TOOL, strange).alias("tool_strange"),
        *[of(k, F.col("evidence").isNull()).alias(f"{n}_claimed") for k, n in ((MESSAGE, "message"), (REWARD, "reward"), (TOOL, "tool"))],
    )
    of_members = members.groupBy("episode").agg(
        F.count(F.lit(1)).alias("n_agents"), F.max(F.col("policy").isNull()).alias("unnamed"), F.count(F.when(F.col("parent_depth") == 0, 1)).alias("roots"),
        F.max("parent_cyclic").alias("parent_cyclic"), F.max("credit_cyclic").alias("credit_cyclic"), F.min("credited").alias("all_credited"),
    )
    every = of_members.join(per, "episode", "left").join(tools, "episode", "left").join(shuffled(wrong["parent"]), "episode", "left").join(shuffled(wrong["credit"]), "episode", "left")
    return settle(_statuses(every), "graphs"), members


def _statuses(every: DataFrame, *more: str) -> DataFrame:
    """Fields of graphs and their status, from what is known of an episode."""
    n = lambda k: F.col(f"n_{k}")
    fields = {
        "agent_identity": F.when(F.col("unnamed"), INSUFFICIENT).otherwise(OBSERVED),
        "parent_child": _field(n(PARENT), F.col("parent_wrong") | F.col("parent_cyclic"), F.col("roots") == 1),
        "message_routing": _field(n(MESSAGE), F.col("message_wrong"), ~F.col("message_claimed")),
        "tool_ownership": _field(n(TOOL), F.col("tool_shared") | F.col("tool_strange"), ~F.col("tool_claimed")),
        "reward_ownership": _field(n(REWARD), F.col("reward_wrong"), ~F.col("reward_claimed")),
        "credit_assignment": _field(n(CREDIT), F.col("credit_wrong") | F.col("credit_cyclic"), F.col("all_credited")),
    }
    every = every.select("episode", "n_agents", *[c.alias(k) for k, c in fields.items()], *more)
    required = F.array("agent_identity", "parent_child")
    # A single agent needs no parents.
    alone = (F.col("n_agents") == 1) & (F.col("parent_child") == NOT_OBSERVABLE)
    status = (
        F.when(F.exists(F.array(*fields), lambda x: x == INVALID), INVALID).when(alone, F.col("agent_identity")).when(F.array_contains(required, INSUFFICIENT), INSUFFICIENT)
        .when(F.array_contains(required, NOT_OBSERVABLE), NOT_OBSERVABLE).otherwise(OBSERVED)
    )
    return every.withColumn("status", status)


def training_views(agents: DataFrame, relations: DataFrame, episodes: DataFrame) -> DataFrame:
    """Per agent: what it is known to own, whether it may be learnt from (sft) and trained on policy (rl), and why not.

    episodes has episode, integrity, validity, task_status, target_policy and capabilities. An agent observes if a message leads to it
    or if it is a root of parents that are told, and acts if it owns a tool or sends a message."""
    few, many = _solved(agents, relations)
    of = ["episode", F.col("status").alias("graph_status"), "parent_child"]
    # Members are an array of their episode until it is joined; none is empty, but a plain explode would work them out once more, to filter.
    rows = few.select(*of, "members").join(shuffled(episodes), "episode", "left").select("*", F.explode_outer("members").alias("_m")).select("*", "_m.*").drop("members", "_m")
    if many:
        rows = rows.unionByName(many[1].join(many[0].select(*of), "episode").join(shuffled(episodes), "episode", "left"))
    sees = F.col("receives") | ((F.col("parent_depth") == 0) & (F.col("parent_child") == OBSERVED))
    acts = F.col("acts") | F.col("sends")
    has = lambda c: F.coalesce(F.array_contains("capabilities", c), F.lit(False))
    rules = {
        "INTEGRITY": ~F.col("integrity").eqNullSafe("COMPLETE"), "VALIDITY": ~F.col("validity").eqNullSafe("VALID"), "TASK_STATUS": ~F.col("task_status").eqNullSafe("SUCCESS"),
        "GRAPH_STATUS": F.col("graph_status") != OBSERVED, "OBSERVATION_OWNERSHIP": ~sees, "ACTION_OWNERSHIP": ~acts,
    }
    more = {
        "POLICY": F.col("policy").isNull() | ~F.col("policy").eqNullSafe(F.col("target_policy")), "REWARD_OWNERSHIP": ~F.col("rewarded"), "CREDIT_ASSIGNMENT": ~F.col("credited"),
        "MODEL_TOKEN_IDS": ~has("MODEL_TOKEN_IDS"), "MODEL_LOGPROBS": ~has("MODEL_LOGPROBS"),
    }
    codes = lambda named: F.filter(F.array(*[F.when(broken, F.lit(code)) for code, broken in named.items()]), lambda x: x.isNotNull())
    return rows.select(
        *KEY, "graph_status", "parent_root", "parent_depth", "parent_cyclic", sees.alias("observes"), acts.alias("acts"), "rewarded", "credited",
        codes(rules).alias("sft_reasons"), codes(rules | more).alias("rl_reasons"),
    ).withColumns({"sft": F.size("sft_reasons") == 0, "rl": F.size("rl_reasons") == 0})
