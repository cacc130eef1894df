"""Graphs of agents by hand: chains, cycles, strangers, several parents, shared tools, credit."""

import random

from tracemill.operators import agents

AGENTS = "episode string, agent string, policy string"
RELATIONS = "episode string, kind string, source string, target string, evidence string"
FACTS = "episode string, integrity string, validity string, task_status string, target_policy string, capabilities array<string>"
P, M, T, R, C = agents.KINDS


def graph_of(spark, members, relations):
    graphs, found = agents.graph(spark.createDataFrame(members, AGENTS), spark.createDataFrame(relations, RELATIONS))
    return {r.episode: r for r in graphs.collect()}, {(r.episode, r.agent): r for r in found.collect()}


def test_fields_of_graphs(spark):
    members = [(e, a, "p") for e in "abcdefg" for a in "xyz"] + [("one", "x", "p"), ("no", "x", None), ("no", "x", None)]
    chain = [(P, "x", "y", "1"), (P, "y", "z", "1")]
    relations = [("a", *r) for r in [*chain, (M, "x", "y", "1"), (R, "z", "r", "1"), (C, "z", "y", "1"), (C, "y", "x", None), (T, "x", "t1", "1"), (T, "y", "t2", None), ("ODD", "q", "q", "1")]]
    relations += [("b", P, "x", "y", "1"), ("b", P, "y", "x", "1"), ("b", P, "x", "z", "1")]
    relations += [("c", *r) for r in chain] + [("c", P, "x", "z", "2"), ("c", T, "x", "t", "1"), ("c", T, "y", "t", "1")]
    relations += [("d", P, "ghost", "y", "1"), ("d", M, "x", "ghost", "1"), ("e", P, "x", "y", "1"), ("e", M, "x", "z", None), ("f", *chain[0]), ("f", *chain[0]), ("f", *chain[1]), ("g", C, "x", "x", "1")]
    graphs, found = graph_of(spark, members, relations)
    assert {e: (g.parent_child, g.status) for e, g in graphs.items()} == {
        "a": (agents.OBSERVED, agents.OBSERVED), "b": (agents.INVALID, agents.INVALID), "c": (agents.INVALID, agents.INVALID), "d": (agents.INVALID, agents.INVALID), "e": (agents.INSUFFICIENT, agents.INSUFFICIENT),
        "f": (agents.OBSERVED, agents.OBSERVED), "g": (agents.NOT_OBSERVABLE, agents.INVALID), "one": (agents.NOT_OBSERVABLE, agents.OBSERVED), "no": (agents.NOT_OBSERVABLE, agents.INSUFFICIENT),
    }
    a = graphs["a"]
    assert (a.message_routing, a.tool_ownership, a.reward_ownership, a.credit_assignment) == (agents.OBSERVED, agents.INSUFFICIENT, agents.OBSERVED, agents.OBSERVED)
    assert graphs["c"].tool_ownership == graphs["d"].message_routing == graphs["g"].credit_assignment == agents.INVALID and graphs["e"].message_routing == agents.INSUFFICIENT
    assert [found["a", x].parent_depth for x in "xyz"] == [0, 1, 2] and found["a", "x"].credited and found["b", "z"].parent_cyclic and graphs["no"].n_agents == 1


def test_a_long_chain_a_star_and_a_long_cycle(spark):
    members = [("chain", f"{i:04d}", "p") for i in range(1000)] + [("star", f"{i:04d}", "p") for i in range(1000)] + [("ring", f"{i:04d}", "p") for i in range(777)]
    relations = [("chain", P, f"{i:04d}", f"{i + 1:04d}", "1") for i in range(999)] + [("star", P, "0000", f"{i:04d}", "1") for i in range(1, 1000)] + [("ring", P, f"{i:04d}", f"{(i + 1) % 777:04d}", "1") for i in range(777)]
    graphs, found = graph_of(spark, members, relations)
    assert {e: g.status for e, g in graphs.items()} == {"chain": agents.OBSERVED, "star": agents.OBSERVED, "ring": agents.INVALID}
    assert all(found["chain", f"{i:04d}"].parent_depth == i and found["chain", f"{i:04d}"].parent_root == "0000" for i in range(1000))
    assert all(found["ring", f"{i:04d}"].parent_cyclic for i in range(777))


def test_views_and_their_reasons(spark):
    relations = [("a", P, "x", "y", "1"), ("a", M, "x", "y", "1"), ("a", T, "y", "t", "1"), ("a", R, "y", "r", "1"), ("a", C, "y", "x", "1")]
    facts = [("a", "COMPLETE", "VALID", "SUCCESS", "p", ["MODEL_TOKEN_IDS", "MODEL_LOGPROBS"])]
    views = {r.agent: r for r in agents.training_views(spark.createDataFrame([("a", "x", "p"), ("a", "y", "q"), ("b", "z", "p")], AGENTS), spark.createDataFrame(relations, RELATIONS), spark.createDataFrame(facts, FACTS)).collect()}
    assert (views["x"].sft, views["x"].rl, views["x"].rl_reasons) == (True, False, ["REWARD_OWNERSHIP"]) and (views["y"].sft, views["y"].rl_reasons) == (True, ["POLICY"])
    assert views["z"].sft_reasons == ["INTEGRITY", "VALIDITY", "TASK_STATUS", "OBSERVATION_OWNERSHIP", "ACTION_OWNERSHIP"] and "MODEL_TOKEN_IDS" in views["z"].rl_reasons
    empty = agents.training_views(spark.createDataFrame([], AGENTS), spark.createDataFrame([], RELATIONS), spark.createDataFrame([], FACTS))
    assert empty.collect() == []


def test_no_side_of_a_join_is_broadcast_by_its_size(spark):
    relations = spark.createDataFrame([("a", P, "x", "y", "1"), ("a", R, "y", "r", "1"), ("a", C, "y", "x", "1")], RELATIONS)
    views = agents.training_views(spark.createDataFrame([("a", "x", "p"), ("a", "y", "q")], AGENTS), relations, spark.createDataFrame([("a", "COMPLETE", "VALID", "SUCCESS", "p", ["MODEL_TOKEN_IDS"])], FACTS))
    views.collect()
    assert "Broadcast" not in views._jdf.queryExecution().executedPlan().toString()


def some_graphs(seed=4):
    """Episodes of up to six agents, with every kind of relation between agents, strangers and nobody."""
    draw = random.Random(seed)
    members = [(f"e{e}", f"a{a}", draw.choice("pq")) for e in range(150) for a in range(draw.randint(1, 6))]
    names = [*(f"a{a}" for a in range(6)), *(f"a{a}" for a in range(4)), None]
    relations = [(f"e{e}", draw.choice(agents.KINDS), draw.choice(names), draw.choice([*names, "t1", "t2"]), draw.choice(["1", "1", None])) for e in range(150) for _ in range(draw.randint(0, 5))]
    for e in range(100, 150):  # Chains, with a cycle now and then
        relations += [(f"e{e}", kind, f"a{a - 1 if draw.random() < 0.9 else draw.randint(0, 5)}", f"a{a}", "1") for kind in (P, C) for a in range(1, 6)]
    facts = [(f"e{e}", draw.choice(["COMPLETE", None]), "VALID", draw.choice(["SUCCESS", "FAILURE"]), "p", ["MODEL_TOKEN_IDS"]) for e in range(0, 150, 2)]
    return [m if i % 40 else (*m[:2], None) for i, m in enumerate(members)] + [("e0", None, "p"), (None, "a0", "p")], relations + [(None, P, "a0", "a1", "1")], facts


def test_few_and_many_agents_are_solved_alike(spark, monkeypatch):
    members, relations, facts = some_graphs()
    inputs = spark.createDataFrame(members, AGENTS), spark.createDataFrame(relations, RELATIONS)
    found = []
    for few in (64, 2):
        monkeypatch.setattr(agents, "FEW", few)
        graphs, held = agents.graph(*inputs)
        views = agents.training_views(*inputs, spark.createDataFrame(facts, FACTS))
        found.append([sorted(map(repr, df.select(*sorted(df.columns)).collect())) for df in (graphs, held, views)])
    assert found[0] == found[1]
    statuses = {r.status for r in graphs.collect()}
    assert statuses == {agents.OBSERVED, agents.INSUFFICIENT, agents.NOT_OBSERVABLE, agents.INVALID} and held.filter("credited").count() and held.filter("parent_depth > 1").count()


def test_few_agents_take_few_shuffles(spark):
    members, relations, facts = some_graphs()
    views = agents.training_views(spark.createDataFrame(members, AGENTS), spark.createDataFrame(relations, RELATIONS), spark.createDataFrame(facts, FACTS))
    views.collect()
    assert views._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange ") == 2


def test_graphs_alone_write_no_members(spark):
    members, relations, _ = some_graphs()
    graphs, _ = agents.graph(spark.createDataFrame(members, AGENTS), spark.createDataFrame(relations, RELATIONS))
    assert "members" not in graphs.columns and all("/said-" in f for f in graphs.inputFiles())
    assert graphs.count() == 150
