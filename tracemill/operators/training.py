"""From certified episodes to training data: pairing of calls, token sequences, trajectory quality, admission, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import percentiles
from ..sources.scratch import hinted, settle


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The code of the first rule that does not hold (a null counts as not holding); empty if all do."""
    out = F.lit("")
    for code, holds in reversed(rules):
        out = F.when(~F.coalesce(holds, F.lit(False)), F.lit(code)).otherwise(out)
    return out


def pairing(messages: DataFrame) -> DataFrame:
    """Messages (trajectory, position, role, call) with calls of assistants and results of tools -> per trajectory: calls,
    results that meet a call of the turn before them, results without one, calls without result, repeated calls.

    A turn is what follows one assistant message up to the next; calls and results of a turn meet by grouping.
    """
    order = Window.partitionBy("trajectory").orderBy("position")
    turns = messages.withColumn("turn", F.sum((F.col("role") == "assistant").cast("long")).over(order))
    called, got = F.count(F.when(F.col("role") == "assistant", 1)), F.count(F.when(F.col("role") == "tool", 1))
    met = turns.filter("call is not null").groupBy("trajectory", "turn", "call").agg(called.alias("c"), got.alias("r"))
    per = met.groupBy("trajectory").agg(
        F.sum("c").alias("calls"), F.sum(F.least("c", "r")).alias("matched"), F.sum(F.greatest(F.col("r") - F.col("c"), F.lit(0))).alias("stray_results"),
        F.sum(F.greatest(F.col("c") - F.col("r"), F.lit(0))).alias("open_calls"), F.count_distinct(F.when(F.col("c") > 0, F.col("call"))).alias("distinct_calls"),
    )
    return per.withColumn("paired", (F.col("stray_results") == 0) & (F.col("open_calls") == 0) & (F.col("distinct_calls") == F.col("calls")))


def suppressed(turns: DataFrame) -> DataFrame:
    """Turns (trajectory, position, signature, has_text) -> those that stay: with a text, or a signature not seen before
    in the trajectory. The first position of a signature is a grouping, not a window."""
    first = turns.filter("signature is not null").groupBy("trajectory", "signature").agg(F.min("position").alias("first"))
    seen = turns.join(first, ["trajectory", "signature"], "left")
    return seen.filter(F.col("has_text") | (F.col("position") == F.col("first"))).select(*turns.columns)


def quality(steps: DataFrame) -> DataFrame:
    """Steps (trajectory, signature, failed, result) -> per trajectory: counts, rates, score and the reason not to take it."""
    share = lambda a: F.coalesce(F.try_divide(F.col(a), F.col("tool_steps")), F.lit(0.0))
    per = steps.groupBy("trajectory").agg(
        F.count("signature").alias("tool_steps"), F.count(F.when(F.col("failed"), 1)).alias("errors"), F.count_distinct("signature").alias("distinct"),
        F.count(F.when(F.col("signature").isNotNull() & F.col("result").isNull(), 1)).alias("unpaired"), F.count("*").alias("messages"),
    )
    per = per.withColumn("duplicates", F.col("tool_steps") - F.col("distinct")).withColumn("error_rate", share("errors")).withColumn("duplicate_rate", share("duplicates"))
    over = lambda c, n: F.greatest(F.col(c) - n, F.lit(0))
    lost = F.col("error_rate") * 0.35 + F.col("duplicate_rate") * 0.25 + over("tool_steps", 48) / 96 * 0.2 + over("messages", 96) / 200 * 0.2
    reason = first_reason([
        ("UNPAIRED_STEPS", F.col("unpaired") == 0), ("TOO_MANY_STEPS", F.col("tool_steps") <= 96), ("ERROR_RATE", F.col("error_rate") <= 0.35),
        ("DUPLICATE_RATE", F.col("duplicate_rate") <= 0.4), ("TOO_MANY_MESSAGES", F.col("messages") <= 200),
    ])
    return per.withColumn("score", F.round(F.greatest(F.lit(0.0), 1 - lost), 6)).withColumn("reason", reason).withColumns({c: F.round(c, 6) for c in ("error_rate", "duplicate_rate")})


def sequences(calls: DataFrame) -> DataFrame:
    """Model calls (episode, position, prompt, response: arrays of tokens) -> per episode: tokens and mask of the training
    sequence and its rounds; null where a call rewrote history.

    A call's prompt must begin with the one before and its response; what it adds is context, masked out. One window
    by episode brings neighbours together; what is gathered is the episode's own sequence.
    """
    order = Window.partitionBy("episode").orderBy("position")
    following = F.lead("prompt").over(order)
    paired = calls.withColumn("following", following).withColumn("upto", F.concat("prompt", "response"))
    kept = F.slice("following", 1, F.size("upto")) == F.col("upto")
    rest = F.slice("following", F.size("upto") + 1, F.greatest(F.size("following") - F.size("upto"), F.lit(0)))
    told = paired.select(
        "episode", "position", F.col("following").isNull().alias("last"), F.coalesce(kept, F.col("following").isNull()).alias("whole"),
        "response", F.when(F.col("following").isNotNull(), rest).otherwise(F.array().cast("array<bigint>")).alias("suffix"),
    )
    ones, zeros = F.array_repeat(F.lit(1), F.size("response")), F.array_repeat(F.lit(0), F.size("suffix"))
    parts = F.array_sort(F.collect_list(F.struct("position", F.concat("response", "suffix").alias("t"), F.concat(ones, zeros).alias("m"))))
    per = told.groupBy("episode").agg(F.min("whole").alias("trainable"), parts.alias("parts"), F.count(F.when(F.size("suffix") > 0, 1)).alias("rounds"))
    flat = lambda c: F.when(F.col("trainable"), F.flatten(F.transform("parts", lambda p: p[c])))
    return per.select("episode", "trainable", flat("t").alias("tokens"), flat("m").alias("mask"), "rounds")


def first_difference(a: Column, b: Column) -> Column:
    """The first place, from 0, where two arrays differ; null if they agree as far as both go."""
    both = F.least(F.size(a), F.size(b))
    places = F.filter(F.when(both > 0, F.sequence(F.lit(0), both - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.get(a, i) != F.get(b, i))
    return F.get(places, F.lit(0))


def drift(tokens: DataFrame, by: str, mean_limit: float = 0.05, p99_limit: float = 0.5) -> DataFrame:
    """Tokens with a and b (log-probabilities) and mask -> by group: mean, max and quantiles of the absolute difference over
    masked-in tokens, and whether it is within limits."""
    gaps = tokens.filter("mask > 0").select(by, F.abs(F.col("a") - F.col("b")).alias("gap"))
    per = gaps.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("n"), F.avg("gap").alias("mean"), F.max("gap").alias("max"))
    ranks = percentiles(gaps, by, "gap", {f"p{round(q * 100)}": q for q in (0.5, 0.9, 0.95, 0.99)})
    per = per.join(ranks, F.col("_by").eqNullSafe(F.col(by)), "left").select(F.col("_by").alias(by), "n", "mean", "max", "p50", "p90", "p95", "p99")
    ok = (F.col("mean") <= mean_limit) & (F.col("p99") <= p99_limit)
    return per.withColumn("within", ok).withColumns({c: F.round(c, 6) for c in ("mean", "max", "p50", "p90", "p95", "p99")})


def admitted(members: DataFrame, decisions: DataFrame, bundles: DataFrame, artifacts: DataFrame, same_episode: Column | None = None, same_bundle: Column | None = None, bound: Column | None = None) -> DataFrame:
    """Members (member, episode, certification, bundle, artifact, group, policy) joined by checksum with what they cite ->
    the first reason, empty if none, why a member may not train. The last three say how episodes and artifacts are
    compared with what a decision (decision_episode) and a bundle (bundle_episode, bound) name, by default as they are."""
    joined = (
        members.join(decisions, members["certification"] == decisions["decision"], "left").join(bundles, members["bundle"] == bundles["bundle_sum"], "left")
        .join(artifacts, members["artifact"] == artifacts["artifact_sum"], "left")
    )
    c, plain = F.col, lambda given, usual: usual if given is None else given
    reason = first_reason([
        ("DECISION_MISSING", c("decision").isNotNull()), ("NOT_ELIGIBLE", c("verdict") == "ELIGIBLE"), ("DECISION_EPISODE_DIFFERS", plain(same_episode, c("decision_episode") == c("episode"))),
        ("BUNDLE_MISSING", c("bundle_sum").isNotNull()), ("ARTIFACT_MISSING", c("artifact_sum").isNotNull()), ("BUNDLE_EPISODE_DIFFERS", plain(same_bundle, c("bundle_episode") == c("episode"))),
        ("ARTIFACT_NOT_BOUND", plain(bound, F.array_contains("bound", c("artifact")))), ("ARTIFACT_NOT_COMPLETED", c("status") == "COMPLETED"), ("NO_GROUP_OR_POLICY", c("group").isNotNull() & c("policy").isNotNull()),
    ])
    return joined.withColumn("reason", reason).select(*members.columns, "reason")


def admitted_only(members: DataFrame, decisions: DataFrame, bundles: DataFrame, artifacts: DataFrame, same_episode: Column | None = None, same_bundle: Column | None = None, bound: Column | None = None) -> DataFrame:
    """The members to whom `admitted` gives no reason. What breaks a rule is left out where that rule can be told, so it is not
    shuffled to the next table; a side of few rows is broadcast."""
    c, plain = F.col, lambda given, usual: usual if given is None else given
    named = members.filter(c("group").isNotNull() & c("policy").isNotNull())
    bundled = named.join(hinted(bundles), named["bundle"] == bundles["bundle_sum"]).filter(plain(same_bundle, c("bundle_episode") == c("episode")) & plain(bound, F.array_contains("bound", c("artifact")))).select(*members.columns)
    eligible, completed = hinted(decisions.filter("verdict = 'ELIGIBLE'")), hinted(artifacts.filter("status = 'COMPLETED'"))
    decided = bundled.join(eligible, c("certification") == c("decision")).filter(plain(same_episode, c("decision_episode") == c("episode"))).select(*members.columns)
    return decided.join(completed, c("artifact") == c("artifact_sum")).select(*members.columns)


def batch_gate(members: DataFrame, least: int = 4) -> DataFrame:
    """Admitted members (group, episode, policy, reward) -> one row: whether they make a batch, and why not."""
    members = settle(members.select("group", "episode", "policy", "reward"), "batch")
    groups = members.groupBy("group").agg(F.count_distinct("episode").alias("size"))
    small = groups.agg(F.count(F.when(F.col("size") < least, 1)).alias("undersized"), F.count("*").alias("groups"))
    whole = members.agg(F.count_distinct("policy").alias("policies"), F.count_distinct("reward").alias("rewards"), F.count("*").alias("members"))
    reason = first_reason([
        ("EMPTY", F.col("members") > 0), ("MIXED_POLICIES", F.col("policies") == 1), ("UNDERSIZED_GROUPS", F.col("undersized") == 0), ("NO_REWARD_VARIANCE", F.col("rewards") > 1),
    ])
    return whole.crossJoin(small).withColumn("reason", reason)  # one row each


def paired_controls(baseline: DataFrame, candidate: DataFrame, key: str, controls: list[str]) -> DataFrame:
    """Baseline and candidate attempts by key, and the names of the controls in which they differ."""
    both = baseline.alias("b").join(candidate.alias("c"), key, "full")
    here = lambda side: F.col(f"{side}.solved").isNotNull()
    differs = F.concat_ws(",", *[F.when(~F.col(f"b.{x}").eqNullSafe(F.col(f"c.{x}")), F.lit(x)) for x in controls])
    state = F.when(~here("b"), "NO_BASELINE").when(~here("c"), "NO_CANDIDATE").when(differs != "", "CONTROLS_DIFFER").otherwise("PAIRED")
    delta = F.when(state == "PAIRED", F.col("c.solved") - F.col("b.solved"))
    return both.select(key, state.alias("state"), F.when(here("b") & here("c"), differs).otherwise("").alias("differs"), delta.alias("delta"))


def every(rows: DataFrame, key: str, holds: Column) -> DataFrame:
    """Keys all of whose rows hold; a key without rows is not there."""
    return rows.groupBy(key).agg(F.min(F.coalesce(holds, F.lit(False))).alias("all")).filter("all").select(key)


def stage_times(stages: DataFrame, order: tuple[str, ...], now: str) -> DataFrame:
    """Stages (key, stage, at) -> per key the seconds from each stage to the next (missing: until now), at least 0, and
    whether the stages were entered in order."""
    at = lambda s: F.min(F.when(F.col("stage") == s, F.col("at")))
    per = stages.groupBy("key").agg(*[at(s).alias(s) for s in order])
    end = lambda i: F.coalesce(*[F.col(s) for s in order[i + 1 :]], F.lit(now).cast("timestamp"))
    seconds = lambda i: F.greatest(F.lit(0).cast("long"), F.unix_micros(end(i).cast("timestamp")) - F.unix_micros(F.col(order[i]).cast("timestamp")))
    sorted_ = F.lit(True)
    for a, b in zip(order, order[1:]):
        sorted_ = sorted_ & F.coalesce(F.col(a) <= F.col(b), F.lit(True))
    spent = [F.floor(F.when(F.col(s).isNotNull(), seconds(i)) / 1_000_000).alias(f"{s.lower()}_s") for i, s in enumerate(order[:-1])]
    return per.select("key", *spent, sorted_.alias("in_order"))


def quotas(pool: DataFrame, stratum: str, key: str, shares: dict[str, float], total: int, seed: str) -> DataFrame:
    """A draw of total keys by strata's shares, by a seeded digest; what a stratum lacks is filled from all that are left,
    and as many again of the rest are held out. part is DRAWN, FILLED or HELD_OUT."""
    digest = F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)
    dealt = pool.select(stratum, key, digest.alias("d"))
    quota = F.coalesce(*[F.when(F.col(stratum) == s, F.lit(round(total * share))) for s, share in shares.items()], F.lit(0))
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy(stratum).orderBy("d")))
    # No more than total keys a stratum can matter beyond its quota, so the last sort is of a bounded number.
    near = ranked.filter(F.col("rank") <= quota + 2 * total).withColumn("drawn", F.col("rank") <= quota)
    picked = near.agg(F.count(F.when(F.col("drawn"), 1)).alias("have"))
    left = near.filter("not drawn").orderBy("d").limit(2 * total).withColumn("place", F.row_number().over(Window.orderBy("d")))
    part = F.when(F.col("place") <= total - F.col("have"), "FILLED").when(F.col("place") <= 2 * total - F.col("have"), "HELD_OUT")
    rest = left.crossJoin(picked).select(stratum, key, part.alias("part")).filter("part is not null")  # picked is one row
    return near.filter("drawn").select(stratum, key, F.lit("DRAWN").alias("part")).unionByName(rest)


def partial_credit(passed: Column, total: Column) -> Column:
    """1 for all tests, 0.2 and up to 0.6 more for some, 0 for none."""
    return F.when((total > 0) & (passed == total), 1.0).when(passed > 0, F.round(0.2 + 0.6 * passed / total, 4)).otherwise(0.0)


def accumulation(examples: Column) -> Column:
    """The first of 3, 4, 5, 2, 1 that divides the number of examples."""
    return F.coalesce(*[F.when(examples % n == 0, F.lit(n)) for n in (3, 4, 5, 2, 1)])


def episode_metrics(actions: DataFrame) -> DataFrame:
    """Actions (episode, kind, failed, signature, at, place, latency_ms, tokens) -> an episode's measures; what was not observed is
    null and named. A call repeats if its signature is that of the call before it, by at and place; a loop is a run of repeats."""
    call = F.col("kind") == "TOOL_CALL"
    order = Window.partitionBy("episode", call).orderBy("at", "place")
    same = call & F.coalesce(F.lag("signature").over(order) == F.col("signature"), F.lit(False))
    actions = actions.withColumn("repeat", same).withColumn("opens", F.col("repeat") & ~F.coalesce(F.lag("repeat").over(order), F.lit(False)))
    total = lambda k: F.sum(F.when(F.col("kind") == k, F.col("latency_ms")))
    per = actions.groupBy("episode").agg(
        ((F.unix_micros(F.max("at").cast("timestamp")) - F.unix_micros(F.min("at").cast("timestamp"))) / 1000.0).alias("duration_ms"),
        F.count(F.when(F.col("kind") == "MODEL_REQUEST", 1)).alias("turn_count"), F.count(F.when(F.col("kind") == "VERIFICATION_FINISHED", 1)).alias("verification_attempts"),
        F.count(F.when(call, 1)).alias("calls"), F.count(F.when((F.col("kind") == "TOOL_RESULT") & F.col("failed"), 1)).alias("errors"), F.count(F.when(F.col("repeat"), 1)).alias("repeats"), F.count(F.when(F.col("opens"), 1)).alias("loops"),
        F.sum("tokens").alias("tokens"), total("MODEL_RESPONSE").alias("model_latency_ms"), total("TOOL_RESULT").alias("tool_latency_ms"), total("VERIFICATION_FINISHED").alias("verifier_latency_ms"),
    )
    seen = F.col("calls") > 0
    lacking = F.concat_ws(",", F.when(~seen, "tool_call_count"), F.when(~seen, "tool_error_count"), F.when(~seen, "duplicate_action_rate"), F.when(F.col("tokens").isNull(), "tokens"), F.lit("estimated_cost"))
    return per.select(
        "episode", "duration_ms", "turn_count", "verification_attempts", F.when(seen, F.col("calls")).alias("tool_call_count"), F.when(seen, F.col("errors")).alias("tool_error_count"),
        F.when(seen, F.col("repeats")).alias("duplicate_action_count"), F.when(seen, F.round(F.col("repeats") / F.col("calls"), 6)).alias("duplicate_action_rate"), F.when(seen, F.col("loops")).alias("loop_count"),
        "tokens", "model_latency_ms", "tool_latency_ms", "verifier_latency_ms", lacking.alias("not_observable"),
    )
