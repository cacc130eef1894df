"""From decisions to datasets and releases: compilation, policy fingerprints, attribution of failures, gates, bootstrap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .training import first_reason

#: What a policy is told apart by, and which of these are numbers.
POLICY_FIELDS = (
    "provider", "model_id", "base_model_revision", "adapter_revision", "tokenizer_revision", "chat_template_checksum", "tool_schema_checksum", "temperature", "top_p", "policy_generation",
)
POLICY_NUMBERS = ("temperature", "top_p")
#: What consumer profile a dataset's members need.
PURPOSES = ("SFT", "PREFERENCE", "OFF_POLICY_RL", "ON_POLICY_RL")


def compiled(artifacts: DataFrame, purpose: str) -> DataFrame:
    """Certified artifacts (episode, profile, verdict, decision_episode, bundle, decided_artifact, artifact, split, role) -> adds
    reason, empty for those that make members, and member_id, by which a manifest is sorted."""
    c = F.col
    rl = F.lit(purpose.endswith("_RL"))
    reason = first_reason([
        ("NOT_ELIGIBLE", c("verdict") == "ELIGIBLE"), ("PROFILE_DIFFERS", c("profile") == purpose), ("EPISODE_DIFFERS", c("episode") == c("decision_episode")),
        ("NOT_BOUND", ~rl | (c("bundle").isNotNull() & c("decided_artifact").isNotNull())), ("ARTIFACT_DIFFERS", ~rl | (c("artifact") == c("decided_artifact"))),
    ])
    member = F.sha2(F.concat_ws("|", *[c(x).cast("string") for x in ("episode", "artifact", "split", "role")]), 256)
    return artifacts.withColumn("reason", reason).withColumn("member_id", F.when(reason == "", member))


def missing_fields(policy: Column) -> Column:
    """Names of a policy's fields that are not there, in order, comma-joined."""
    return F.concat_ws(",", *[F.when(policy[f].isNull(), F.lit(f)) for f in POLICY_FIELDS])


def same_policy(a: Column, b: Column) -> Column:
    """Whether both policies are whole and agree, numbers up to 1e-9."""
    agree = F.lit(True)
    for f in POLICY_FIELDS:
        agree = agree & (F.abs(a[f] - b[f]) <= 1e-9 if f in POLICY_NUMBERS else a[f] == b[f])
    return F.coalesce(agree, F.lit(False))


def attributed(episodes: DataFrame) -> DataFrame:
    """Episodes (state, infra_component: of the earliest error or timeout, loops, decisions) -> cause, code and confidence of a
    failure, by the first rule that holds."""
    c = F.col
    said = lambda cause, code, p: F.struct(F.lit(cause).alias("cause"), F.lit(code).alias("code"), F.lit(p).alias("confidence"))
    rule = (
        F.when(c("state") == "CORRUPT", said("CAPTURE", "INTEGRITY_CORRUPT", 1.0))
        .when(c("infra_component").isNotNull(), F.struct(c("infra_component").alias("cause"), F.lit("INFRASTRUCTURE").alias("code"), F.lit(0.9).alias("confidence")))
        .when((c("loops") > 0) & c("decisions"), said("HARNESS", "TOOL_ERROR_FEEDBACK_LOSS", 0.8)).when(c("loops") > 0, said("UNKNOWN", "OBSERVED_TOOL_ERROR_LOOP", 0.5))
        .otherwise(said("UNKNOWN", "UNATTRIBUTED", 0.0))
    )
    return episodes.withColumn("_r", rule).select(*episodes.columns, "_r.*")


#: The reference policy of a release.
GATE = {"coverage": 1.0, "pairs": 3, "success_drop": 0.0, "token_ratio": 0.2, "latency_ratio": 0.25, "infra_increase": 0.0}


def gate(pairs: DataFrame, by: str) -> DataFrame:
    """Paired episodes (b_ and c_ success, tokens, latency, infra, loops; null where one is lacking) -> by slice: whether each rule
    holds and the verdict. Lacking pairs, coverage or measures are no rejection but insufficient evidence."""
    whole = F.col("b_success").isNotNull() & F.col("c_success").isNotNull()
    total = lambda c: F.sum(F.when(whole, F.col(c)))
    per = pairs.groupBy(by).agg(
        F.count("*").alias("n"), F.count(F.when(whole, 1)).alias("pairs"), *[total(f"{s}_{m}").alias(f"{s}_{m}") for m in ("success", "tokens", "latency", "infra", "loops") for s in "bc"],
        F.count(F.when(whole & (F.col("b_success") > F.col("c_success")), 1)).alias("regressions"), F.count(F.when(whole & (F.col("b_tokens").isNull() | F.col("c_tokens").isNull()), 1)).alias("unseen"),
    )
    c = F.col
    rules = {
        "success_ok": c("c_success") >= c("b_success") - GATE["success_drop"] * c("pairs"), "slice_ok": c("c_loops") < c("b_loops"), "tokens_ok": c("c_tokens") <= c("b_tokens") * (1 + GATE["token_ratio"]),
        "latency_ok": c("c_latency") <= c("b_latency") * (1 + GATE["latency_ratio"]), "infra_ok": c("c_infra") <= c("b_infra") + GATE["infra_increase"] * c("pairs"), "no_regression": c("regressions") == 0,
    }
    told = per.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in rules.items()})
    good = F.lit(True)
    for k in rules:
        good = good & c(k)
    enough = (c("pairs") >= GATE["pairs"]) & (c("pairs") >= GATE["coverage"] * c("n")) & (c("unseen") == 0)
    return told.select(by, "n", "pairs", *rules, F.when(~enough, "INSUFFICIENT_EVIDENCE").when(good, "ACCEPT").otherwise("REJECT").alias("verdict"))


#: Chances that a Poisson number of mean 1 is at most 0, 1, 2, ...
POISSON = (0.36787944117, 0.73575888234, 0.91969860292, 0.98101184312, 0.99634015317, 0.99940581518, 0.99991675885)


def bootstrap(rows: DataFrame, by: str, key: str, value: str, seeds: int = 20) -> DataFrame:
    """By group the mean of value and its percentile interval of 95 % over seeds resamplings. A row counts in each a Poisson
    number of times, from a digest of seed and key, so rows need no draw that knows them all."""
    drawn = rows.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    digest = F.sha2(F.concat_ws(":", F.col("seed").cast("string"), F.col(key).cast("string")), 256)
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    times = sum(((u > p).cast("int") for p in POISSON), F.lit(0))
    means = drawn.withColumn("times", times).groupBy(by, "seed").agg(F.try_divide(F.sum(F.col(value) * F.col("times")), F.sum("times")).alias("m"))
    bounds = means.groupBy(by).agg(F.round(F.percentile("m", F.lit(0.025)), 6).alias("low"), F.round(F.percentile("m", F.lit(0.975)), 6).alias("high"))
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean")).join(bounds, by)
