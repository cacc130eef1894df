"""Training views of canonical actions, evidence bundles, and the small forms that reports and scans need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .training import first_reason


def rendered(tool: Column, arguments: Column, style: str) -> Column:
    """A tool call as JSON in one of three styles; arguments is a JSON object."""
    name = F.to_json(F.struct(tool.alias("v")))
    quoted = F.regexp_extract(name, r'^\{"v":(.*)\}$', 1)
    if style == "openai":
        inner = F.regexp_extract(F.to_json(F.struct(arguments.alias("v"))), r'^\{"v":(.*)\}$', 1)
        return F.concat(F.lit('{"type":"function","function":{"name":'), quoted, F.lit(',"arguments":'), inner, F.lit("}}"))
    key = {"qwen": "name", "json": "action_type"}[style]
    return F.concat(F.lit(f'{{"{key}":'), quoted, F.lit(',"arguments":'), arguments, F.lit("}"))


def examples(actions: DataFrame, statements: DataFrame, workspace: str = "/ws/repo") -> DataFrame:
    """Actions (episode, task, position, tool, arguments, status, observation) -> one training example each: the prompt of task,
    statement and history before it, what is expected, and a hash.

    The history is part of each example's text, so an episode's examples hold the square of its actions; the window that
    gathers it is by episode. Tasks are joined by their id, or by the episode's where that has no statement.
    """
    order = Window.partitionBy("episode").orderBy("position")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.replace("observation", F.lit(workspace), F.lit("$WORKSPACE"))
    line = F.concat(F.lit("  "), F.col("tool"), F.lit("("), F.col("arguments"), F.lit(") -> "), F.when(F.col("status") == "SUCCEEDED", "ok").otherwise(F.lower("status")), F.lit("\n    observation: "), seen)
    done = F.row_number().over(order) - 1
    history = F.when(done == 0, "(no prior actions)").otherwise(F.array_join(F.collect_list(line).over(before), "\n"))
    told = actions.withColumn("done", done).withColumn("history", history)
    own = statements.select(F.col("id").alias("task"), F.col("statement").alias("_by_task"))
    other = statements.select(F.col("id").alias("episode"), F.col("statement").alias("_by_episode"))
    text = F.when(F.col("_by_task").rlike(r"(?U)\S"), F.col("_by_task")).when(F.col("_by_episode").rlike(r"(?U)\S"), F.col("_by_episode"))
    joined = told.join(own, "task", "left").join(other, "episode", "left").withColumn("statement", F.trim(text))
    prompt = F.concat(
        F.lit("Task id: "), F.col("task").cast("string"), F.lit("\n\nProblem statement:\n"), F.col("statement"), F.lit("\n\nProgress so far ("), F.col("done").cast("string"), F.lit(" completed action):\n"), F.col("history"),
        F.lit("\n\nChoose the next canonical action."),
    )
    expected = rendered(F.col("tool"), F.col("arguments"), "json")
    made = joined.select("episode", "task", "position", prompt.alias("prompt"), expected.alias("expected"))
    return made.withColumn("sha256", F.sha2(F.concat_ws("\n", "prompt", "expected"), 256))


def distinct_examples(made: DataFrame) -> DataFrame:
    """Of equal examples the first by episode and position; examples without a statement are left out."""
    head = made.filter("prompt is not null").groupBy("sha256").agg(F.min(F.struct("episode", "position", "task", "prompt", "expected")).alias("e"))
    return head.select("sha256", "e.*")


def bundles(identities: DataFrame, artifacts: DataFrame, sources: DataFrame) -> DataFrame:
    """Identities (run, episode, attempt, verifier_report) with their producers' artifacts (the same key, checksum, tokens, verifies)
    and supplied sources (the same key, checksum) -> sorted source and policy checksums, and why there is no bundle."""
    key = ["run", "episode", "attempt"]
    per = artifacts.groupBy(*key).agg(
        F.count("*").alias("n"), F.sort_array(F.collect_set("checksum")).alias("own"), F.sort_array(F.collect_list(F.when(F.col("tokens"), F.col("checksum")))).alias("policies"), F.max("verifies").alias("verifies"),
    )
    given = sources.groupBy(*key).agg(F.collect_set("checksum").alias("given"))
    both = identities.join(per, key, "left").join(given, key, "left")
    reason = first_reason([
        ("NO_PRODUCER_ARTIFACT", F.col("n") > 0), ("REPEATED_ARTIFACT", F.size("own") == F.col("n")), ("VERIFIER_REPORT_MISSING", ~F.col("verifies") | F.col("verifier_report").isNotNull()),
    ])
    none = F.array().cast("array<string>")
    whole = F.array_sort(F.array_union(F.coalesce("own", none), F.coalesce("given", none)))
    return both.select(*key, F.array_join(whole, ",").alias("source_checksums"), F.array_join(F.coalesce("policies", none), ",").alias("policy_checksums"), reason.alias("reason"))


def bound_groups(episodes: DataFrame) -> DataFrame:
    """Episodes (group, episode, task) -> per group: episodes without a task, distinct tasks, and whether it has exactly one."""
    per = episodes.groupBy("group").agg(F.count(F.when(F.col("task").isNull(), 1)).alias("unbound"), F.count_distinct("task").alias("tasks"))
    return per.withColumn("bound", (F.col("unbound") == 0) & (F.col("tasks") == 1))


def preflight(traces: DataFrame) -> DataFrame:
    """Traces (group, reward, mask) -> one row: traces, groups, groups whose rewards differ, trainable tokens, mean reward."""
    tokens = F.aggregate("mask", F.lit(0).cast("long"), lambda s, m: s + m)
    per = traces.groupBy("group").agg(F.count("*").alias("n"), F.count_distinct("reward").alias("rewards"), F.sum(tokens).alias("tokens"), F.sum("reward").alias("sum"))
    return per.agg(
        F.sum("n").alias("traces"), F.count("*").alias("groups"), F.count(F.when(F.col("rewards") > 1, 1)).alias("groups_with_variance"), F.sum("tokens").alias("tokens"), F.round(F.sum("sum") / F.sum("n"), 6).alias("mean_reward"),
    )


def millis(moment: Column) -> Column:
    """Milliseconds of a timestamp text, cut; null for what is none."""
    return F.unix_millis(F.try_to_timestamp(moment))


def percent(value: Column) -> Column:
    return F.when(value.isNull(), "n/a").otherwise(F.concat(F.format_string("%.2f", value * 100), F.lit("%")))


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of JSON documents, one a file, with the file each comes from."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.element_at(F.split("_metadata.file_path", "/"), -1))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """CSV samples of name and a percentage: headers and bad rows are left out."""
    rows = spark.read.schema("name string, share string").csv(path)
    value = F.regexp_replace("share", r"\s*%\s*$", "").try_cast("double")
    return rows.select("name", value.alias("share")).filter("share is not null")


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Text logs, one a file: wall time, reward and whether it is done."""
    text = spark.read.text(path, wholetext=True)
    part = lambda p: F.regexp_extract("value", p, 1)
    return text.select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), part(r"wall[_ ]time[=:]\s*([0-9.]+)").try_cast("double").alias("wall_s"), part(r"reward[=:]\s*(-?[0-9.]+)").try_cast("double").alias("reward"),
        F.col("value").rlike(r"(?m)^DONE\b").alias("done"),
    )


def verified_objects(refs: DataFrame, files: DataFrame) -> DataFrame:
    """References (artifact, file, sha256, size) with the files' contents (file, content) -> the reason, empty if none, why one
    does not hold."""
    joined = refs.join(files.select("file", F.sha2("content", 256).alias("_sha"), F.octet_length("content").alias("_size")), "file", "left")
    reason = first_reason([("FILE_MISSING", F.col("_sha").isNotNull()), ("SIZE_DIFFERS", F.col("size") == F.col("_size")), ("CONTENT_DIFFERS", F.col("sha256") == F.col("_sha"))])
    return joined.select("artifact", reason.alias("reason"))
