"""Reasons against examples, from groups, against a machine that reads each chat in order."""

import random
from collections import Counter

from pyspark.sql import functions as F

from tracemill.functions import prefix
from tracemill.operators import pairing

MESSAGES = "trajectory string, position long, role string, calls array<string>, call string"
STEPS = "trajectory string, tool_call_id string, has_content boolean, has_result boolean"
EXAMPLES = "trajectory string, final_answer string, verdict string"


def read(messages, steps, final, verdict):
    out = [] if (final or "").strip() else ["EMPTY_FINAL_ANSWER"]
    out += [] if verdict == "ELIGIBLE" else ["NOT_ELIGIBLE"]
    out += [] if messages else ["NO_MESSAGES"]
    lacking = sum(content and not result for _, content, result in steps)
    out += [("STEPS_WITHOUT_RESULT", str(lacking))] if lacking else []
    pending, seen_calls, seen_results = [], set(), set()
    for role, calls, call in messages:
        if role == "assistant":
            out += ["DECISION_BEFORE_OBSERVATIONS"] if pending else []
            pending = []
            for c in calls or ():
                if c is None:
                    out.append("CALL_WITHOUT_ID")
                    continue
                out += [("REPEATED_CALL_ID", c)] if c in seen_calls else []
                seen_calls.add(c)
                pending.append(c)
        elif role == "tool":
            if call is None or call not in pending:
                out.append(("OBSERVATION_WITHOUT_CALL", call) if call else "OBSERVATION_WITHOUT_CALL")
            elif call in seen_results:
                out.append(("REPEATED_OBSERVATION", call))
            else:
                pending.remove(call)
                seen_results.add(call)
    out += [("OBSERVATIONS_MISSING", str(len(pending)))] if pending else []
    ids = {i for i, _, _ in steps if i is not None}
    if messages:
        out += ["CALLS_AND_STEPS_DISAGREE"] if seen_calls != ids else []
        out += ["OBSERVATIONS_AND_STEPS_DISAGREE"] if seen_results != ids else []
    return [x if isinstance(x, tuple) else (x, None) for x in out]


def test_reasons_are_those_of_a_reader(spark, monkeypatch):
    monkeypatch.setattr(prefix, "CHUNK", 4)
    rnd, messages, steps, examples, expected = random.Random(7), [], [], [], {}
    for t in range(120):
        name, chat = f"t{t}", []
        for _ in range(rnd.randint(0, 14)):
            role = rnd.choice(("assistant", "tool", "tool", "user"))
            ids = [rnd.choice(("a", "b", "c", "d", None) if rnd.random() < 0.2 else ("a", "b", "c", "d")) for _ in range(rnd.choice((0, 1, 1, 2, 3)))]
            chat.append((role, ids if role == "assistant" and rnd.random() < 0.95 else None, rnd.choice(("a", "b", "c", None, "d")) if role == "tool" else None))
        if t % 10 == 0:  # one that is right
            chat = [("user", None, None), ("assistant", ["a", "b"], None), ("tool", None, "b"), ("tool", None, "a"), ("assistant", ["c"], None), ("tool", None, "c"), ("assistant", [], None)]
        own = [(i, rnd.random() < 0.8, rnd.random() < 0.9) for i in rnd.sample(["a", "b", "c", "d", None], rnd.randint(0, 4))] if t % 10 else [(i, True, True) for i in "abc"]
        final, verdict = ("done", "ELIGIBLE") if t % 3 or t % 10 == 0 else (rnd.choice((None, " ", "x")), rnd.choice((None, "REJECTED", "ELIGIBLE")))
        messages += [(name, 5 * i, *m) for i, m in enumerate(chat)]
        steps += [(name, *s) for s in own]
        examples.append((name, final, verdict))
        expected[name] = read(chat, own, final, verdict)
    table = spark.createDataFrame(examples, EXAMPLES)
    found = pairing.reasons(spark.createDataFrame(messages + [("other", 1, "tool", None, "a")], MESSAGES).repartition(3), spark.createDataFrame(steps, STEPS), table)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.trajectory, r.position, r.place)):
        got.setdefault(r.trajectory, []).append((r.code, r.detail))
    assert got == {k: v for k, v in expected.items() if v}
    assert {r.trajectory: r.valid for r in pairing.verdicts(table, found).collect()} == {k: not v for k, v in expected.items()} and any(not v for v in expected.values())
    assert len(Counter(c for v in expected.values() for c, _ in v)) == 12


def test_a_very_long_chat_is_rows(spark):
    n = 100_000
    ids = spark.range(n).select(F.lit("long").alias("trajectory"), F.col("id").alias("position"), F.when(F.col("id") % 2 == 0, "assistant").otherwise("tool").alias("role"), F.concat(F.lit("c"), F.floor(F.col("id") / 2).cast("string")).alias("c"))
    messages = ids.select("trajectory", "position", "role", F.when(F.col("role") == "assistant", F.array("c")).alias("calls"), F.when((F.col("role") == "tool") & (F.col("position") != 777), F.col("c")).alias("call"))
    steps = ids.filter("role = 'tool'").select("trajectory", F.col("c").alias("tool_call_id"), F.lit(True).alias("has_content"), F.lit(True).alias("has_result"))
    found = pairing.reasons(messages, steps, spark.createDataFrame([("long", "x", "ELIGIBLE")], EXAMPLES)).orderBy("position", "place").collect()
    assert [(r.position, r.code) for r in found] == [(777, "OBSERVATION_WITHOUT_CALL"), (778, "DECISION_BEFORE_OBSERVATIONS"), (pairing.LAST, "OBSERVATIONS_AND_STEPS_DISAGREE")]
