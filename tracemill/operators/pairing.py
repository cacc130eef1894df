"""Structure of training examples: whether every tool call of a chat is observed once, after it and before the next decision.

A reader of the chat would carry the open calls, which each assistant message clears, and the ids that were observed. The same
follows from groups: a turn is an assistant message and what follows it; of an id the first turn that both calls and
observes it is where it is matched, once. So a chat of any length is rows and groupings, and no task reads it in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import running
from ..sources.scratch import settle

#: Reasons about whole examples that come before, and after, those about messages.
FIRST, LAST = -1, (1 << 62)


def _told(rows: DataFrame, code: str, position=None, place=None, detail=None) -> DataFrame:
    number = lambda c: (F.lit(0) if c is None else F.lit(c) if isinstance(c, int) else c).cast("long")
    return rows.select("trajectory", number(position).alias("position"), number(place).alias("place"), F.lit(code).alias("code"), (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def reasons(messages: DataFrame, steps: DataFrame, examples: DataFrame) -> DataFrame:
    """trajectory, position, place, code, detail: all that is wrong with each example, in order of position and place.

    messages has trajectory, position (whole numbers, none twice), role, calls (ids of an assistant's calls; null for one
    without) and call (what a tool's message answers); steps has trajectory, tool_call_id, has_content and has_result; examples
    has trajectory, final_answer and verdict.
    """
    own = settle(messages.select("trajectory", "position", "role", "calls", "call").join(examples.select("trajectory"), "trajectory", "left_semi"), "messages")
    decides = F.col("role") == "assistant"
    rows = settle(running(own, "trajectory", "position", {"turn": F.coalesce(decides, F.lit(False)).cast("long")}), "turns")
    calls = rows.filter(decides).select("trajectory", "turn", "position", F.posexplode("calls").alias("place", "id"))
    results = rows.filter("role = 'tool'").select("trajectory", "turn", "position", F.col("call").alias("id"))
    key = ["trajectory", "turn", "id"]
    both = calls.filter("id is not null").select(*key, F.lit(1).alias("p"), F.lit(None).cast("long").alias("at")).unionByName(results.filter("id is not null").select(*key, F.lit(0).alias("p"), F.col("position").alias("at")))
    met = both.groupBy(*key).agg(F.sum("p").alias("p"), F.count("at").alias("r"), F.min("at").alias("at"))
    met = settle(met, "met")
    first = met.filter("p > 0 and r > 0").groupBy("trajectory", "id").agg(F.min("turn").alias("matched"))
    met = settle(met.join(first, ["trajectory", "id"], "left"), "matched")
    here = F.coalesce(F.col("turn") == F.col("matched"), F.lit(False))
    # What a turn leaves open: the next decision comes too early, or it is missing at the end.
    left = met.groupBy("trajectory", "turn").agg(F.sum(F.col("p") - here.cast("int")).alias("open")).filter("open > 0")
    last = rows.groupBy("trajectory").agg(F.max("turn").alias("last"))
    left = left.join(last, "trajectory")
    next_ = rows.filter(decides).select("trajectory", (F.col("turn") - 1).alias("turn"), "position")
    early = left.filter(F.col("turn") < F.col("last")).join(next_, ["trajectory", "turn"])
    again = calls.filter("id is not null").join(calls.filter("id is not null").groupBy("trajectory", "id").agg(F.min(F.struct("position", "place")).alias("head")), ["trajectory", "id"])
    judged = results.join(met.select(*key, "p", F.col("at").alias("head"), "matched"), key, "left")
    open_ = F.coalesce(F.col("p") > 0, F.lit(False)) & ~(here & (F.col("p") == 1))
    is_match = here & (F.col("position") == F.col("head"))
    named = steps.filter("tool_call_id is not null").join(examples.select("trajectory"), "trajectory", "left_semi").select("trajectory", F.col("tool_call_id").alias("id")).distinct()
    called = met.filter("p > 0").select("trajectory", "id").distinct()
    either = lambda a, b: a.join(b, ["trajectory", "id"], "left_anti").unionByName(b.join(a, ["trajectory", "id"], "left_anti")).select("trajectory").distinct()
    chats = own.select("trajectory").distinct()
    lacking = steps.join(examples.select("trajectory"), "trajectory", "left_semi").filter("has_content and not has_result").groupBy("trajectory").agg(F.count(F.lit(1)).alias("n"))
    disagree = lambda ids, code, place: _told(either(ids, named).join(chats, "trajectory", "left_semi"), code, LAST, place)
    found = [
        _told(examples.filter(~F.coalesce(F.col("final_answer").rlike(r"(?U)\S"), F.lit(False))), "EMPTY_FINAL_ANSWER", FIRST, 0),
        _told(examples.filter(~F.col("verdict").eqNullSafe("ELIGIBLE")), "NOT_ELIGIBLE", FIRST, 1),
        _told(examples.join(chats, "trajectory", "left_anti"), "NO_MESSAGES", FIRST, 2), _told(lacking, "STEPS_WITHOUT_RESULT", FIRST, 3, F.col("n")),
        _told(early, "DECISION_BEFORE_OBSERVATIONS", F.col("position"), -1), _told(calls.filter("id is null"), "CALL_WITHOUT_ID", F.col("position"), F.col("place")),
        _told(again.filter(F.struct("position", "place") > F.col("head")), "REPEATED_CALL_ID", F.col("position"), F.col("place"), F.col("id")),
        _told(judged.filter(~is_match & ~open_), "OBSERVATION_WITHOUT_CALL", F.col("position"), 0, F.col("id")), _told(judged.filter(~is_match & open_), "REPEATED_OBSERVATION", F.col("position"), 0, F.col("id")),
        _told(left.filter(F.col("turn") == F.col("last")), "OBSERVATIONS_MISSING", LAST, 0, F.col("open")),
        disagree(called, "CALLS_AND_STEPS_DISAGREE", 1), disagree(first.select("trajectory", "id"), "OBSERVATIONS_AND_STEPS_DISAGREE", 2),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def verdicts(examples: DataFrame, found: DataFrame) -> DataFrame:
    """trajectory, valid, and how many reasons there are against it."""
    per = found.groupBy("trajectory").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return examples.select("trajectory").join(per, "trajectory", "left").select("trajectory", (n == 0).alias("valid"), n.alias("reasons"))
