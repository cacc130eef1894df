"""The structure of chats, drawn from conversations: an assistant's turn calls tools, a user's later one answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pairing
from ..sources import tables
from .catalog import query

# A machine that reads each chat message by message: what is open, called and observed, and what was wrong.
_READ = """recursive c as (select conv_id as trajectory, turn as position, case when role = 'user' and turn > 0 then 'tool' else role end as role, length(text) as size,
  list_filter([case when conv_id % 13 = 5 then '' else 'c' || (conv_id % 3 + turn + 1) % 4 end, case when turn % 3 = 0 then 'd' || turn % 2 end], lambda x: x is not null) as calls, 'c' || (conv_id % 3 + turn) % 4 as call from conversations),
 n as (select *, row_number() over (partition by trajectory order by position) as k from c),
 m as (select trajectory, 0::bigint as k, []::varchar[] as pending, []::varchar[] as called, []::varchar[] as seen, []::struct(p bigint, i bigint, code varchar, detail varchar)[] as r from n where k = 1
  union all select n.trajectory, n.k, case when role = 'assistant' then list_filter(n.calls, lambda x: x <> '') when role = 'tool' and list_contains(pending, n.call) and not list_contains(seen, n.call)
    then list_filter(pending, lambda x, i: i <> list_position(pending, n.call)) else pending end,
   case when role = 'assistant' then called || list_filter(n.calls, lambda x: x <> '') else called end,
   case when role = 'tool' and list_contains(pending, n.call) and not list_contains(seen, n.call) then seen || [n.call] else seen end,
   r || case when role = 'assistant' then list_filter([case when len(pending) > 0 then {'p': n.position, 'i': -1, 'code': 'DECISION_BEFORE_OBSERVATIONS', 'detail': null} end]
      || list_transform(n.calls, lambda x, i: case when x = '' then {'p': n.position, 'i': i - 1, 'code': 'CALL_WITHOUT_ID', 'detail': null} when list_contains(called || n.calls[1 : i - 1], x) then {'p': n.position, 'i': i - 1, 'code': 'REPEATED_CALL_ID', 'detail': x} end), lambda x: x is not null)
     when role = 'tool' and not list_contains(pending, n.call) then [{'p': n.position, 'i': 0, 'code': 'OBSERVATION_WITHOUT_CALL', 'detail': n.call}]
     when role = 'tool' and list_contains(seen, n.call) then [{'p': n.position, 'i': 0, 'code': 'REPEATED_OBSERVATION', 'detail': n.call}] else [] end
   from m join n on n.trajectory = m.trajectory and n.k = m.k + 1),
 e as (select * from m qualify row_number() over (partition by trajectory order by k desc) = 1),
 s as (select trajectory, list_distinct(list('c' || (trajectory % 3 + position + 1) % 4) filter (role = 'assistant')) as ids, count(*) filter (role = 'assistant' and size % 7 = 0) as lacking from c group by 1),
 reasons as (select trajectory, unnest(r, recursive := true) from e union all select trajectory, -1, 1, 'NOT_ELIGIBLE', null from e where trajectory % 11 = 0
  union all select trajectory, -1, 3, 'STEPS_WITHOUT_RESULT', lacking::varchar from s where lacking > 0 union all select trajectory, 4611686018427387904, 0, 'OBSERVATIONS_MISSING', len(pending)::varchar from e where len(pending) > 0
  union all select e.trajectory, 4611686018427387904, 1, 'CALLS_AND_STEPS_DISAGREE', null from e join s using (trajectory) where list_sort(list_distinct(called)) is distinct from list_sort(coalesce(ids, []))
  union all select e.trajectory, 4611686018427387904, 2, 'OBSERVATIONS_AND_STEPS_DISAGREE', null from e join s using (trajectory) where list_sort(list_distinct(seen)) is distinct from list_sort(coalesce(ids, [])))"""


def _drawn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    turns, conv, turn = tables.read(spark, sf_dir, "conversations"), F.col("conv_id"), F.col("turn").cast("long")
    role = F.when((F.col("role") == "user") & (turn > 0), "tool").otherwise(F.col("role"))
    first = F.concat(F.lit("c"), ((conv % 3 + turn + 1) % 4).cast("string"))
    calls = F.concat(F.array(F.when(conv % 13 != 5, first)), F.when(turn % 3 == 0, F.array(F.concat(F.lit("d"), (turn % 2).cast("string")))).otherwise(F.array().cast("array<string>")))
    rows = turns.select(conv.alias("trajectory"), turn.alias("position"), role.alias("role"), calls.alias("calls"), F.concat(F.lit("c"), ((conv % 3 + turn) % 4).cast("string")).alias("call"), first.alias("id"), F.length("text").alias("size"))
    steps = rows.filter("role = 'assistant'").select("trajectory", F.col("id").alias("tool_call_id"), F.lit(True).alias("has_content"), (F.col("size") % 7 != 0).alias("has_result"))
    examples = rows.select("trajectory").distinct().select("trajectory", F.lit("done").alias("final_answer"), F.when(F.col("trajectory") % 11 != 0, "ELIGIBLE").alias("verdict"))
    return rows.select("trajectory", "position", "role", "calls", "call"), steps, examples


@query(f"with {_READ} select trajectory, p as position, i as place, code, detail from reasons")
def chat_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is wrong with the chats of conversations."""
    return pairing.reasons(*_drawn(spark, sf_dir))


@query(f"with {_READ} select e.trajectory, count(r.trajectory) = 0 as valid, count(r.trajectory) as reasons from e left join reasons r on r.trajectory = e.trajectory group by 1")
def chat_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, steps, examples = _drawn(spark, sf_dir)
    return pairing.verdicts(examples, pairing.reasons(messages, steps, examples))
