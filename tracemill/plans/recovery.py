"""Recovery replayed over the errors of events: a user is an episode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import recovery
from ..sources import tables
from .catalog import query

BUDGET = 4

_ERRORS = """e as (select user_id as episode, event_id as place, case when value < 2 then 'TIMEOUT' else 'FILE_NOT_FOUND' end as code, 'src/./m' || event_id % 9 as scope,
 case event_id % 8 when 0 then null when 1 then 'src/m/main.py' when 2 then 'src/task-7-' || event_id || '.tar.gz' when 3 then 'a\\b-c/' else 'lib/x-*-y.c' end as path,
 case event_id % 8 when 1 then 'main.py' when 2 then '*-' || event_id || '.tar.gz' when 3 then '*-c' else 'x-*-y.c' end as pattern from events where event_type = 'error')"""


@query(f"""with {_ERRORS}, f as (select episode, scope, min(place) as first from e where code = 'FILE_NOT_FOUND' and path is not null group by 1, 2),
 s as (select * from (select *, row_number() over (partition by episode order by first) as n from f) where n <= {BUDGET}),
 j as (select e.*, s.first, s.first = place as opens, code = 'FILE_NOT_FOUND' and path is not null as asks, (select count(*) from s b where b.episode = e.episode and b.first < e.place) as spent, (place % 9)::varchar as m from e left join s on s.episode = e.episode and s.scope = e.scope),
 k as (select *, asks and first is not null and not opens as cached, coalesce(asks and opens, false) as finds, case place % 9 % 5 when 0 then ['src/m' || m || '/a.py'] when 1 then ['src/m' || m || '/a.py', 'src/m' || m || '/b/c.py'] when 3 then ['src/m' || m || '/a.py'] else [] end as safe from j),
 r as (select *, case when code <> 'FILE_NOT_FOUND' then 'UNSUPPORTED_ERROR_CODE' when path is null then 'MISSING_ERROR_PATH' when finds then 'FILE_NOT_FOUND_DISCOVERY' when not cached then 'RECOVERY_BUDGET_EXHAUSTED'
  when len(safe) = 1 then 'UNIQUE_DISCOVERY_CANDIDATE' when len(safe) = 0 then 'NO_DISCOVERY_CANDIDATE' else 'AMBIGUOUS_DISCOVERY_CANDIDATES' end as reason from k)
select episode, place, case when reason = 'UNSUPPORTED_ERROR_CODE' then 'NO_ACTION' when finds then 'DISCOVER' when reason = 'UNIQUE_DISCOVERY_CANDIDATE' then 'READ' else 'TERMINATE' end as action, reason,
 case when finds then 'find' when reason = 'UNIQUE_DISCOVERY_CANDIDATE' then 'read' end as tool, case when finds then 'src/m' || m || '/' || pattern when reason = 'UNIQUE_DISCOVERY_CANDIDATE' then safe[1] end as target,
 case when cached then array_to_string(safe, ',') end as candidates, case when asks then {BUDGET} - spent end as budget_before, case when asks then {BUDGET} - spent - finds::int end as budget_after, case when asks and first is not null then cached end as cache_hit from r""")
def recovery_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the controller does about each error of each user."""
    n, events = F.col("event_id"), tables.read(spark, sf_dir, "events").filter("event_type = 'error'")
    text, scope = n.cast("string"), F.concat(F.lit("src/./m"), (n % 9).cast("string"))
    path = F.when(n % 8 == 1, "src/m/main.py").when(n % 8 == 2, F.concat(F.lit("src/task-7-"), text, F.lit(".tar.gz"))).when(n % 8 == 3, "a\\b-c/").when(n % 8 > 3, "lib/x-*-y.c")
    errors = events.select(F.col("user_id").alias("episode"), n.alias("place"), text.alias("event_id"), F.when(F.col("value") < 2, "TIMEOUT").otherwise("FILE_NOT_FOUND").alias("code"), path.alias("path"), scope.alias("scope"))
    kind, m = F.col("scope").substr(-1, 1).cast("int") % 5, F.col("scope").substr(-1, 1)
    own = lambda *names: F.array(*[F.concat(*[F.lit(p) if isinstance(p, str) else p for p in x]) for x in names])
    candidates = (
        F.when(kind == 0, own(("a.py",))).when(kind == 1, own(("b//c.py",), ("src/m", m, "/a.py"), ("./a.py",))).when(kind == 2, own(("../x.py",), ("/etc/x",), (" ",)))
        .when(kind == 3, own(("d\\..\\a.py",), ("../../src/m", m, "/a.py"))).otherwise(F.array().cast("array<string>"))
    )
    found = errors.select("episode", "scope").distinct().withColumn("candidates", candidates)
    told = recovery.replay(errors, found, BUDGET)
    return told.withColumn("candidates", F.array_join("candidates", ",")).drop("event_id")
