"""Compaction and recovery of a store of raw lines, drawn from line items: an order's number gives its run and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import generations, tables
from ..sources.scratch import shared_folder
from .catalog import LINE, query

_KEPT = ", ".join(f"{c} desc" for c in LINE)


@query(f"""with l as (select *, l_orderkey % 7 as run, (l_orderkey // 7 % 4)::int as part, l_linenumber > 4 as late from lineitem),
 p as (select run, part, count(*) filter (not late) as early, count(*) filter (late) as added from l group by 1, 2),
 s as (select *, case when run = 2 and part = 1 then 'MALFORMED' when run in (2, 3, 5) and added > 0 then 'REBUILT' else 'OK' end as state from p where early > 0),
 k as (select l.run, l.part, l_quantity from l join s on s.run = l.run and s.part = l.part where not late or s.state = 'REBUILT'
  qualify row_number() over (partition by l_orderkey, l_linenumber order by {_KEPT}) = 1)
select s.run, s.part, state, (early + case when run in (2, 3, 5) then added else 0 end + (state = 'MALFORMED')::int)::bigint as lines, (state = 'MALFORMED')::bigint as bad, case when state = 'REBUILT' then 2 else 1 end::bigint as generation, n as events, q as quantity
from s join (select run, part, count(*) as n, round(sum(l_quantity), 2) as q from k group by 1, 2) c using (run, part)""")
def store_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items compacted, more of three runs added with a torn line among them, and recovered: what each part is and holds."""
    path, lines = shared_folder(spark, "store"), tables.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE)
    schema, order = lines.schema, F.col("l_orderkey")
    rows, part = lines.withColumn("run", order % 7), (F.floor(order / 7) % 4).cast("int")
    late = F.col("l_linenumber") > 4
    keys = ["l_orderkey", "l_linenumber"]
    generations.append(rows.filter(~late), path, part)
    generations.recover(spark, path, schema, keys, LINE)
    generations.append(rows.filter(late & F.col("run").isin(2, 3, 5)), path, part)
    generations.append_lines(spark.range(1).select(F.lit(2).cast("long").alias("run"), F.lit(1).alias("part"), F.lit('{"l_orderkey": 9, "l_line').alias("value")), path)
    report = generations.recover(spark, path, schema, keys, LINE)
    held = generations.read_compacted(spark, path, schema).groupBy("run", "part").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return report.join(held, ["run", "part"])
