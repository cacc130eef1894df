"""Queries on streams with state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from ..sources.scratch import shared_folder
from ..streaming import state
from .catalog import LINE, query

_LINES = ", ".join(LINE)


def arrivals(lines: DataFrame) -> list[DataFrame]:
    """Line items as they come in: a third of the orders; another and the first lines of the first again; the last, and second
    lines of the first with other quantities."""
    part = F.col("l_orderkey") % 3
    first, number = lines.filter(part == 0), F.col("l_linenumber")
    return [first, lines.filter(part == 1).unionByName(first.filter(number == 1)), lines.filter(part == 2).unionByName(first.filter(number == 2).withColumn("l_quantity", F.col("l_quantity") + 100))]


@query(f"""with a as (select *, l_orderkey % 3 as batch from lineitem union all select *, 1 from lineitem where l_orderkey % 3 = 0 and l_linenumber = 1
  union all select * replace (l_quantity + 100 as l_quantity), 2 from lineitem where l_orderkey % 3 = 0 and l_linenumber = 2),
 k as (select *, row({_LINES}) as content, first_value(row({_LINES})) over (partition by l_orderkey, l_linenumber order by batch, l_partkey * 1000000 + l_suppkey) as kept from a),
 c as (select l_orderkey, l_linenumber, count(*) as n, count(*) filter (content = kept) as same from k group by all)
select l_orderkey as episode, count(*) as appended, sum(same - 1)::bigint as duplicates, sum(n - same)::bigint as conflicts from c group by 1""")
def stateful_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items taken by one stream in three batches, restarted after each: per order what was appended, repeated and
    in conflict."""
    lines = tables.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE)
    folder, store = shared_folder(spark, "arrivals"), shared_folder(spark, "state")
    named = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id")
    for rows in arrivals(lines):
        # A run takes all files that it has not taken yet as one batch, so they are written as they come.
        rows.select(named, "*").write.mode("append").option("compression", "zstd").parquet(folder)
        source = spark.readStream.schema(f"id string, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in lines.schema)}").parquet(folder)
        state.ingest(source, store, "id", F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).awaitTermination()
    count = lambda status: F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n"))), F.lit(0))
    kinds = ((state.APPENDED, "appended"), (state.DUPLICATE, "duplicates"), (state.CONFLICT, "conflicts"))
    return spark.read.parquet(f"{store}/rows").groupBy(F.split("id", "/")[0].cast("long").alias("episode")).agg(*[count(s).alias(n) for s, n in kinds])
