"""Written tables are not broadcast by the size of their files."""

from pyspark.sql import functions as F

from tracemill.sources.scratch import hinted, settle


def test_only_counted_tables_are_broadcast(spark):
    a, b = settle(spark.range(1000), "a"), settle(spark.range(1000), "b")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(a.join(b.groupBy("id").count().filter("count > 0"), "id"))
    assert "Broadcast" not in plan(a.filter(F.col("id") > 3).join(b.select("id"), "id", "left"))
    assert "BroadcastHashJoin" in plan(a.join(hinted(b), "id"))
