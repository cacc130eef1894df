"""Ingest with state: batches, restarts, blank ids; what an id was first."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.streaming import state

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("text", T.StringType())])


def test_three_batches_a_restart_and_blank_ids(spark, tmp_path):
    batches = [
        [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "y"), ("b", 1, None), (None, 1, "p"), (None, 1, "p")],
        [("a", 1, "y"), ("a", 2, "x"), ("c", 5, "z"), ("b", 1, "")],
        [("b", 1, None), ("c", 5, "z"), ("d", 0, "new"), (None, 2, "q")],
    ]
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        if i:  # the first run takes two batches of a file each, the second goes on
            query = state.ingest(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder), store, "id", F.col("n"))
            query.awaitTermination()
            assert len([p for p in query.recentProgress if p["numInputRows"]]) == (2 if i == 1 else 1)
    got = sorted(((r.id, r.status, r.n, r.row.n, r.row.text) for r in state.read(spark, store, SCHEMA).collect()), key=str)
    assert got == sorted([
        ("a", "APPENDED", 1, 1, "y"), ("a", "DUPLICATE", 1, 1, "y"), ("a", "CONFLICT", 1, 2, "x"), ("a", "DUPLICATE", 1, 1, "y"), ("a", "CONFLICT", 1, 2, "x"),
        ("b", "APPENDED", 1, 1, None), ("b", "CONFLICT", 1, 1, ""), ("b", "DUPLICATE", 1, 1, None), ("c", "APPENDED", 1, 5, "z"), ("c", "DUPLICATE", 1, 5, "z"),
        ("d", "APPENDED", 1, 0, "new"), (None, "BLANK_EVENT_ID", 2, 1, "p"), (None, "BLANK_EVENT_ID", 1, 2, "q"),
    ], key=str)
    again = state.ingest(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder), store, "id", F.col("n"))
    again.awaitTermination()
    assert spark.read.parquet(f"{store}/rows").count() == len(got)


def test_ids_that_share_a_bucket_keep_their_own_contents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "BUCKETS", 1)
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    for rows in ([(f"i{k}", k, "x") for k in range(50)] + [(None, 1, "p")], [(f"i{k}", k, "x" if k % 2 else "y") for k in range(60)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        state.ingest(spark.readStream.schema(SCHEMA).parquet(folder), store, "id", F.col("n")).awaitTermination()
    got = {(r.status, r["count"], r.n) for r in state.read(spark, store, SCHEMA).groupBy("status").agg(F.count("*").alias("count"), F.sum("n").alias("n")).collect()}
    assert got == {("APPENDED", 60, 60), ("DUPLICATE", 25, 25), ("CONFLICT", 25, 25), ("BLANK_EVENT_ID", 1, 1)}
