"""A store whose raw files and manifest are damaged: what recovery finds, rebuilds and leaves."""

import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.sources import generations as g

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("at", T.LongType()), T.StructField("text", T.StringType())])


def test_recovery_rebuilds_what_differs(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(r, f"{r}{i % 3}", i, f"é{i}") for r in (1, 2, 3) for i in range(7)] + [(1, "10", 6, "é6")]
    df = spark.createDataFrame(rows, "run long, id string, at long, text string")
    part = (F.col("id").substr(-1, 1).cast("int") % 2).cast("int")

    def recover():
        return {(r.run, r.part): (r.state, r.generation, r.lines, r.events) for r in g.recover(spark, path, SCHEMA, ["id"], ["at"]).collect()}

    def held():
        return {(r.run, r.id): (r.at, r.text) for r in g.read_compacted(spark, path, SCHEMA).collect()}

    g.append(df, path, part)
    first = recover()
    assert first == {(r, p): ("REBUILT", 1, n + (r == 1 and p == 0), e) for r in (1, 2, 3) for p, n, e in ((0, 5, 2), (1, 2, 1))}
    whole = {(r, f"{r}{i}"): ((6, "é6") if i == 0 else (3 + i, f"é{3 + i}")) for r in (1, 2, 3) for i in range(3)}
    assert held() == whole
    assert {v[0] for v in recover().values()} == {"OK"}
    # More for one part, a torn line in another, raw lines of a third gone, and what a lost job left behind.
    g.append(df.filter("run = 2 and id = '21'").limit(1).withColumns({"at": F.lit(99).cast("long"), "text": F.lit("new")}), path, part)
    g.append_lines(spark.createDataFrame([(3, 0, '{"id": "30", "at"'), (3, 1, '{"at": 1}')], "run long, part int, value string"), path)
    shutil.rmtree(tmp_path / "store" / "raw" / "run=1" / "part=1")
    df.filter("run = 1").select("id", F.lit(-1).cast("long").alias("at"), "text", F.lit(1).alias("run"), F.lit(0).alias("part")).write.partitionBy("run", "part").parquet(f"{path}/compacted/generation=7")
    assert held() == whole
    got = recover()
    assert {k: v[0] for k, v in got.items()} == {(1, 0): "OK", (1, 1): "RAW_MISSING", (2, 0): "OK", (2, 1): "REBUILT", (3, 0): "MALFORMED", (3, 1): "MALFORMED"}
    assert got[2, 1] == ("REBUILT", 2, 3, 1) and got[3, 0][1] == 1
    assert held() == whole | {(2, "21"): (99, "new")}
    assert {r.id for r in g.read_compacted(spark, path, SCHEMA, 2).collect()} == {"20", "21", "22"}
    with pytest.raises(ValueError, match="run=3/part=0, run=3/part=1"):
        g.read_all(spark, path, SCHEMA, ["id"])


def test_a_manifest_that_is_lost_is_rebuilt(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 1, "x"), (1, "b", 2, None)], "run long, id string, at long, text string")
    g.append(df, path, g.part_of("id"))
    g.recover(spark, path, SCHEMA, ["id"], ["at"])
    shutil.rmtree(tmp_path / "store" / "manifest")
    assert {r.state for r in g.recover(spark, path, SCHEMA, ["id"], ["at"]).collect()} == {"REBUILT"}
    assert sorted((r.id, r.at, r.text) for r in g.read_compacted(spark, path, SCHEMA).collect()) == [("a", 1, "x"), ("b", 2, None)]
    assert g.read_all(spark, path, SCHEMA, ["id"]).count() == 3


def test_raw_lines_are_compressed_and_a_hot_part_is_compacted_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(g, "SLICE_LINES", 100, raising=False)
    monkeypatch.setattr(g, "FILE_LINES", 400, raising=False)
    path = str(tmp_path / "store")
    rows = [(1, str(i % 500), i, "text") for i in range(1000)] + [(2, "x", 1, None)]
    g.append(spark.createDataFrame(rows, "run long, id string, at long, text string").coalesce(1), path, F.lit(0))
    # Lines that came uncompressed are lines of the same part.
    more = spark.createDataFrame([(1, 0, '{"id":"7","at":5000,"text":null}')], "run long, part int, value string")
    more.write.mode("append").partitionBy("run", "part").text(f"{path}/raw")
    hot = list((tmp_path / "store" / "raw" / "run=1").rglob("*.txt.gz"))
    assert len(hot) == 3 and sum(f.stat().st_size for f in hot) < 1000 * 10
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = g.recover(spark, path, SCHEMA, ["id"], ["at"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.run, r.part): (r.state, r.lines, r.events) for r in report} == {(1, 0): ("REBUILT", 1001, 500), (2, 0): ("REBUILT", 1, 1)}
    got = [(r.run, r.id, r.at, r.text) for r in g.read_compacted(spark, path, SCHEMA).collect()]
    assert sorted(got) == sorted([(1, str(i), 5000, None) if i == 7 else (1, str(i), 500 + i, "text") for i in range(500)] + [(2, "x", 1, None)])
    assert len(list((tmp_path / "store" / "compacted").rglob("run=1/part=0/*.parquet"))) > 1
