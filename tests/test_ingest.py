"""Batches of an ingest: crowded ids, slices, contents of one digest, what a batch shuffles; what a store by state keeps."""

from datetime import datetime
from hashlib import sha256

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracemill.streaming import ingest, state

SCHEMA = "id string, ts long, v string"


def stored(spark, store):
    events = sorted((r.id, r.ts, r.v) for r in spark.read.parquet(f"{store}/events").collect())
    bad = sorted((str(r.id), r.ts, r.v, r["_n"], r.code) for r in spark.read.parquet(f"{store}/quarantine/*").collect())
    return events, bad, [tuple(r) for r in spark.read.parquet(f"{store}/counts/*").select("appended", "duplicates", "conflicts").orderBy("appended").collect()]


@pytest.mark.parametrize("bounds", [{}, {"CROWD": 5, "HASHES": 1 << 20}, {"SLICE_ROWS": 1, "LEAST_ROWS": 1}])
def test_crowded_ids_and_slices_say_the_same(spark, tmp_path, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(ingest, name, value)
    store = str(tmp_path / "store")
    first = [("hot", i % 4, "x") for i in range(40)] + [(f"i{k}", 1, "a") for k in range(9)] + [("i0", 1, "a"), ("i0", 0, None), (None, 1, "p")]
    second = [("hot", i % 5, "x") for i in range(40)] + [("new", 2, "x")] * 6 + [("i1", 1, "a"), ("i1", 1, "b"), ("i1", 1, "b")]
    for number, rows in enumerate((first, second, second)):
        ingest.ingest_batch(spark.createDataFrame(rows, SCHEMA), store, "id", ["ts"], min(number, 1))
    events, bad, counts = stored(spark, store)
    assert events == sorted([("hot", 0, "x"), ("i0", 0, None), ("new", 2, "x"), *[(f"i{k}", 1, "a") for k in range(1, 9)]])
    code = "CONFLICTING_EVENT_ID"
    assert bad == sorted([("None", 1, "p", 1, "BLANK_EVENT_ID"), ("i0", 1, "a", 2, code), ("i1", 1, "b", 2, code), *[("hot", i, "x", n, code) for i, n in ((1, 10), (2, 10), (3, 10), (1, 8), (2, 8), (3, 8), (4, 8))]])
    assert counts == [(1, 5 + 8 + 1, 32 + 2), (10, 9, 30 + 2)]


def test_contents_of_one_digest_are_appended_once(spark, tmp_path):
    store, at = str(tmp_path / "store"), lambda us: datetime(2026, 1, 1, 0, 0, 0, us)
    ingest.ingest_batch(spark.createDataFrame([("a", at(1)), ("a", at(2))], "id string, ts timestamp"), store, "id", ["ts"], 0)
    assert spark.read.parquet(f"{store}/events").count() == 1
    assert tuple(spark.read.parquet(f"{store}/counts/*").select("appended", "duplicates", "conflicts").first()) == (1, 1, 0)


def test_rows_of_a_batch_are_shuffled_once(spark):
    schema = "id string, _known binary"
    rows = spark.range(20).select(F.col("id").cast("string").alias("id"), F.col("id").alias("ts"), F.lit("x").alias("v"))
    found = ingest._sorted(rows, spark.createDataFrame([("3", b"1")], schema), "id", ["ts"], 1 << 30)
    assert sorted((r.id, r["_n"], r["_new"]) for r in found.collect()) == sorted((str(i), 1, i != 3) for i in range(20))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange ") == 1 and "Join" not in plan


class _Lists:
    """A handle whose one list is kept here."""

    def __init__(self):
        self.entries = []

    def getListState(self, name, schema):
        return self

    def get(self):
        return iter(self.entries)

    def appendList(self, entries):
        self.entries += entries


def test_ids_of_a_bucket_are_few_entries_of_its_state(monkeypatch):
    lists, kept = _Lists(), state.FirstContent()
    kept.init(lists)
    frame = lambda rows: pd.DataFrame(rows, columns=["id", "content", "place"])
    told = lambda rows: sorted(tuple(r) for f in kept.handleInputRows(None, iter([frame(rows[:3]), frame(rows[3:])]), None) for r in f.itertuples(index=False))
    assert told([(f'"i{k}ü', "{}", k) for k in range(50)] + [("a", "y", 2), ("a", "x", 1), ("a", "y", 0)]) == sorted([*[(f'"i{k}ü', state.APPENDED, "{}", 1) for k in range(50)], ("a", state.APPENDED, "y", 1), ("a", state.DUPLICATE, "y", 1), ("a", state.CONFLICT, "x", 1)])
    assert len(lists.entries) == 1
    monkeypatch.setattr(state, "ENTRY", 2)
    assert told([(f"n{k}", "{}", 0) for k in range(5)] + [("a", "x", 0), ('"i7ü', "{}", 0)]) == sorted([*[(f"n{k}", state.APPENDED, "{}", 1) for k in range(5)], ("a", state.CONFLICT, "x", 1), ('"i7ü', state.DUPLICATE, "{}", 1)])
    assert len(lists.entries) == 4 and told([("n4", "z", 0)]) == [("n4", state.CONFLICT, "z", 1)]


def test_a_store_by_state_is_written_without_digests(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")], SCHEMA).write.parquet(folder)
    query = state.ingest(spark.readStream.schema(SCHEMA).parquet(folder), store, "id", F.col("ts"))
    query.awaitTermination()
    assert query._jsq.explainInternal(False).count("Exchange ") == 1
    rows = spark.read.parquet(f"{store}/rows")
    assert sorted(rows.columns) == ["content", "id", "n", "status"]
    contents = {(r.id, r.status): r.content for r in rows.collect()}
    read = state.read(spark, store, spark.createDataFrame([], SCHEMA).schema).collect()
    assert {(r.id, r.status): r.digest for r in read} == {k: sha256(c.encode()).hexdigest() for k, c in contents.items()} and len(read) == 3
