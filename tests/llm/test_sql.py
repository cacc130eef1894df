"""Registered queries against their SQL; the pipeline's stages against what they promise."""

import pytest
from oracle import connection, differences
from pyspark.sql import functions as F

import corpus_pipeline
from tracemill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connection(sf_dir), queries.ORACLE_SQL[name]) == ""


def test_queries_without_sql_return_every_row(spark, sf_dir):
    for name, table in (("op1_mixing", "documents"), ("op3_fingerprints", "documents"), ("op6_quality", "documents"), ("op9_licenses", "documents"), ("op10_html", "pages")):
        assert queries.QUERIES[name](spark, sf_dir).count() == queries.table(spark, sf_dir, table).count(), name


def test_stages_hand_on_documents(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if name != "mixing":
            assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    assert set(columns) < set(docs.columns) and docs.filter("copies <= 0").isEmpty()


def test_stages_take_null_and_repeated_ids(spark, sf_dir):
    words = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(None if i % 3 == 0 else i, words(i, 5 + i % 7), "en", "ab"[i % 2], i) for i in range(60)]
    rows += [(1, words(1, 6), "en", "b", 1)] * 3 + [(2, words(100, 9), "en", "a", 2), (2, words(101, 9), "en", "a", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.different(spark, docs, sf_dir)
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.distinct().collect()))
    got = corpus_pipeline.mixed(spark, docs, sf_dir).collect()
    size = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in "ab"}
    for source, share in (("a", 1), ("b", 2)):
        own = [r for r in got if r.source == source]
        target = min(3 * size[source], sum(size.values()) * share / 3)
        assert own[0].target == pytest.approx(target) and abs(sum(r.taken for r in own) - target) <= 6 + 1e-6
    assert all(r.size == len(r.text.split()) and r.taken == r.size * r.copies for r in got)
    assert any(r.doc_id is None for r in got)
    for r in got:
        assert sum(x[:5] == r[:5] for x in got) <= sum(x == tuple(r[:5]) for x in rows)


def test_stages_take_an_empty_table_and_odd_columns(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).withColumns({"size": F.lit("s"), "taken": F.lit(1), "row": F.lit(2), "x": F.lit(None).cast("double"), "grp": F.lit("g")})
    rows = docs.unionByName(docs.filter("doc_id < 5").withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string")))
    for name, table in (("some", rows), ("none", rows.filter("false"))):
        table.write.parquet(str(tmp_path / name))
        before = spark.read.parquet(str(tmp_path / name))
        for k, (stage, f) in enumerate(corpus_pipeline.STAGES[1:]):
            after = f(spark, before, sf_dir)
            expected = before.columns + (["mix_size", "source_size", "target", "copies", "mix_taken"] if stage == "mixing" else [])
            assert after.columns == expected
            after.write.parquet(str(tmp_path / f"{name}{k}"))
            found = spark.read.parquet(str(tmp_path / f"{name}{k}"))
            if name == "none":
                assert found.count() == 0
            elif stage != "mixing":
                # Null ids and null texts are no near copies, passages or leaks of anything.
                assert found.filter("doc_id is null").count() == before.filter("doc_id is null").count() > 0
                assert found.filter("size <> 's' or taken <> 1 or row <> 2 or grp <> 'g' or x is not null").isEmpty()
            before = found


def test_rows_are_numbered_alike_whenever_read(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = {r[0]: r[1] for r in corpus_pipeline.numbered(docs).select("doc_id", corpus_pipeline.ROW).collect()}
    two = {r[0]: r[1] for r in corpus_pipeline.numbered(docs).select(corpus_pipeline.ROW, "text", "doc_id").repartition(3).select("doc_id", corpus_pipeline.ROW).collect()}
    assert one == two and len(set(one.values())) == docs.count()
