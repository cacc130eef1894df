"""Snapshots under a budget against a fold over paths."""

import hashlib
import random

from pyspark.sql import functions as F

from tracemill.functions import prefix
from tracemill.operators import workspace


def folded(files, most_files, most_bytes):
    out = {}
    for w in {f[0] for f in files}:
        rest = most_bytes
        for _, path, size in sorted(f for f in files if f[0] == w)[:most_files]:
            out[w, path] = size <= rest
            rest -= size if size <= rest else 0
    return out


def test_a_budget_is_spent_in_order_of_paths(spark, monkeypatch):
    monkeypatch.setattr(prefix, "CHUNK", 16)
    rnd = random.Random(9)
    files = [("big", f"f{i:03d}", 100 - i // 2 if i % 2 else 1) for i in range(120)] + [("zero", f"z{i}", 0) for i in range(5)] + [("huge", "a", 10**12), ("huge", "b", 3)]
    for w in ("r1", "r2", "r3", "r4"):
        files += [(w, f"d{rnd.randrange(9)}/{i}é", int(2 ** rnd.uniform(0, 9))) for i in range(150)]
    df = spark.createDataFrame(files, "workspace string, path string, size long").repartition(3)
    df = df.withColumns({"sha256": F.sha2("path", 256), "content": F.col("path").cast("binary")})
    for most_files, most_bytes in ((10_000, 700), (100, 100), (10_000, 10**7), (3, 0)):
        kept, issues, workspaces = workspace.snapshot(df, most_files, most_bytes)
        expected = folded(files, most_files, most_bytes)
        assert {(r.workspace, r.path): r.retained for r in kept.collect()} == expected
        assert {(r.workspace, r.path) for r in issues.filter("path is not null").collect()} == {k for k, v in expected.items() if not v}
        whole = {w: all(v for k, v in expected.items() if k[0] == w) and sum(f[0] == w for f in files) <= most_files for w in {f[0] for f in files}}
        assert {r.workspace: r.complete for r in workspaces.collect()} == whole
        assert kept.filter("retained <> (content is not null)").isEmpty()


def test_files_of_a_folder(spark, tmp_path):
    for path, text in (("a.txt", b"one"), ("d/b.bin", b"\0\1"), (".git/config", b"x"), ("d/.git/y", b"x"), ("d/e/f.md", b"f")):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(text)
    found = {r.path: (r.size, r.sha256) for r in workspace.read_files(spark, str(tmp_path)).collect()}
    assert found == {p: (len(t), hashlib.sha256(t).hexdigest()) for p, t in (("a.txt", b"one"), ("d/b.bin", b"\0\1"), ("d/e/f.md", b"f"))}


def test_no_files(spark):
    empty = spark.createDataFrame([], "workspace string, path string, size long, sha256 string, content binary")
    assert [x.collect() for x in workspace.snapshot(empty)] == [[], [], []]
