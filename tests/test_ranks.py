"""Exact percentiles against numpy, with ties, nulls, single values and a hot group."""

import random

import numpy as np
import pytest

from tracemill.functions import prefix, ranks


def test_percentiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(prefix, "CHUNK", 16)
    rnd = random.Random(5)
    rows = [("hot", rnd.gauss(0, 1)) for _ in range(3000)] + [("ties", float(rnd.randrange(4))) for _ in range(101)] + [("one", 7.5), ("two", 1.0), ("two", 2.0), ("null", None), (None, 3.0), (None, 9.0), ("hot", None)]
    shares = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in ranks.percentiles(spark.createDataFrame(rows, "g string, x double").repartition(3), "g", "x", shares).collect()}
    assert set(got) == {"hot", "ties", "one", "two", None}
    for g, r in got.items():
        own = [x for k, x in rows if k == g and x is not None]
        for name, q in shares.items():
            assert r[name] == pytest.approx(np.quantile(own, q), abs=1e-9)
