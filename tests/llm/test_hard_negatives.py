"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortex.llm import hard_negatives as hn
from tests.llm.conftest import same_rows

ROWS = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, positives=5, negatives=10):
    own = []
    for i, v, label in dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, label, [math.floor(256 * x) for x in v]))
    out = []
    rank = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for a, (i, label, q) in enumerate(own):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(q, p, strict=True)), j, other == label) for b, (j, other, p) in enumerate(own) if b != a and len(p) == len(q)]
        for ps, p, _ in sorted((s for s in scored if s[2]), key=rank)[:positives]:
            window = [s for s in scored if not s[2] and 30 * ps <= 100 * s[0] <= 90 * ps]
            out += [(i, p, n + 1, j, ps, s) for n, (s, j, _) in enumerate(sorted(window, key=rank)[:negatives])]
    return sorted(map(repr, out))


def got(df, **options):
    out = hn.mine(df, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(repr(tuple(r)) for r in out.collect())


def made_up(seed, n=300, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim)) + 1
    return [(i, [float(x) for x in centres[i % 4] * rng.uniform(0.2, 1.5) + rng.normal(size=dim)], int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("shard_bytes", [1 << 22, 8000])
def test_is_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(hn, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(hn, "SLICE", 7)
    rows = made_up(1)
    assert got(spark.createDataFrame(rows, ROWS).repartition(3), anchor_every=10) == brute(rows, every=10)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHARD_BYTES", 4000)
    rng = random.Random(3)
    rows = made_up(2, 90, 6)
    common = [0.5, 0.25, 0.125, 1.0, 2.0, 0.0]
    rows += [(1000 + i, common, rng.randint(0, 1)) for i in range(80)]  # ties
    rows += [(100, common, 0), (100, common, 0), (100, common, 1)]  # a repeated row, a repeated id
    rows += [(None, [1.0, 1.0, 0.0, 0.0, 0.0, 3.0], 0), (200, None, 0), (300, [1.0, None], 0), (400, [float("nan")] * 6, 1), (500, [float("inf")] * 6, 1), (600, common, None)]
    rows += [(700, [], 0), (701, [], 0), (702, [], 1), (800, [0.0] * 6, 1), (900, [1.0] * 5, 0), (901, [1.0] * 5, 0), (902, [0.5] * 5, 1)]
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("mine") for c in ("row", "shard", "kind", "score", "scores", "vec")})
    want = brute(rows)
    assert got(df) == want and len(want) > 30
    assert got(df.limit(0)) == []


def test_large_components_are_exact(spark):
    rows = [(0, [2.0e6, 1.01, -2.3], 0), (1, [1.9e6, 3.0, 5.0], 0), (2, [1.0e6, -7.0, 11.0], 1), (3, [1.0e6, -7.0, 12.0], 1), (4, [1e300, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, ROWS)
    want = brute(rows)
    assert got(df) == want and len(want) == 2


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = np.floor(256 * rng.normal(size=(50, 30)) + 100)
    shard = hn.Shard(np.arange(50), np.arange(50), np.zeros(50, bool), np.zeros(50), x, hn.summaries(x))
    exact, every = x @ x.T, np.arange(50)
    wide = []
    for level in range(len(hn.SEGMENTS)):
        lower, upper = shard.bounds(shard, every, level, hn.SEGMENTS)
        assert (lower <= exact).all() and (exact <= upper).all()
        wide.append((upper - lower).mean())
    assert wide == sorted(wide, reverse=True)


def test_is_the_sql(spark):
    from cohortex.llm.queries import QUERIES

    same_rows(QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.001"), hn.SQL)
