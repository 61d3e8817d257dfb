"""Sampling operators: exactness, determinism, partition independence (property tests)."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortex.functions.scalar import hash_u32
from cohortex.operators.sampling import (
    downsample_majority,
    first_n_by_hash,
    stratified_split,
    undersample_majority,
    union_all_split,
)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def labelled(spark, n_pos, n_neg, parts=3):
    data = [(f"p{i}", 1) for i in range(n_pos)] + [(f"n{i}", 0) for i in range(n_neg)]
    return spark.createDataFrame(data, "clientid string, y_conversions int").repartition(parts)


def brute_first_n(keys, n, seed):
    import hashlib

    def h(k):
        return int(hashlib.md5(f"{k}|{seed}".encode()).hexdigest()[:8], 16)

    return set(sorted(keys, key=lambda k: (h(k), k))[:n])


@SETTINGS
@given(n=st.integers(0, 60), total=st.integers(1, 60), seed=st.integers(0, 5))
def test_first_n_by_hash_matches_brute_force(spark, n, total, seed):
    keys = [f"k{i}" for i in range(total)]
    df = spark.createDataFrame([(k,) for k in keys], "clientid string")
    got = {r[0] for r in first_n_by_hash(df, n, seed).collect()}
    assert got == brute_first_n(keys, min(n, total), seed)


@SETTINGS
@given(n_pos=st.integers(1, 40), n_neg=st.integers(1, 40), seed=st.integers(0, 3))
def test_undersample_balances_and_only_shrinks_majority(spark, n_pos, n_neg, seed):
    df = labelled(spark, n_pos, n_neg)
    out = undersample_majority(df, seed)
    counts = {r[0]: r[1] for r in out.groupBy("y_conversions").count().collect()}
    assert counts[0] == counts[1] == min(n_pos, n_neg)
    minority = 1 if n_pos <= n_neg else 0
    assert {r[0] for r in out.where(F.col("y_conversions") == minority).collect()} == {
        r[0] for r in df.where(F.col("y_conversions") == minority).collect()
    }


@SETTINGS
@given(n_pos=st.integers(2, 30), n_neg=st.integers(2, 30), test_size=st.sampled_from([0.2, 0.5, 0.75]))
def test_split_disjoint_complete_ratio(spark, n_pos, n_neg, test_size):
    df = labelled(spark, n_pos, n_neg)
    out = stratified_split(df, test_size, 4).collect()
    assert sorted(r.clientid for r in out) == sorted(r.clientid for r in df.collect())
    for cls, n in ((1, n_pos), (0, n_neg)):
        assert sum(1 for r in out if r.y_conversions == cls and r.is_test) == math.ceil(n * test_size)


def test_sampling_independent_of_partitioning(spark):
    a = labelled(spark, 50, 400, parts=1)
    b = labelled(spark, 50, 400, parts=17)
    for op in (lambda d: downsample_majority(d, 0.2, 9), lambda d: undersample_majority(d, 9),
               lambda d: stratified_split(d, 0.5, 9)):
        assert sorted(map(tuple, op(a).collect())) == sorted(map(tuple, op(b).collect()))


def test_union_equals_single_filter(spark):
    df = labelled(spark, 30, 300)
    a = sorted(map(tuple, downsample_majority(df, 0.1, 42).collect()))
    b = sorted(map(tuple, union_all_split(df, 0.1, 42).collect()))
    assert a == b and sum(1 for r in a if r[1] == 1) == 30


def test_single_class_raises(spark):
    with pytest.raises(ValueError, match="class"):
        undersample_majority(labelled(spark, 5, 0), 1)
    with pytest.raises(ValueError, match="class"):
        stratified_split(labelled(spark, 0, 5), 0.5, 1)


def test_first_n_with_a_hash_collision(spark):
    """'c62508' and 'c93756' share the 32-bit hash f694f0ef for seed 7: ties go by key."""
    keys = ["c62508", "c93756"] + [f"x{i}" for i in range(30)]
    df = spark.createDataFrame([(k,) for k in keys], "clientid string")
    h = {r[0]: r[1] for r in df.select("clientid", hash_u32(F.col("clientid"), 7)).collect()}
    assert h["c62508"] == h["c93756"] == 0xF694F0EF
    below = sum(1 for v in h.values() if v < 0xF694F0EF)
    for n in (below, below + 1, below + 2):
        got = {r[0] for r in first_n_by_hash(df, n, 7).collect()}
        assert got == brute_first_n(keys, n, 7)


def repeated(spark, parts=3):
    rows = [("same", 0, None)] * 4 + [("same", 0, "x")] * 3 + [("same", 0, "y")] * 3 + [(f"p{i}", 1, None) for i in range(3)]
    return spark.createDataFrame(rows, "clientid string, y_conversions int, note string").repartition(parts)


@pytest.mark.parametrize("parts", [1, 5])
def test_repeated_keys_balance_exactly(spark, parts):
    out = undersample_majority(repeated(spark, parts), 3)
    assert {r[0]: r[1] for r in out.groupBy("y_conversions").count().collect()} == {0: 3, 1: 3}
    assert out.columns == ["clientid", "y_conversions", "note"]


def test_repeated_keys_split_exactly_and_alike(spark):
    def split(parts):
        return sorted(map(repr, map(tuple, stratified_split(repeated(spark, parts), 0.4, 4).collect())))

    out = stratified_split(repeated(spark), 0.4, 4).collect()
    assert len(out) == 13
    assert [sum(r.is_test for r in out if r.y_conversions == c) for c in (0, 1)] == [4, 2]
    assert split(1) == split(7)


def test_first_n_of_equal_and_null_rows(spark):
    rows = [(None, 1)] * 6 + [("", 1)] * 5 + [("a", 2), ("a", 3), ("a", 3)]
    df = spark.createDataFrame(rows, "clientid string, v int").repartition(4)
    for n in range(len(rows) + 2):
        got = first_n_by_hash(df, n, 5).collect()
        assert len(got) == min(n, len(rows))
        assert not {tuple(r) for r in got} - set(rows)
        assert all(sum(tuple(r) == x for r in got) <= rows.count(x) for x in set(rows))


def test_ties_reach_the_driver_as_counts_only(spark, monkeypatch):
    """50,000 rows of one key: no collected result has more rows than there are digits or classes."""
    from pyspark.sql.classic.dataframe import DataFrame

    df = spark.range(50_000).selectExpr("'k' AS clientid", "0 AS y_conversions", "id % 100 AS v")
    df = df.unionByName(spark.range(7).selectExpr("concat('p', id) AS clientid", "1 AS y_conversions", "id AS v"))
    collected, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(len(out := collect(self))) or out)
    out = undersample_majority(df, 1)
    monkeypatch.undo()
    assert max(collected) <= 100 + 7 and out.count() == 14
