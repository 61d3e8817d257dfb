"""Operator 7: long posting lists are found by their postings, and a list's largest part does not meet itself."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cohortex.llm import near_join

from .conftest import SF, same_rows
from .test_near_and_packing import brute_components, near_rows


@pytest.mark.parametrize("two", [False, True])
def test_cross_pairs_work_grows_with_the_nodes_outside_the_largest_part(two):
    r = np.random.default_rng(1)
    node = r.permutation(300)
    part = np.where(r.random(300) < 0.9, 1, r.integers(2, 9, 300))
    n, side = r.integers(60, 100, 300), (r.random(300) < 0.5) & two
    steps = list(near_join._cross_pairs(node, n, part, side, 75))
    got = [(int(a), int(b), int(na), int(nb)) for s in steps for a, b, na, nb in zip(*s, strict=True)]
    want = [
        (int(node[i]), int(node[j]), int(n[i]), int(n[j]))
        for i in range(300)
        for j in range(300)
        if node[i] < node[j] and part[i] != part[j] and min(n[i], n[j]) * 100 >= max(n[i], n[j]) * 75 and (not two or side[i] != side[j])
    ]
    assert sorted(got) == sorted(want) and len(steps) <= (part != 1).sum()


def test_long_lists_are_dealt_by_the_length_of_the_postings(spark, monkeypatch):
    monkeypatch.setattr(near_join, "BLOCK", 20)
    monkeypatch.setattr(near_join.candidate_pairs, "__defaults__", (20,))
    given = []
    pairs = near_join.candidate_pairs
    monkeypatch.setattr(near_join, "candidate_pairs", lambda rows, often, threshold: given.append(often) or pairs(rows, often, threshold))
    rows = near_rows(4)
    got = sorted(map(tuple, near_join.membership(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(brute_components(rows))
    assert given[0].where("n > 20").count() > 0  # the near copies' lists, held by one part


@pytest.mark.parametrize("large", [2, 5, 30])
@pytest.mark.parametrize("held", [300, 250_000])
def test_large_parts_are_met_as_a_whole(spark, monkeypatch, large, held):
    monkeypatch.setattr(near_join, "LARGE_PART", large)
    monkeypatch.setattr(near_join, "MEMBER_SHINGLES", held)
    monkeypatch.setattr(near_join, "STAR_AGREE", 6)
    monkeypatch.setattr(near_join, "STAR_ROUNDS", 1)
    met = []
    links = near_join.part_links
    monkeypatch.setattr(near_join, "part_links", lambda *a: met.append(links(*a)) or met[-1])
    rows = mutated_rows(large)
    got = sorted(map(tuple, near_join.membership(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()))
    assert got == sorted(brute_components(rows))
    assert large > 2 or (met and not met[0].isEmpty())


def mutated_rows(seed):
    """Two groups of near copies whose members lie at all distances from their group, many of them around the threshold."""
    r = random.Random(seed)
    rows = []
    for group in range(2):
        base = [f"{group}w{i}" for i in range(100)]
        for k in range(90):
            copy = list(base)
            for _ in range(k // 12):
                copy[r.randrange(100)] = f"x{r.random()}"
            rows.append(" ".join(copy[: r.choice([100, 100, 95, 85])]))
    r.shuffle(rows)
    return list(enumerate(rows, 5))


def test_nodes_meet_other_large_parts_once():
    node, n = np.arange(12), np.array([60] * 10 + [200, 70])
    part = np.array([1] * 5 + [2] * 3 + [8, 9, 10, 11])
    big = part < 3
    got = {(int(a), int(b)) for step in near_join._with_parts(node, n, part, big, 75) for a, b in zip(*step[:2], strict=True)}
    assert got == {(a, 1) for a in (5, 6, 7, 8, 9, 11)} | {(a, 2) for a in (8, 9, 11)}  # 200 is too long for either


def test_members_find_a_linked_one_exactly_if_there_is_one():
    r = np.random.default_rng(7)
    base = np.unique(r.integers(0, 2**63, 80, dtype=np.uint64))
    none = np.zeros(0, np.uint64)

    def near():
        kept = base[r.random(len(base)) < r.choice([1.0, 0.95, 0.85, 0.7])]
        return np.unique(np.concatenate([kept, r.integers(0, 2**63, int(r.integers(0, 25)), dtype=np.uint64)]))

    def row(s):
        return [near_join.prefix(s, none, k).view(np.int64) for k in (1, 2)] + [s.view(np.int64)]

    found = 0
    for _ in range(60):
        sets = [near() for _ in range(6)]
        block, asked = near_join._Members([(i, *row(s)) for i, s in enumerate(sets)]), near()
        linked = {i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, asked)) >= 75 * len(np.union1d(s, asked))}
        hit = block.linked(*row(asked), 75)
        assert hit in linked if linked else hit is None
        found += bool(linked)
    assert 10 < found < 60


def test_near_join_is_the_sql(spark):
    same_rows(near_join.op7_near_join(spark, SF), near_join.SQL)
