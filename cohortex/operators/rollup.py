"""Mergeable per-client aggregates.

A client's distinct source/medium pairs come from free text, so a set of them is not bounded.
They are counted in two levels: rows are grouped by client *and pair*, then by client, so pairs
are rows of the first level and no aggregation buffer holds more than one. That branch reads
two slim columns; all other features are aggregates of one ``groupBy(client)`` whose buffers are
bounded: sums, largest and smallest structs, sets over small domains (channels, days, devices).
Both branches end partitioned by client, so joining them needs no further shuffle. A client with a
third of all sessions is spread over its pairs, and every shuffle is pre-aggregated.

Every part can be merged, so the same parts also roll up stored daily states
(:mod:`cohortex.plans.daily`), there by client and pair first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = "_pair"
Aggregate = Callable[[Column], Column]


@dataclass(frozen=True)
class Part:
    """One feature: ``inner`` over the row ``value``, ``merge`` over results of one client and
    pair, ``across`` over a client's pairs (``merge`` if not given), ``final`` on the result."""

    name: str
    value: Column
    inner: Aggregate
    merge: Aggregate
    across: Aggregate | None = None
    final: Aggregate | None = None


@dataclass(frozen=True)
class Guarded:
    """Parts restricted to the rows where ``where`` holds, in columns named ``prefix`` + name."""

    parts: Sequence[Part]
    where: Column | None = None
    prefix: str = ""

    def guard(self, c: Column) -> Column:
        return c if self.where is None else F.when(self.where, c)


def total(name: str, value: Column, final: Aggregate | None = None) -> Part:
    return Part(name, value, F.sum, F.sum, final=final)


def largest(name: str, value: Column, final: Aggregate | None = None) -> Part:
    return Part(name, value, F.max, F.max, final=final)


def smallest(name: str, value: Column, final: Aggregate | None = None) -> Part:
    return Part(name, value, F.min, F.min, final=final)


def distinct_of_domain(name: str, value: Column) -> Part:
    """``COUNT(DISTINCT value)`` of a column with a small domain (its sets are held whole)."""

    def union(sets: Column) -> Column:
        return F.array_distinct(F.flatten(F.collect_set(sets)))

    return Part(name, value, F.collect_set, union, final=lambda c: F.size(c).cast("bigint"))


def distinct_pairs(name: str) -> Part:
    """``COUNT(DISTINCT pair)``: the client's first-level rows that hold a pair and a guarded row."""

    def count(seen: Column) -> Column:
        return F.sum(F.when(seen & F.col(PAIR).isNotNull(), F.lit(1)).otherwise(F.lit(0)))

    return Part(name, F.lit(True), F.max, F.max, across=count)


def _across(first: DataFrame, key: str, groups: Sequence[Guarded]) -> DataFrame:
    every = [(g.prefix + p.name, p) for g in groups for p in g.parts]
    return _finished(first.groupBy(key).agg(*[(p.across or p.merge)(F.col(n)).alias(n) for n, p in every]), key, groups)


def _finished(merged: DataFrame, key: str, groups: Sequence[Guarded]) -> DataFrame:
    every = [(g.prefix + p.name, p) for g in groups for p in g.parts]
    return merged.select(key, *[(p.final(F.col(n)) if p.final else F.col(n)).alias(n) for n, p in every])


def by_client(rows: DataFrame, pair: Column, groups: Sequence[Guarded], key: str = "clientId") -> DataFrame:
    """One row per client: every part of every group, over session rows of known clients."""
    plain = [(g, p) for g in groups for p in g.parts if p.across is None]
    paired = [(g, p) for g in groups for p in g.parts if p.across is not None]
    out = rows.groupBy(key).agg(*[p.inner(g.guard(p.value)).alias(g.prefix + p.name) for g, p in plain]) if plain else None
    if paired:
        first = rows.groupBy(key, pair.alias(PAIR)).agg(*[p.inner(g.guard(p.value)).alias(g.prefix + p.name) for g, p in paired])
        counted = first.groupBy(key).agg(*[p.across(F.col(g.prefix + p.name)).alias(g.prefix + p.name) for g, p in paired])
        out = counted if out is None else out.join(counted, key)
    return _finished(out, key, groups)


def state_by(rows: DataFrame, pair: Column, parts: Sequence[Part], keys: Sequence[str]) -> DataFrame:
    """Unfinished parts per ``keys`` and pair, to be stored and merged later."""
    return rows.groupBy(*keys, pair.alias(PAIR)).agg(*[p.inner(p.value).alias(p.name) for p in parts])


def merge_states(states: DataFrame, groups: Sequence[Guarded], key: str = "clientId") -> DataFrame:
    """One row per client out of stored states, each group over the states its guard lets in."""
    merged = [p.merge(g.guard(F.col(p.name))).alias(g.prefix + p.name) for g in groups for p in g.parts]
    return _across(states.groupBy(key, PAIR).agg(*merged), key, groups)
