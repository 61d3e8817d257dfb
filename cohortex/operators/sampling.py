"""Sampling: seeded majority downsampling (P9, U1), exact undersampling (M1), stratified
split (M2).

All randomness is a hash of the client key and a seed (``hash_u32``), so results do not
depend on partitioning or retries, and the DuckDB oracle can reproduce them.

Exact "first n rows" without a global sort: rows are ordered by the key's 32-bit hash, the key and
a 64-bit hash of their whole content. Hashes are read in 16-bit digits: one aggregation counts
rows per class and first digit (at most 65,536 counts per class reach the driver) and fixes the
boundary digit, the next one counts second digits inside it, and so on until all rows of a digit
are needed. With unique keys that takes two passes. Where keys share the boundary hash (rows /
2^32 of them are expected) a running sum on the executors finds the boundary key, one row per
class; where a key repeats, the digits of the content hash follow. Rows that agree in all of it
are equal in every column, so any of them will do: they are counted, and as many copies as needed
are marked. Keys may repeat or be null; no list of keys is collected, no task holds a whole class.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortex.functions.scalar import hash_u32, hash_uniform


def downsample_majority(
    df: DataFrame, p: float, seed: int, label: str = "y_conversions", key: str = "clientid"
) -> DataFrame:
    """Keep all positives and a ``p`` share of the negatives: one filter, one scan."""
    keep_negative = (F.col(label) == 0) & (hash_uniform(F.col(key), seed) <= F.lit(p))
    return df.where((F.col(label) == 1) | keep_negative)


def union_all_split(df: DataFrame, p: float, seed: int, label: str = "y_conversions", key: str = "clientid") -> DataFrame:
    """The ``UNION ALL`` form: sampled negatives, then all positives (equal to the filter)."""
    neg = df.where((F.col(label) == 0) & (hash_uniform(F.col(key), seed) <= F.lit(p)))
    return neg.unionByName(df.where(F.col(label) == 1))


def content_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a whole row that tells nulls apart."""
    return F.xxhash64(*[c for name in df.columns for c in (F.col(name), F.col(name).isNull())])


_KEY_LEVEL = 2


def _levels(df: DataFrame, key: str, seed: int) -> list[Column]:
    """The row order: two digits of the key hash, the key, four digits of the content hash."""
    h = F.coalesce(hash_u32(F.col(key), seed), F.lit(0).cast("long"))
    c = content_hash(df)
    mask = F.lit(0xFFFF).cast("long")
    content = [F.shiftrightunsigned(c, 48 - 16 * k).bitwiseAND(mask) for k in range(4)]
    return [F.shiftright(h, 16), h.bitwiseAND(mask), F.coalesce(F.col(key).cast("string"), F.lit("")), *content]


@dataclass(frozen=True)
class Cut:
    """The first ``n`` rows of a class: those before ``prefix`` in the order and, of those that
    begin with it, all (``copies`` is None) or ``copies`` of the equal rows it names."""

    n: int
    prefix: tuple | None = None  # None: every row
    copies: int | None = None

    def column(self, levels: list[Column]) -> Column:
        """Whether a row is among the first n; the rows at the prefix only if all of them are."""
        if self.n <= 0:
            return F.lit(False)
        if self.prefix is None:
            return F.lit(True)
        own = F.struct(*[c.alias(f"l{k}") for k, c in enumerate(levels[: len(self.prefix)])])
        at = F.struct(*[_literal(v).alias(f"l{k}") for k, v in enumerate(self.prefix)])
        return own <= at if self.copies is None else own < at

    def at_prefix(self, levels: list[Column]) -> Column:
        return _begins_with(levels, self.prefix)


def _literal(value: int | str) -> Column:
    return F.lit(value) if isinstance(value, str) else F.lit(value).cast("long")


def _begins_with(levels: list[Column], prefix: tuple) -> Column:
    return reduce(and_, [c == _literal(v) for c, v in zip(levels, prefix, strict=False)], F.lit(True))


def _boundary(counts: dict[int, int], n: int) -> tuple[int, int, bool]:
    """(digit of the n-th row, rows still needed from it, whether those are all it has)."""
    acc = 0
    for digit in sorted(counts):
        if acc + counts[digit] >= n:
            return digit, n - acc, acc + counts[digit] == n
        acc += counts[digit]
    raise ValueError("fewer rows than requested")


def _boundary_keys(rows: DataFrame, needed: dict) -> dict:
    """(key of the n-th row, rows still needed from it, whether those are all it has) per group."""
    counted = rows.groupBy("_g", f"_l{_KEY_LEVEL}").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy("_g").orderBy(f"_l{_KEY_LEVEL}"))
    need = reduce(lambda c, g: c.when(F.col("_g") == F.lit(g), needed[g]), needed, F.when(F.lit(False), 0))
    reached = counted.withColumn("upto", running).where((F.col("upto") >= need) & (F.col("upto") - F.col("n") < need))
    return {r["_g"]: (r[f"_l{_KEY_LEVEL}"], needed[r["_g"]] - (r["upto"] - r["n"]), r["upto"] == needed[r["_g"]]) for r in reached.collect()}


def first_n_per_group(
    df: DataFrame, want: Callable[[dict], dict], seed: int, key: str = "clientid", label: str | None = None
) -> tuple[dict, dict[object, Cut]]:
    """(sizes, cuts) of the groups (values of ``label``): each cut selects the first rows of its group.

    ``want`` maps the group sizes to the wanted numbers. One aggregation per level serves all
    groups together; groups that are settled drop out.
    """
    group = F.col(label) if label else F.lit(0)
    rows = df.select(group.alias("_g"), *[c.alias(f"_l{k}") for k, c in enumerate(_levels(df, key, seed))])
    names = [c for c in rows.columns if c != "_g"]

    def counted(frame: DataFrame, k: int) -> dict:
        out: dict = {}
        for g, digit, n in frame.groupBy("_g", names[k]).count().collect():
            out.setdefault(g, {})[digit] = n
        return out

    first = counted(rows, 0)
    sizes = {g: sum(c.values()) for g, c in first.items()}
    wanted = want(sizes)
    cuts = {g: Cut(n) for g, n in wanted.items() if n <= 0 or n >= sizes.get(g, 0)}
    unsettled = {g: ((), n) for g, n in wanted.items() if g not in cuts}  # prefix so far, rows needed from it
    for k in range(len(names)):
        if not unsettled:
            break
        inside = [(F.col("_g") == F.lit(g)) & _begins_with([F.col(c) for c in names], prefix) for g, (prefix, _) in unsettled.items()]
        here = rows.where(reduce(or_, inside))
        if k == _KEY_LEVEL:
            found = _boundary_keys(here, {g: n for g, (_, n) in unsettled.items()})
        else:
            counts = counted(here, k) if k else first
            found = {g: _boundary(counts[g], n) for g, (_, n) in unsettled.items()}
        for g, (value, need, whole) in found.items():
            prefix = (*unsettled.pop(g)[0], value)
            if whole:
                cuts[g] = Cut(wanted[g], prefix)
            elif k == len(names) - 1:
                cuts[g] = Cut(wanted[g], prefix, need)
            else:
                unsettled[g] = (prefix, need)
    return sizes, cuts


def with_selection(df: DataFrame, cuts: dict[object, Cut], seed: int, key: str, label: str | None, name: str) -> DataFrame:
    """``df`` plus the boolean ``name``: whether a row is among the first of its group.

    Where a cut takes only some of several equal rows, these are counted and written out again,
    the wanted number of them marked.
    """
    levels = _levels(df, key, seed)
    chosen, split = F.lit(False), []
    for g, cut in cuts.items():
        mine = F.col(label) == F.lit(g) if label else F.lit(True)
        chosen = chosen | (mine & cut.column(levels))
        if cut.copies is not None:
            split.append((F.coalesce(mine & cut.at_prefix(levels), F.lit(False)), cut.copies))
    if not split:
        return df.withColumn(name, F.coalesce(chosen, F.lit(False)))
    out = df.where(~reduce(or_, [rows for rows, _ in split])).withColumn(name, F.coalesce(chosen, F.lit(False)))
    for rows, copies in split:
        equal = df.where(rows).groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))
        each = equal.withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(name))))
        out = out.unionByName(each.withColumn(name, F.col(name) <= copies))
    return out


def first_n_by_hash(df: DataFrame, n: int, seed: int = 0, key: str = "clientid") -> DataFrame:
    """The ``n`` first rows of ``df`` in the order of key hash, key and content."""
    _, cuts = first_n_per_group(df, lambda sizes: {0: n}, seed, key)
    return with_selection(df, cuts, seed, key, None, "_first").where("_first").drop("_first")


def _require_two_classes(counts: dict, label: str) -> None:
    present = [k for k, v in counts.items() if v > 0]
    if len(present) < 2:
        raise ValueError(f"{label!r} has {len(present)} class(es) {sorted(present)}; two are needed")


def undersample_majority(df: DataFrame, seed: int, label: str = "y_conversions", key: str = "clientid") -> DataFrame:
    """Shrink the largest class to the size of the smallest (exact 1:1 for two classes)."""

    def want(sizes: dict) -> dict:
        _require_two_classes(sizes, label)
        n_min = min(sizes.values())
        majority = max(sizes, key=lambda c: (sizes[c], c))
        return {c: (n_min if c == majority else n) for c, n in sizes.items()}

    _, cuts = first_n_per_group(df, want, seed, key, label)
    return with_selection(df, cuts, seed, key, label, "_kept").where("_kept").drop("_kept")


def stratified_split(
    df: DataFrame, test_size: float, seed: int, label: str = "y_conversions", key: str = "clientid"
) -> DataFrame:
    """Adds ``is_test``: per class the first ``ceil(n_c * test_size)`` rows by hash are test.

    The class ratio is the same in both parts; the parts are disjoint and complete.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie strictly between 0 and 1")

    def want(sizes: dict) -> dict:
        _require_two_classes(sizes, label)
        return {c: math.ceil(n * test_size) for c, n in sizes.items()}

    _, cuts = first_n_per_group(df, want, seed, key, label)
    return with_selection(df, cuts, seed, key, label, "is_test")
