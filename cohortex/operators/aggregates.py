"""Per-client aggregates of the feature queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortex.functions.rules import EventRule, RuleIndex
from cohortex.functions.scalar import HOUR_BUCKETS, concat_pair, in_hours, local_hour, revenue_scaled
from cohortex.operators.joins import unnest_hits
from cohortex.operators.rollup import Guarded, Part, by_client, distinct_of_domain, distinct_pairs, total

TOTAL_FIELDS = ("visits", "pageviews", "hits", "timeonsite", "bounces")


def rule_flag(rule: EventRule, event_info: Column) -> Column:
    """1 when the hit matches the rule, else 0 (a null comparison is no match)."""
    return F.when(rule.predicate(event_info), F.lit(1)).otherwise(F.lit(0))


def source_pair() -> Column:
    return concat_pair(F.col("trafficSource.source"), F.col("trafficSource.medium"))


def distinct_parts() -> list[Part]:
    """``COUNT(DISTINCT ..)`` of channel, source/medium pair, day and device category."""
    return [
        distinct_of_domain("num_channels", F.col("channelGrouping")),
        distinct_pairs("num_sources"),
        distinct_of_domain("num_days", F.col("date")),
        distinct_of_domain("num_devices", F.col("device.deviceCategory")),
    ]


def distinct_counts(sessions: DataFrame) -> DataFrame:
    """The four distinct counts per client (A2)."""
    return by_client(sessions, source_pair(), [Guarded(distinct_parts())])


def visit_totals(sessions: DataFrame, tz: str = "America/Sao_Paulo", revenue_divisor: int = 100000) -> DataFrame:
    """Visit totals per client over a scanned window (C3: A1-A4, F5, F7-F9)."""
    rows = sessions.withColumn("_hour", local_hour(F.col("visitStartTime"), tz))
    parts = [
        *distinct_parts(),
        *[total(f, F.col(f"totals.{f}")) for f in TOTAL_FIELDS],
        *[total(f"{name}_visits", in_hours(F.col("_hour"), hours)) for name, hours in HOUR_BUCKETS.items()],
        total("transactions", F.col("totals.transactions")),
        total("revenue", F.col("totals.totalTransactionRevenue"), lambda c: revenue_scaled(c, revenue_divisor)),
    ]
    return by_client(rows, source_pair(), [Guarded(parts)])


def event_counts(sessions: DataFrame, rules: Sequence[EventRule]) -> DataFrame:
    """One count per rule of the client's matching hits (J1 + A5). A hit is tested once for all
    rules; partial aggregation runs in the same stage, so only one row per client and task is
    shuffled."""
    index = RuleIndex(rules)
    words = [f"_w{w}" for w in range(index.words)]
    masks = [m.alias(w) for w, m in zip(words, index.masks(F.col("eventInfo")), strict=True)]
    hits = unnest_hits(sessions, "clientId").select("clientId", *masks)
    return hits.groupBy("clientId").agg(*[F.sum(index.flag(r, [F.col(w) for w in words])).alias(r.name) for r in rules])


def conversion_counts(sessions: DataFrame, rule: EventRule, min_count: int = 1) -> DataFrame:
    """``COUNT(1)`` of matching hits per client, kept when at least ``min_count``."""
    hits = unnest_hits(sessions, "clientId").where(rule.predicate(F.col("eventInfo")))
    counts = hits.groupBy("clientId").agg(F.count(F.lit(1)).alias(rule.name))
    return counts.where(F.col(rule.name) >= min_count)


def class_distribution(df: DataFrame, label: str = "y_conversions") -> DataFrame:
    """``value_counts()`` of the label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def dataset_shape(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row frame (A8); the count runs on the executors."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def regroup(df: DataFrame, keys: Sequence[str], summed: Sequence[str]) -> DataFrame:
    """``GROUP BY keys`` with ``SUM`` of the other columns (A9, literal form)."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in summed])
