"""Feature tables: one row per client (C1 training, C2 scoring, C3 visit totals).

Two plans give identical rows:

* ``literal``: one sub-plan per step (latest session, first session, totals, event counts,
  conversions) joined on the client, the structure of a CTE-per-step SQL query. Spark
  scans the window once per step and joins four or five per-client results.
* ``fused``: one scan of the windows and one ``groupBy(clientId)``; window membership is a
  guard inside each aggregate. A session's hits are tested once for all rules, in the
  windows only, so the aggregate sees one row per session and the scan reads only the event
  structs of the hits. Distinct source/medium pairs are counted beside it from two slim
  columns (:mod:`cohortex.operators.rollup`). Every exchange carries pre-aggregated rows: a
  client with a third of all sessions costs one partial row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortex.functions.rules import EventRule, RuleIndex
from cohortex.functions.scalar import (
    BROWSER_KEEP,
    HOUR_BUCKETS,
    OS_KEEP,
    bucket_rare,
    ifnull_zero,
    in_hours,
    label_binary,
    local_hour,
)
from cohortex.operators.aggregates import conversion_counts, distinct_parts, event_counts, source_pair, visit_totals
from cohortex.operators.joins import join_on_client
from cohortex.operators.rollup import Guarded, Part, by_client, largest, smallest, total
from cohortex.operators.sessions import SESSION_ORDER, first_session, latest_session
from cohortex.sources.sessions import client_not_null, scan_window, suffix_between

CATEGORICAL = ("first_channel", "last_channel", "browser", "deviceCategory", "operatingSystem", "region", "city")
NUMERIC = (
    "current_visit",
    "num_channels",
    "num_sources",
    "num_days",
    "num_devices",
    "total_visits",
    "total_pageviews",
    "total_hits",
    "total_timeonsite",
    "total_bounces",
    "total_morning_visits",
    "total_daytime_visits",
    "total_evening_visits",
    "total_midnight_visits",
    "total_transactions",
)
LABEL = "y_conversions"
TOTALS_SUMMED = ("visits", "pageviews", "hits", "timeonsite", "bounces")
KEY = "clientid"

# per-client total -> feature column (all wrapped in IFNULL(.., 0))
_TOTALS = {
    "num_channels": "num_channels",
    "num_sources": "num_sources",
    "num_days": "num_days",
    "num_devices": "num_devices",
    "visits": "total_visits",
    "pageviews": "total_pageviews",
    "hits": "total_hits",
    "timeonsite": "total_timeonsite",
    "bounces": "total_bounces",
    "morning_visits": "total_morning_visits",
    "daytime_visits": "total_daytime_visits",
    "evening_visits": "total_evening_visits",
    "midnight_visits": "total_midnight_visits",
    "transactions": "total_transactions",
}


@dataclass(frozen=True)
class FeatureSpec:
    """What to compute: the lookback window, rules, and optionally the label window."""

    start: str
    end: str
    rules: tuple[EventRule, ...]
    tz: str = "America/Sao_Paulo"
    conversion_start: str | None = None
    conversion_end: str | None = None
    conversion_rule: EventRule | None = None

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"window start {self.start} is after its end {self.end}")
        if self.conversion_rule is not None:
            if not (self.conversion_start and self.conversion_end):
                raise ValueError("a labelled spec needs conversion_start and conversion_end")
            if self.conversion_start > self.conversion_end:
                raise ValueError("conversion window start is after its end")

    @property
    def labelled(self) -> bool:
        return self.conversion_rule is not None


def feature_columns(rules: Sequence[EventRule], labelled: bool) -> list[str]:
    cols = [KEY, *CATEGORICAL, *NUMERIC, *[r.name for r in rules]]
    return cols + [LABEL] if labelled else cols


def _final_projection(df: DataFrame, spec: FeatureSpec, conversions: Column | None, col=F.col) -> DataFrame:
    cols = [
        F.col("clientId").alias(KEY),
        col("first_channel").alias("first_channel"),
        col("last_channel").alias("last_channel"),
        col("browser").alias("browser"),
        col("deviceCategory").alias("deviceCategory"),
        col("operatingSystem").alias("operatingSystem"),
        col("region").alias("region"),
        col("city").alias("city"),
        col("visitNumber").alias("current_visit"),
        *[ifnull_zero(col(src)).cast("bigint").alias(dst) for src, dst in _TOTALS.items()],
        *[col(r.name).cast("bigint").alias(r.name) for r in spec.rules],
    ]
    if spec.labelled:
        cols.append(label_binary(conversions).alias(LABEL))
    return df.select(*cols)


def features_literal(sessions: DataFrame, spec: FeatureSpec) -> DataFrame:
    """CTE-per-step plan (the readable form and the test partner of ``features_fused``)."""
    lookback = scan_window(sessions, spec.start, spec.end)
    hits = event_counts(lookback, spec.rules)
    latest = latest_session(lookback).withColumnRenamed("channelGrouping", "last_channel")
    first = first_session(lookback).withColumnRenamed("channelGrouping", "first_channel")
    totals = visit_totals(lookback, spec.tz).drop("revenue")
    joined = join_on_client(hits, latest, "inner")
    joined = join_on_client(joined, first, "inner")
    joined = join_on_client(joined, totals, "left")
    conv = None
    if spec.labelled:
        window = scan_window(sessions, spec.conversion_start, spec.conversion_end)
        converted = conversion_counts(window, spec.conversion_rule).withColumnRenamed(spec.conversion_rule.name, "_conv")
        joined = join_on_client(joined, converted, "left")
        conv = F.col("_conv")
    return _final_projection(joined, spec, conv)


def count_name(rule: EventRule) -> str:
    """Column name of a rule's per-session count; equal rules share one column."""
    return "_hc_" + hashlib.md5(repr(tuple(rule.constraints())).encode()).hexdigest()[:12]


def hour_name(tz: str) -> str:
    return "_hour_" + hashlib.md5(tz.encode()).hexdigest()[:12]


def windows_of(spec: FeatureSpec) -> list[tuple[str, str]]:
    return [(spec.start, spec.end)] + ([(spec.conversion_start, spec.conversion_end)] if spec.labelled else [])


def rules_of(spec: FeatureSpec) -> list[EventRule]:
    return [*spec.rules, *([spec.conversion_rule] if spec.labelled else [])]


def session_rows(sessions: DataFrame, windows: Sequence[tuple[str, str]], rules: Sequence[EventRule], zones: Sequence[str]) -> DataFrame:
    """Sessions of the windows with their local hours and their hits counted by rule; the hits array is dropped.

    Only days of a window are read. Counting inside each session keeps one row per session (no
    exploded rows) and goes through the field access ``hits.eventInfo``, so the scan reads only
    the event structs of the hits.
    """
    wanted = reduce(or_, [suffix_between(a, b) for a, b in sorted(set(windows))])
    scan = client_not_null(sessions.where(wanted))
    info = F.col("hits").getField("eventInfo")
    index = RuleIndex(rules)
    # size(NULL) is -1 in non-ANSI sessions with the legacy default; keep it null
    first = {"_hits_n": F.when(info.isNotNull(), F.size(info)), "_matches": index.matches(info)}
    first |= {hour_name(tz): local_hour(F.col("visitStartTime"), tz) for tz in zones}
    counts = {count_name(r): index.count(r, F.col("_matches")) for r in rules}
    return scan.withColumns(first).withColumns(counts).drop("hits", "_matches")


def session_parts(rules: Sequence[EventRule], tz: str) -> list[Part]:
    """Every feature of a window but the label, as mergeable parts over :func:`session_rows`."""
    order = [F.col(c) for c in SESSION_ORDER]
    latest = [
        F.col("visitNumber"),
        F.col("channelGrouping"),
        bucket_rare(F.col("device.browser"), BROWSER_KEEP).alias("browser"),
        F.col("device.deviceCategory").alias("deviceCategory"),
        bucket_rare(F.col("device.operatingSystem"), OS_KEEP).alias("operatingSystem"),
        F.col("geoNetwork.region").alias("region"),
        F.col("geoNetwork.city").alias("city"),
    ]
    return [
        # ties of the order go to the largest attributes (latest) and the least channel (first)
        largest("latest", F.struct(F.struct(*order).alias("at"), F.struct(*latest).alias("row")), lambda c: c["row"]),
        smallest("first_channel", F.struct(F.struct(*order).alias("at"), F.col("channelGrouping").alias("row")), lambda c: c["row"]),
        *distinct_parts(),
        *[total(f, F.col(f"totals.{f}")) for f in TOTALS_SUMMED],
        *[total(f"{name}_visits", in_hours(F.col(hour_name(tz)), hours)) for name, hours in HOUR_BUCKETS.items()],
        total("transactions", F.col("totals.transactions")),
        total("_n_hits", F.col("_hits_n")),
        *[total(r.name, F.col(count_name(r))) for r in rules],
    ]


def label_part(rule: EventRule) -> Part:
    return total("_conv", F.col(count_name(rule)))


def guarded_parts(specs: dict[str, FeatureSpec], suffix: str = "suffix") -> list[Guarded]:
    """The parts of every spec, guarded by its windows, in columns prefixed ``<name>__``."""
    groups = []
    for name, spec in specs.items():
        groups.append(Guarded(session_parts(spec.rules, spec.tz), suffix_between(spec.start, spec.end, suffix), f"{name}__"))
        if spec.labelled:
            inside = suffix_between(spec.conversion_start, spec.conversion_end, suffix)
            groups.append(Guarded([label_part(spec.conversion_rule)], inside, f"{name}__"))
    return groups


def features_fused_many(sessions: DataFrame, specs: dict[str, FeatureSpec]) -> DataFrame:
    """One aggregation over the windows with the parts of every spec
    (columns prefixed ``<name>__``). Use :func:`select_spec` to get one feature table out of
    it. A training and a scoring table share one scan this way."""
    rules = [r for spec in specs.values() for r in rules_of(spec)]
    windows = [w for spec in specs.values() for w in windows_of(spec)]
    rows = session_rows(sessions, windows, rules, sorted({spec.tz for spec in specs.values()}))
    return by_client(rows, source_pair(), guarded_parts(specs))


_LATEST_FIELDS = {"visitNumber", "last_channel", "browser", "deviceCategory", "operatingSystem", "region", "city"}


def select_spec(wide: DataFrame, spec: FeatureSpec, name: str) -> DataFrame:
    """The feature table of one spec from :func:`features_fused_many` output. Clients need at
    least one hit in the spec's window (the unnest + inner join of the step-wise plan)."""
    p = f"{name}__"

    def col(c: str) -> Column:
        if c in _LATEST_FIELDS:
            return F.col(f"{p}latest").getField("channelGrouping" if c == "last_channel" else c)
        return F.col(p + c)

    present = wide.where(F.coalesce(F.col(f"{p}_n_hits"), F.lit(0)) > 0)
    return _final_projection(present, spec, F.col(f"{p}_conv") if spec.labelled else None, col)


def features_fused(sessions: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Every feature is an aggregate over the client's sessions."""
    return select_spec(features_fused_many(sessions, {"f": spec}), spec, "f")


def feature_table(sessions: DataFrame, spec: FeatureSpec, form: str = "fused") -> DataFrame:
    if form == "fused":
        return features_fused(sessions, spec)
    if form == "literal":
        return features_literal(sessions, spec)
    raise ValueError(f"unknown plan form {form!r}")
