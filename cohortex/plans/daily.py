"""Daily state: per client, pair and day, the mergeable parts of every feature (C1, C2 over time).

A sliding window of 60 days re-reads 59 days of hits that yesterday's run has read. Kept per
day, the unfinished parts of :func:`cohortex.plans.features.session_parts` are some numbers,
two structs and three small sets per client, pair and day; a new window reads one new day of
sessions and merges the days it covers. Features from the state equal those of a full scan.

The state is parquet partitioned by ``suffix`` under a folder named by a digest of the rules and
the time zone, so another campaign never reads it. Adding a day replaces that day's partition, so
a repeated or retried run changes nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.functions.rules import EventRule
from cohortex.operators.aggregates import source_pair
from cohortex.operators.rollup import merge_states, state_by
from cohortex.plans.features import FeatureSpec, guarded_parts, label_part, select_spec, session_parts, session_rows, windows_of
from cohortex.sources.schema import SESSION_SCHEMA
from cohortex.sources.sessions import suffix_between
from cohortex.sources.sinks import exists, read_back, write_append


def days_between(start: str, end: str) -> list[str]:
    """All ``yyyyMMdd`` days from ``start`` to ``end``, both included."""
    first, last = (dt.datetime.strptime(d, "%Y%m%d").date() for d in (start, end))
    return [(first + dt.timedelta(days=n)).strftime("%Y%m%d") for n in range((last - first).days + 1)]


@dataclass(frozen=True)
class DailyState:
    root: str
    rules: tuple[EventRule, ...]
    conversion_rule: EventRule
    tz: str = "America/Sao_Paulo"

    @property
    def path(self) -> str:
        what = repr((self.rules, self.conversion_rule.constraints(), self.tz))
        return f"{self.root.rstrip('/')}/state-{hashlib.md5(what.encode()).hexdigest()[:16]}"

    def of(self, sessions: DataFrame, start: str, end: str) -> DataFrame:
        """The state rows of the days ``[start, end]``, from their sessions alone."""
        rows = session_rows(sessions, [(start, end)], [*self.rules, self.conversion_rule], [self.tz])
        parts = [*session_parts(self.rules, self.tz), label_part(self.conversion_rule)]
        return state_by(rows, source_pair(), parts, ["clientId", "suffix"])

    def add(self, sessions: DataFrame, start: str, end: str) -> None:
        """Write (or replace) the days ``[start, end]`` and note them as read, those without sessions too."""
        rows = self.of(sessions, start, end)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("suffix").parquet(self.path)
        days = [(d,) for d in days_between(start, end)]
        write_append(sessions.sparkSession.createDataFrame(days, "day string").coalesce(1), f"{self.path}-days")

    def read(self, spark: SparkSession) -> DataFrame:
        schema = self.of(spark.createDataFrame([], SESSION_SCHEMA), "00010101", "00010101").schema
        return spark.read.schema(schema).parquet(self.path)

    def stored_days(self, spark: SparkSession) -> set[str]:
        """Days that have been read (one small row per day reaches the driver)."""
        if not exists(spark, f"{self.path}-days"):
            return set()
        return {r[0] for r in read_back(spark, f"{self.path}-days").distinct().collect()}

    def bring_up_to_date(self, sessions: DataFrame, start: str, end: str, refresh: int = 1) -> list[str]:
        """Add the days of ``[start, end]`` that are missing, and the last ``refresh`` days again
        (they may have been incomplete). Runs of neighbouring days are one job. Returns the days read."""
        days = days_between(start, end)
        stored = self.stored_days(sessions.sparkSession)
        todo = [d for n, d in enumerate(days) if d not in stored or n >= len(days) - refresh]
        runs: list[list[str]] = []
        for d in todo:
            if runs and days.index(d) == days.index(runs[-1][-1]) + 1:
                runs[-1].append(d)
            else:
                runs.append([d])
        for run in runs:
            self.add(sessions, run[0], run[-1])
        return todo

    def merged(self, spark: SparkSession, specs: dict[str, FeatureSpec]) -> DataFrame:
        """The per-client aggregates of all specs, as from ``features_fused_many`` over the sessions."""
        for spec in specs.values():
            if spec.rules != self.rules or spec.tz != self.tz or (spec.labelled and spec.conversion_rule != self.conversion_rule):
                raise ValueError("the spec's rules or time zone are not those of the state")
        windows = {w for spec in specs.values() for w in windows_of(spec)}
        inside = F.lit(False)
        for a, b in sorted(windows):
            inside = inside | suffix_between(a, b)
        return merge_states(self.read(spark).where(inside), guarded_parts(specs))

    def features(self, spark: SparkSession, spec: FeatureSpec) -> DataFrame:
        return select_spec(self.merged(spark, {"f": spec}), spec, "f")
