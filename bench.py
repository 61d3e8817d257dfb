"""Benchmark of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4),
BENCH_REPEAT (default 3), BENCH_LEARNING_REPEAT (default 1). Warm session, median of
BENCH_REPEAT runs per query; the learning queries (100 boosting iterations) are single runs
unless BENCH_LEARNING_REPEAT says otherwise, which the JSON states as ``repeat_by_query``.

The nested sessions are derived from the benchmark tables once (timed as
``sessions_build``) and written as parquet partitioned by ``suffix``, the layout a
session export has; the feature queries then read that table with partition pruning.
Each DataFrame query is forced with a ``noop`` write (full evaluation, nothing collected).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    learning_repeat = min(repeat, int(os.environ.get("BENCH_LEARNING_REPEAT", "1")))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortex-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(4, 2 * int(cpus))) if cpus.isdigit() else "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from cohortex.catalog.setup import FIXTURE, FIXTURE_RUN
    from cohortex.context import scratch_path
    from cohortex.functions.rules import Contains, EventRule, RuleIndex
    from cohortex.operators.aggregates import event_counts, visit_totals
    from cohortex.plans.daily import DailyState
    from cohortex.plans.datasets import scoring_dataset, training_dataset, training_spec
    from cohortex.plans.run import run, train
    from cohortex.sources.fixtures import sessions_from_events, sessions_from_orders
    from cohortex.sources.sessions import client_not_null, read_sessions, scan_window

    def force(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    times: dict[str, list[float]] = {}

    def timed(name, fn, times_to_run=None):
        for _ in range(times_to_run or repeat):
            t0 = time.perf_counter()
            fn()
            times.setdefault(name, []).append(time.perf_counter() - t0)

    # source: derive nested sessions and write them partitioned by day
    table = scratch_path(spark, "bench_sessions")

    def build():
        sessions_from_events(spark, sf_dir).write.mode("overwrite").partitionBy("suffix").parquet(table)

    build()  # warm-up
    timed("sessions_build", build)
    sessions = read_sessions(spark, table)
    w = FIXTURE.windows()

    force(training_dataset(sessions, FIXTURE, form="fused"))  # warm-up
    timed("training_dataset_literal", lambda: force(training_dataset(sessions, FIXTURE, form="literal")))
    timed("training_dataset_fused", lambda: force(training_dataset(sessions, FIXTURE, form="fused")))
    timed("scoring_dataset", lambda: force(scoring_dataset(sessions, FIXTURE)))
    timed("visit_totals", lambda: force(visit_totals(scan_window(sessions, w.lookback_start, w.lookback_end))))

    # a sliding window: the daily state is there, one new day is read
    training = training_spec(FIXTURE)
    state = DailyState(scratch_path(spark, "bench_state"), training.rules, training.conversion_rule, training.tz)
    state.add(sessions, training.start, training.conversion_end)

    def next_day():
        state.add(sessions, training.conversion_end, training.conversion_end)
        force(state.features(spark, training))

    next_day()  # warm-up
    timed("daily_features_next_day", next_day)

    # hits: 25 rules over every order line, counted inside the sessions and after unnesting
    orders = scratch_path(spark, "bench_orders")
    client_not_null(sessions_from_orders(spark, sf_dir)).write.parquet(orders)
    lines = read_sessions(spark, orders)
    rules = [EventRule(f"r{n:02}", eventCategory="ANR"[n % 3], eventAction="OF"[n % 2] if n % 5 else Contains("F")) for n in range(25)]
    index = RuleIndex(rules)
    inside = lines.withColumn("m", index.matches(F.col("hits.eventInfo"))).groupBy("clientId")
    timed("event_counts_25_rules", lambda: force(event_counts(lines, rules)))
    timed("session_counts_25_rules", lambda: force(inside.agg(*[F.sum(index.count(r, F.col("m"))).alias(r.name) for r in rules])))
    cfg = FIXTURE_RUN
    timed("train_classifier", lambda: train(spark, cfg, sessions), learning_repeat)
    timed(
        "run_audience",
        lambda: run(spark, replace(cfg, destination_table=scratch_path(spark, "bench_audience")), sessions).count(),
        learning_repeat,
    )

    def plan_facts(df) -> dict:
        text = df._jdf.queryExecution().executedPlan().toString()
        return {"exchanges": text.count("Exchange"), "parquet_scans": text.count("FileScan parquet")}

    plans = {
        "training_dataset_fused": plan_facts(training_dataset(sessions, FIXTURE, form="fused")),
        "training_dataset_literal": plan_facts(training_dataset(sessions, FIXTURE, form="literal")),
    }
    sizes = sessions.agg(F.count(F.lit(1)).alias("sessions"), F.count_distinct("clientId").alias("clients")).first()
    medians = {k: round(statistics.median(v), 3) for k, v in times.items()}
    print(
        json.dumps(
            {
                "metric": "audience_suite_total_median_sec",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "repeat": repeat,
                "repeat_by_query": {k: len(v) for k, v in times.items()},
                "max_iter": cfg.max_iter,
                "plans": plans,
                "input": {"sessions": sizes["sessions"], "clients": sizes["clients"]},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
