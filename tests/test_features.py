"""Session operators and feature tables on hand-made sessions; fused == literal."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortex.functions.rules import FIXTURE_CONVERSION, FIXTURE_RULES, Contains, EventRule
from cohortex.operators import aggregates as A
from cohortex.operators.joins import unnest_hits
from cohortex.operators.sessions import first_session, latest_session
from cohortex.plans.features import FeatureSpec, feature_columns, feature_table
from cohortex.sources.sessions import scan_window
from tests.conftest import session

RULES = (
    EventRule("Event01", eventCategory="click"),
    EventRule("Event02", eventLabel=Contains("plan")),
)
CONV = EventRule("y_conversions", eventCategory="purchase")


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_window_ends_inclusive_and_intraday_excluded(sessions_df):
    df = sessions_df(
        session(visit_id=1, suffix="20240101"),
        session(visit_id=2, suffix="20240110"),
        session(visit_id=3, suffix="intraday_20240105"),
        session(visit_id=4, suffix="20240111"),
        session(client=None, visit_id=5, suffix="20240105"),
    )
    got = rows(scan_window(df, "20240101", "20240110"), "visitId")
    assert got == [(1,), (2,)]


def test_unnest_drops_empty_and_null_hits(sessions_df):
    df = sessions_df(session(visit_id=1, hits=()), session(visit_id=2, hits=None), session(visit_id=3))
    assert rows(unnest_hits(df, "visitId"), "visitId") == [(3,)]


def test_latest_and_first_session_tiebreak(sessions_df):
    df = sessions_df(
        session(visit_id=5, start=100, suffix="20240102", channel="A", browser=None),
        session(visit_id=5, start=100, suffix="20240103", channel="B", browser="Opera"),
        session(visit_id=1, start=50, suffix="20240101", channel="F"),
    )
    latest = latest_session(df).collect()
    assert len(latest) == 1 and latest[0].channelGrouping == "B" and latest[0].browser == "Others"
    assert first_session(df).collect()[0].channelGrouping == "F"


def test_distinct_counts_skip_null_pairs(sessions_df):
    df = sessions_df(
        session(visit_id=1, medium=None, suffix="20240101"),
        session(visit_id=2, medium="cpc", suffix="20240102"),
        session(visit_id=3, medium="cpc", suffix="20240102", device="desktop"),
    )
    r = A.distinct_counts(df).collect()[0]
    assert (r.num_channels, r.num_sources, r.num_days, r.num_devices) == (1, 1, 2, 2)


def test_visit_totals_all_null_bounces_and_hour_edges(sessions_df):
    # 07:00 UTC = 04:00 local (midnight bucket), 08:00 UTC = 05:00 local (morning)
    base = 1704844800  # 2024-01-10 00:00 UTC
    df = sessions_df(
        session(visit_id=1, start=base + 7 * 3600),
        session(visit_id=2, start=base + 8 * 3600),
        session(visit_id=3, start=base + 2 * 3600),  # 23:00 local of the day before
    )
    r = A.visit_totals(df).collect()[0]
    assert r.bounces is None
    assert (r.morning_visits, r.daytime_visits, r.evening_visits, r.midnight_visits) == (1, 0, 0, 2)
    assert r.morning_visits + r.daytime_visits + r.evening_visits + r.midnight_visits == r.visits


def test_conversion_counts_having(sessions_df):
    df = sessions_df(
        session(client="a", hits=(("purchase", "x", "y"), ("purchase", "x", "y"))),
        session(client="b", hits=(("purchase", "x", "y"),)),
        session(client="c", hits=(("view", "x", "y"),)),
    )
    assert rows(A.conversion_counts(df, CONV), "clientId", "y_conversions") == [("a", 2), ("b", 1)]
    assert rows(A.conversion_counts(df, CONV, min_count=2), "clientId") == [("a",)]


def edge_sessions(sessions_df):
    return sessions_df(
        # client a: two lookback sessions, tie on visitId, one conversion later
        session(client="a", visit_id=7, start=200, suffix="20240105", channel="X", browser=None, medium=None,
                hits=(("click", "k1", "plan-plus"), ("view", "k2", None))),
        session(client="a", visit_id=7, start=200, suffix="20240106", channel="Y", browser="Edge", bounces=1,
                hits=(("click", "k1", None),)),
        session(client="a", visit_id=9, start=300, suffix="20240115", channel="Z",
                hits=(("purchase", "k3", "Plan-Basic"),)),
        # client b: only hitless sessions in the lookback -> no feature row
        session(client="b", visit_id=1, suffix="20240105", hits=()),
        session(client="b", visit_id=2, suffix="20240106", hits=None),
        # client c: one session, null device fields, null hits element fields
        session(client="c", visit_id=3, suffix="20240101", browser=None, os_name=None, device=None, mobile=None,
                hits=((None, None, None),)),
        # client d: sessions only in the conversion window
        session(client="d", visit_id=4, suffix="20240120", hits=(("purchase", "k", "plan"),)),
        # null client
        session(client=None, visit_id=5, suffix="20240105"),
    )


def spec(labelled=True, rules=RULES):
    return FeatureSpec(
        "20240101", "20240115", rules,
        conversion_start="20240115" if labelled else None,
        conversion_end="20240130" if labelled else None,
        conversion_rule=CONV if labelled else None,
    )


def test_fused_equals_literal_on_edge_cases(sessions_df):
    df = edge_sessions(sessions_df)
    for labelled in (True, False):
        s = spec(labelled)
        fused = feature_table(df, s, "fused")
        literal = feature_table(df, s, "literal")
        assert fused.columns == literal.columns == feature_columns(RULES, labelled)
        assert rows(fused, *fused.columns) == rows(literal, *literal.columns)
    got = {r.clientid: r for r in feature_table(df, spec(True), "fused").collect()}
    assert sorted(got) == ["a", "c"]
    a = got["a"]
    assert a.last_channel == "Z" and a.first_channel == "X" and a.y_conversions == 1
    assert (a.Event01, a.Event02, a.total_bounces, a.num_sources) == (2, 2, 1, 1)
    assert got["c"].total_bounces == 0 and got["c"].browser is None and got["c"].y_conversions == 0


def test_distinct_counts_are_count_distinct(sessions_df):
    df = edge_sessions(sessions_df).where("clientId IS NOT NULL")
    plain = df.groupBy("clientId").agg(
        F.count_distinct("channelGrouping").alias("num_channels"),
        F.count_distinct(A.source_pair()).alias("num_sources"),
        F.count_distinct("date").alias("num_days"),
        F.count_distinct("device.deviceCategory").alias("num_devices"))
    assert rows(A.distinct_counts(df), *plain.columns) == rows(plain, *plain.columns)


def free_text_sets(plan):
    """Whether the plan gathers sets of the source/medium pair, or expands rows."""
    return "Expand" in plan or any("collect_set" in line and "trafficSource" in line.split("collect_set", 1)[1][:40] for line in plan.splitlines())


def test_fused_plan_counts_pairs_in_two_levels(sessions_df):
    """One exchange for all features, two slim ones for the pairs, none for the join of both."""
    df = edge_sessions(sessions_df)
    for frame in (feature_table(df, spec(True), "fused"), A.visit_totals(df), A.distinct_counts(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(shuffles) == 3 and sum(", _groupingexpression" in line for line in shuffles) == 1
        assert not free_text_sets(plan)


def test_client_with_very_many_sources(spark):
    """A million distinct sources of one client: no aggregation buffer holds them."""
    from cohortex.sources.fixtures import sessions_from_events

    one = sessions_from_events(spark, "/root/testdata/sf0.001", profile=False).limit(1).drop("trafficSource", "clientId", "date")
    n = 1_000_000
    many = spark.range(n).select(
        F.lit("busy").alias("clientId"),
        (F.col("id") % 30).cast("string").alias("date"),
        F.struct(F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"), F.lit("m").alias("medium")).alias("trafficSource"))
    r = A.visit_totals(many.join(F.broadcast(one))).collect()
    assert [(x.num_sources, x.num_days, x.num_channels, x.visits) for x in r] == [(n, 30, 1, n)]


def test_regroup_equals_projection(sessions_df):
    df = edge_sessions(sessions_df)
    f = feature_table(df, spec(True), "literal")
    keys = ["clientid", "first_channel", "last_channel", "browser", "deviceCategory", "operatingSystem",
            "region", "city", "current_visit"]
    summed = [c for c in f.columns if c not in keys]
    regrouped = A.regroup(f, keys, summed).select(*f.columns)
    assert rows(regrouped, *f.columns) == rows(f, *f.columns)


def test_fixture_rules_compile(sessions_df):
    df = edge_sessions(sessions_df)
    s = FeatureSpec("20240101", "20240115", FIXTURE_RULES, conversion_start="20240115",
                    conversion_end="20240130", conversion_rule=FIXTURE_CONVERSION)
    assert feature_table(df, s).count() == 2


def test_scan_prunes_unused_hit_fields(spark, sessions_df, tmp_path):
    """Only hits.eventInfo is read from a session table whose hits carry more fields."""
    import contextlib
    import io

    df = edge_sessions(sessions_df).withColumn(
        "hits", F.transform("hits", lambda h: F.struct(h.eventInfo.alias("eventInfo"), F.lit("/p").alias("pagePath"))))
    path = str(tmp_path / "wide")
    df.write.partitionBy("suffix").parquet(path)
    table = spark.read.parquet(path)
    for form in ("fused", "literal"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            feature_table(table, spec(True), form).explain("formatted")
        plan = buf.getvalue()
        schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema:")]
        assert schemas and all("pagePath" not in s for s in schemas)
        assert all("PartitionFilters" in plan for _ in schemas)


def test_shared_scan_gives_both_datasets(spark):
    from cohortex.catalog.setup import FIXTURE
    from cohortex.plans.datasets import (
        datasets_from_shared,
        scoring_dataset,
        shared_feature_table,
        training_dataset,
    )
    from cohortex.sources.fixtures import sessions_from_events

    sessions = sessions_from_events(spark, "/root/testdata/sf0.001")
    training, scoring = datasets_from_shared(shared_feature_table(sessions, FIXTURE), FIXTURE)
    for got, want in ((training, training_dataset(sessions, FIXTURE)), (scoring, scoring_dataset(sessions, FIXTURE))):
        assert got.columns == want.columns
        assert rows(got, *got.columns) == rows(want, *want.columns)


def test_fused_independent_of_ansi_mode(spark, sessions_df):
    df = edge_sessions(sessions_df)
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        off = rows(feature_table(df, spec(True), "fused"), "*")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert off == rows(feature_table(df, spec(True), "literal"), "*")


def test_hot_client_with_a_third_of_sessions(spark):
    """One client owns a third of all sessions: results agree and the fused plan aggregates
    partially before every exchange (each task ships one row per client)."""
    from cohortex.catalog.setup import FIXTURE
    from cohortex.plans.datasets import training_spec
    from cohortex.sources.fixtures import sessions_from_events

    s = sessions_from_events(spark, "/root/testdata/sf0.01")
    hot = s.withColumn("clientId", F.when(F.col("visitId") % 3 == 0, F.lit("hot")).otherwise(F.col("clientId")))
    sp = training_spec(FIXTURE)
    fused = feature_table(hot, sp, "fused")
    literal = feature_table(hot, sp, "literal")
    assert rows(fused, *fused.columns) == rows(literal, *literal.columns)
    lb = scan_window(hot, sp.start, sp.end)
    want = lb.where(F.col("clientId") == "hot").agg(F.sum("totals.hits")).first()[0]
    assert fused.where(F.col("clientid") == "hot").first()["total_hits"] == want
    plan = fused._jdf.queryExecution().executedPlan().toString()
    steps = plan.split("Exchange hashpartitioning(clientId")[1:]
    assert len(steps) == 3 and all("partial_" in step.split("Exchange")[0] for step in steps)  # each is pre-aggregated


def test_shared_aggregate_reads_the_hits_once(spark, sessions_df, tmp_path):
    from cohortex.catalog.setup import FIXTURE
    from cohortex.plans.datasets import shared_feature_table
    from cohortex.sources.sessions import read_sessions

    path = str(tmp_path / "s")
    edge_sessions(sessions_df).write.partitionBy("suffix").parquet(path)
    plan = shared_feature_table(read_sessions(spark, path), FIXTURE)._jdf.queryExecution().executedPlan().toString()
    scans = plan.split("FileScan parquet")[1:]
    assert len(scans) == 2 and sum("hits#" in s.split("]")[0] for s in scans) == 1
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 3


def test_full_ties_have_one_winner(sessions_df):
    """Sessions that agree in visit, start and shard: fused and literal pick the same ones."""
    tied = [session(client="t", visit_id=1, start=5, suffix="20240105", channel=c, visit_number=v, browser=b)
            for c, v, b in (("B", 1, "Chrome"), ("A", 2, None), ("C", 2, "Safari"), (None, 2, "Opera"))]
    df = sessions_df(*tied)
    fused, literal = (feature_table(df.repartition(n), spec(False), form) for n, form in ((3, "fused"), (1, "literal")))
    assert rows(fused, *fused.columns) == rows(literal, *literal.columns)
    r = fused.collect()[0]
    assert (r.current_visit, r.last_channel, r.first_channel) == (2, "C", None)


def test_days_between_the_windows_are_not_read(spark, sessions_df, tmp_path):
    from cohortex.sources.sessions import read_sessions

    path = str(tmp_path / "gap")
    edge_sessions(sessions_df).write.partitionBy("suffix").parquet(path)
    s = FeatureSpec("20240101", "20240105", RULES, conversion_start="20240120", conversion_end="20240130", conversion_rule=CONV)
    table = read_sessions(spark, path)
    fused, literal = feature_table(table, s, "fused"), feature_table(table, s, "literal")
    assert rows(fused, *fused.columns) == rows(literal, *literal.columns)
    assert "20240105) OR" in " ".join(fused._jdf.queryExecution().executedPlan().toString().split()).replace("))", ")")
