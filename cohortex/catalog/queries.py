"""Registered queries: key -> (Spark callable(spark, sf_dir) -> DataFrame, DuckDB SQL | None).

Every query reads the benchmark tables (sessions are derived from them by Spark) and runs
over the whole tables. Keys follow the operator inventory; the learning queries return facts
about every row of their results that SQL can state for any correct fit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.catalog import oracle as O
from cohortex.catalog.setup import (
    B_END,
    B_START,
    CV_END,
    CV_START,
    FIXTURE,
    FIXTURE_RUN,
    LB_END,
    LB_START,
    SEGMENT_DIVISOR,
)
from cohortex.context import scratch_path
from cohortex.functions import scalar as S
from cohortex.functions.rules import (
    CAMPAIGN_RULES,
    CONVERSION_RULE,
    FIXTURE_CONVERSION,
    FIXTURE_RULES,
    Contains,
    EventRule,
    field_matches,
)
from cohortex.operators import aggregates as A
from cohortex.operators import ml as M
from cohortex.operators.export import audience, rename_output
from cohortex.operators.joins import join_on_client, unnest_hits
from cohortex.operators.registry import registry_append, registry_lookup, registry_verify, runtime_versions
from cohortex.operators.sampling import stratified_split, undersample_majority, union_all_split
from cohortex.operators.sessions import first_session, latest_session
from cohortex.operators.trees import NODES, walk, walked_probability
from cohortex.plans.daily import DailyState, days_between
from cohortex.plans.datasets import labelled_features, scoring_dataset, training_dataset, training_spec
from cohortex.plans.features import CATEGORICAL, NUMERIC, feature_columns
from cohortex.plans.run import discard, layout_of, materialise, run, split_for_training, train
from cohortex.sources.fixtures import sessions_from_events, sessions_from_orders
from cohortex.sources.params import param_query
from cohortex.sources.sessions import client_not_null, load_table, scan_suffix_range, scan_window
from cohortex.sources.sinks import read_back, write_append, write_overwrite

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def all_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session of a known client, without visit numbers and places."""
    return client_not_null(sessions_from_events(spark, sf_dir, profile=False))


def lookback(spark: SparkSession, sf_dir: str, profile: bool = False) -> DataFrame:
    return scan_window(sessions_from_events(spark, sf_dir, LB_START, LB_END, profile), LB_START, LB_END)


def conversion_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_window(sessions_from_events(spark, sf_dir, CV_START, CV_END, profile=False), CV_START, CV_END)


def feature_sessions(spark: SparkSession, sf_dir: str, campaign: bool = False) -> DataFrame:
    """The sessions that the training and scoring windows need."""
    return sessions_from_events(spark, sf_dir, min(LB_START, CV_START), max(LB_END, CV_END), campaign=campaign)


def stored_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions, built and written once: a run reads them several times, each time a few of their columns."""
    return materialise(feature_sessions(spark, sf_dir), "sessions")


def order_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order sessions (fixture B) with a known client: the whole order history."""
    return client_not_null(sessions_from_orders(spark, sf_dir))


B_RULES = (
    EventRule("returned", eventCategory="R"),
    EventRule("accepted", eventCategory="A"),
    EventRule("open_lines", eventAction="O"),
)

# ---------------------------------------------------------------- scans, sources, sinks


@register("scan_suffix_range", O.with_a(
    f"SELECT clientId, visitId, visitNumber, channelGrouping, suffix FROM sessions "
    f"WHERE suffix BETWEEN '{LB_START}' AND '{LB_END}'"))
def q_scan_suffix_range(spark, sf_dir):
    s = scan_suffix_range(sessions_from_events(spark, sf_dir), LB_START, LB_END)
    return s.select("clientId", "visitId", "visitNumber", "channelGrouping", "suffix")


@register("load_table", "SELECT event_id, user_id, event_type, value FROM events")
def q_load_table(spark, sf_dir):
    return load_table(spark, f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value")


@register("sink_overwrite", O.with_a("SELECT * FROM totals", O.totals_cte(None)))
def q_sink_overwrite(spark, sf_dir):
    target = scratch_path(spark, "sink_overwrite")
    write_overwrite(all_sessions(spark, sf_dir).select("clientId", "suffix"), target)  # replaced below
    totals = A.visit_totals(all_sessions(spark, sf_dir)).withColumn("revenue", F.round("revenue", 6))
    write_overwrite(totals, target)
    return read_back(spark, target)


@register("sink_append", O.with_a(
    "SELECT * FROM converted UNION ALL SELECT * FROM converted", O.converted_cte(O.B_ALL)))
def q_sink_append(spark, sf_dir):
    target = scratch_path(spark, "sink_append")
    conv = A.conversion_counts(all_sessions(spark, sf_dir), FIXTURE_CONVERSION)
    for run_id in ("first", "first", "second"):  # the repeated run adds nothing
        write_append(conv, target, run_id)
    return read_back(spark, target).drop("run_id")


@register("param_query", O.with_a(
    "SELECT clientId AS clientid, COUNT(1) AS sessions, CAST(SUM(totals.hits) AS BIGINT) AS hits "
    f"FROM sessions WHERE suffix BETWEEN '{LB_START}' AND '{LB_END}' AND clientId IS NOT NULL GROUP BY clientId"))
def q_param_query(spark, sf_dir):
    view = f"sessions_{uuid.uuid4().hex[:12]}"
    sessions_from_events(spark, sf_dir, LB_START, LB_END, profile=False).createOrReplaceTempView(view)
    params = {"table": view, "start": LB_START, "end": LB_END, "prediction_type": FIXTURE.prediction_type}
    counted = param_query(spark, "client_sessions", params)
    spark.catalog.dropTempView(view)  # the plan is resolved
    return counted


# ---------------------------------------------------------------- projections, filters


@register("project_nested", O.with_a(
    "SELECT clientId, visitId, device.browser AS browser, device.deviceCategory AS deviceCategory, "
    "geoNetwork.city AS city, trafficSource.medium AS medium, totals.hits AS hits "
    "FROM sessions"))
def q_project_nested(spark, sf_dir):
    return sessions_from_events(spark, sf_dir).select(
        "clientId",
        "visitId",
        F.col("device.browser").alias("browser"),
        F.col("device.deviceCategory").alias("deviceCategory"),
        F.col("geoNetwork.city").alias("city"),
        F.col("trafficSource.medium").alias("medium"),
        F.col("totals.hits").alias("hits"),
    )


@register("star_except", O.with_a(
    f"SELECT clientId, visitId, channelGrouping, suffix FROM sessions WHERE {O.B_ALL} "
    "QUALIFY visitId = max(visitId) OVER (PARTITION BY clientId)"))
def q_star_except(spark, sf_dir):
    """``* EXCEPT``: the newest session of each client without its helper column."""
    view = f"sessions_{uuid.uuid4().hex[:12]}"
    all_sessions(spark, sf_dir).select("clientId", "visitId", "channelGrouping", "suffix").createOrReplaceTempView(view)
    newest = spark.sql(
        f"SELECT * EXCEPT (age) FROM (SELECT *, row_number() OVER (PARTITION BY clientId ORDER BY visitId DESC) AS age FROM {view}) "
        "WHERE age = 1"
    )
    spark.catalog.dropTempView(view)  # the plan is resolved
    return newest


@register("filter_not_null", O.with_a(
    "SELECT clientId, visitId, trafficSource.medium AS medium FROM sessions "
    "WHERE trafficSource.medium IS NOT NULL"))
def q_filter_not_null(spark, sf_dir):
    s = sessions_from_events(spark, sf_dir, profile=False).select("clientId", "visitId", F.col("trafficSource.medium").alias("medium"))
    return client_not_null(s, "medium")


@register("between_filter", O.with_b(
    f"SELECT clientId, visitId, suffix FROM sessions WHERE suffix BETWEEN '{B_START}' AND '{B_END}'"))
def q_between_filter(spark, sf_dir):
    s = sessions_from_orders(spark, sf_dir)
    return s.where(F.col("suffix").between(B_START, B_END)).select("clientId", "visitId", "suffix")


@register("in_list", O.with_a(
    "SELECT clientId, visitId, device.browser AS browser, device.operatingSystem AS operatingSystem FROM sessions "
    f"WHERE device.browser NOT IN {O.KEEP_BROWSER} AND device.operatingSystem IN {O.KEEP_OS}"))
def q_in_list(spark, sf_dir):
    s = sessions_from_events(spark, sf_dir, profile=False)
    cond = ~F.col("device.browser").isin(list(S.BROWSER_KEEP)) & F.col("device.operatingSystem").isin(list(S.OS_KEEP))
    return s.where(cond).select(
        "clientId", "visitId", F.col("device.browser").alias("browser"),
        F.col("device.operatingSystem").alias("operatingSystem"))


@register("like_upper", O.with_a(
    "SELECT clientId, visitId, h.eventInfo.eventLabel AS eventLabel FROM sessions g, UNNEST(g.hits) AS u(h) "
    "WHERE UPPER(h.eventInfo.eventLabel) LIKE '%PLAN%'"))
def q_like_upper(spark, sf_dir):
    hits = unnest_hits(sessions_from_events(spark, sf_dir, profile=False), "clientId", "visitId")
    match = Contains("PLAN")

    return hits.where(field_matches(F.col("eventInfo.eventLabel"), match)).select(
        "clientId", "visitId", F.col("eventInfo.eventLabel").alias("eventLabel"))


@register("event_rule_flags", O.with_a(
    "SELECT clientId, visitId, "
    + ", ".join(f"{O.rule_flag(r)} AS {r.name}" for r in FIXTURE_RULES)
    + " FROM sessions g, UNNEST(g.hits) AS u(h)"))
def q_event_rule_flags(spark, sf_dir):
    hits = unnest_hits(sessions_from_events(spark, sf_dir, profile=False), "clientId", "visitId")
    info = F.col("eventInfo")
    return hits.select("clientId", "visitId", *[A.rule_flag(r, info).alias(r.name) for r in FIXTURE_RULES])


@register("having_min_count", O.with_a("SELECT * FROM converted", O.converted_cte(O.B_ALL, min_count=2)))
def q_having_min_count(spark, sf_dir):
    return A.conversion_counts(all_sessions(spark, sf_dir), FIXTURE_CONVERSION, min_count=2)


@register("downsample_majority", O.with_a(
    f"SELECT clientid, y_conversions FROM joined WHERE {O.sampled_where()}", *O.features_ctes(True)))
def q_downsample_majority(spark, sf_dir):
    return training_dataset(feature_sessions(spark, sf_dir), FIXTURE).select("clientid", "y_conversions")


@register("drop_columns", O.with_a(
    "SELECT * EXCLUDE (region, operatingSystem) FROM joined", *O.features_ctes(True)))
def q_drop_columns(spark, sf_dir):
    return labelled_features(feature_sessions(spark, sf_dir), FIXTURE).drop(*FIXTURE.exclude_columns)


@register("rename_output", O.with_a(
    f"SELECT clientid AS {FIXTURE.index_dimension}, last_channel AS {FIXTURE.value_dimension} FROM joined",
    *O.features_ctes(True)))
def q_rename_output(spark, sf_dir):

    f = labelled_features(feature_sessions(spark, sf_dir), FIXTURE)
    return rename_output(f, FIXTURE.index_dimension, FIXTURE.value_dimension, value="last_channel")


@register("select_by_dtype", O.with_a(
    "SELECT clientid, " + ", ".join(NUMERIC) + ", " + ", ".join(r.name for r in FIXTURE_RULES) + " FROM joined",
    *O.features_ctes(True)))
def q_select_by_dtype(spark, sf_dir):

    f = labelled_features(feature_sessions(spark, sf_dir), FIXTURE)
    _, numbers = M.select_by_dtype(f, [M.KEY, M.LABEL])
    return f.select(M.KEY, *numbers)


@register("event_filter", O.with_a("SELECT * FROM converted", O.converted_cte(
    O.B_ALL, EventRule.from_filter("y_conversions", "eventCategory", "purchase"))))
def q_event_filter(spark, sf_dir):

    cfg = replace(FIXTURE, event_filter_type="eventCategory", event_filter_value="purchase")
    return A.conversion_counts(all_sessions(spark, sf_dir), cfg.effective_conversion_rule())


# ---------------------------------------------------------------- joins


@register("unnest_hits", O.with_b(
    "SELECT clientId, visitId, h.eventInfo.eventCategory AS eventCategory, h.eventInfo.eventAction AS eventAction "
    f"FROM sessions g, UNNEST(g.hits) AS u(h) WHERE {O.B_ALL}"))
def q_unnest_hits(spark, sf_dir):
    hits = unnest_hits(order_sessions(spark, sf_dir), "clientId", "visitId")
    return hits.select(
        "clientId", "visitId",
        F.col("eventInfo.eventCategory").alias("eventCategory"),
        F.col("eventInfo.eventAction").alias("eventAction"))


def _b_hits_sql() -> str:
    sums = ", ".join(f"CAST(SUM({O.rule_flag(r)}) AS BIGINT) AS {r.name}" for r in B_RULES)
    return f"sh AS (SELECT clientId, {sums} FROM sessions g, UNNEST(g.hits) AS u(h) WHERE {O.B_ALL} GROUP BY clientId)"


_B_LATEST = (
    "ls AS (SELECT clientId, channelGrouping AS last_channel FROM (SELECT clientId, channelGrouping, "
    "ROW_NUMBER() OVER (PARTITION BY clientId ORDER BY visitId DESC NULLS LAST, visitStartTime DESC NULLS LAST, "
    f"suffix DESC NULLS LAST) AS rn FROM sessions WHERE {O.B_ALL}) WHERE rn = 1)"
)
_B_TOTALS = (
    "t AS (SELECT clientId, COUNT(1) AS sessions, CAST(SUM(totals_hits) AS BIGINT) AS line_count FROM "
    f"(SELECT clientId, len(hits) AS totals_hits FROM sessions WHERE {O.B_ALL}) GROUP BY clientId)"
)


@register("join_inner", O.with_b(
    "SELECT sh.clientId, " + ", ".join(f"sh.{r.name}" for r in B_RULES) + ", ls.last_channel "
    "FROM sh JOIN ls ON sh.clientId = ls.clientId", _b_hits_sql(), _B_LATEST))
def q_join_inner(spark, sf_dir):
    s = order_sessions(spark, sf_dir)
    hits = A.event_counts(s, B_RULES)
    latest = latest_session(s).select("clientId", F.col("channelGrouping").alias("last_channel"))
    return join_on_client(hits, latest, "inner")


@register("join_left", O.with_b(
    "SELECT t.clientId, t.sessions, t.line_count, " + ", ".join(f"sh.{r.name}" for r in B_RULES) + " "
    "FROM t LEFT OUTER JOIN sh ON t.clientId = sh.clientId", _b_hits_sql(), _B_TOTALS))
def q_join_left(spark, sf_dir):
    s = order_sessions(spark, sf_dir)
    totals = s.groupBy("clientId").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum(F.col("totals.hits")).alias("line_count"))
    return join_on_client(totals, A.event_counts(s, B_RULES), "left")


# ---------------------------------------------------------------- aggregations


@register("group_sum", O.with_a(
    "SELECT clientId, COUNT(1) AS sessions, CAST(SUM(totals.hits) AS BIGINT) AS hits, "
    f"CAST(SUM(totals.pageviews) AS BIGINT) AS pageviews FROM sessions WHERE {O.B_ALL} GROUP BY clientId"))
def q_group_sum(spark, sf_dir):
    return all_sessions(spark, sf_dir).groupBy("clientId").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("totals.hits").alias("hits"),
        F.sum("totals.pageviews").alias("pageviews"))


@register("count_distinct_multi", O.with_a(
    "SELECT clientId, num_channels, num_sources, num_days, num_devices FROM totals", O.totals_cte(None)))
def q_count_distinct_multi(spark, sf_dir):
    return A.distinct_counts(all_sessions(spark, sf_dir))


@register("sum_totals", O.with_a(
    "SELECT clientId, visits, pageviews, hits, timeonsite, bounces, transactions FROM totals", O.totals_cte(None)))
def q_sum_totals(spark, sf_dir):
    return all_sessions(spark, sf_dir).groupBy("clientId").agg(
        *[F.sum(f"totals.{f}").alias(f) for f in (*A.TOTAL_FIELDS, "transactions")])


@register("hour_buckets", O.with_a(
    "SELECT clientId, morning_visits, daytime_visits, evening_visits, midnight_visits FROM totals", O.totals_cte(None)))
def q_hour_buckets(spark, sf_dir):
    hour = S.local_hour(F.col("visitStartTime"), FIXTURE.time_zone)
    return all_sessions(spark, sf_dir).groupBy("clientId").agg(
        *[F.sum(S.in_hours(hour, hrs)).alias(f"{n}_visits") for n, hrs in S.HOUR_BUCKETS.items()])


@register("event_counts", O.with_a("SELECT * FROM hit_counts", O.session_hits_cte(O.B_ALL)))
def q_event_counts(spark, sf_dir):
    return A.event_counts(all_sessions(spark, sf_dir), FIXTURE_RULES)


@register("conversion_counts", O.with_a("SELECT * FROM converted", O.converted_cte()))
def q_conversion_counts(spark, sf_dir):
    return A.conversion_counts(conversion_window(spark, sf_dir), FIXTURE_CONVERSION)


@register("class_distribution", O.with_a(
    "SELECT y_conversions, COUNT(1) AS n FROM joined GROUP BY y_conversions", *O.features_ctes(True)))
def q_class_distribution(spark, sf_dir):
    return A.class_distribution(labelled_features(feature_sessions(spark, sf_dir), FIXTURE))


@register("dataset_shape", O.with_a(
    f"SELECT COUNT(1) AS n_rows, {len(feature_columns(FIXTURE_RULES, True))} AS n_columns FROM joined "
    f"WHERE {O.sampled_where()}", *O.features_ctes(True)))
def q_dataset_shape(spark, sf_dir):
    return A.dataset_shape(training_dataset(feature_sessions(spark, sf_dir), FIXTURE))


@register("regroup_features", O.FEATURES_SQL)
def q_regroup_features(spark, sf_dir):
    f = labelled_features(feature_sessions(spark, sf_dir), FIXTURE, form="literal")
    keys = ["clientid", *CATEGORICAL, "current_visit", "y_conversions"]
    return A.regroup(f, keys, [c for c in f.columns if c not in keys]).select(*f.columns)


@register("visit_totals", O.with_a("SELECT * FROM totals", O.totals_cte()))
def q_visit_totals(spark, sf_dir):
    return A.visit_totals(lookback(spark, sf_dir), FIXTURE.time_zone).withColumn("revenue", F.round("revenue", 6))


# ---------------------------------------------------------------- windows, top-k, set ops


@register("latest_session", O.with_a("SELECT * FROM newest", O.latest_cte(O.B_ALL)))
def q_latest_session(spark, sf_dir):
    return latest_session(client_not_null(sessions_from_events(spark, sf_dir)))


@register("first_session", O.with_a("SELECT * FROM oldest", O.first_cte(O.B_ALL)))
def q_first_session(spark, sf_dir):
    return first_session(all_sessions(spark, sf_dir))


@register("topk_latest", O.with_a(
    "SELECT clientId, visitId, visitStartTime FROM sessions WHERE device.deviceCategory = 'mobile' "
    "ORDER BY visitStartTime DESC, visitId DESC, clientId DESC LIMIT 1"))
def q_topk_latest(spark, sf_dir):
    s = sessions_from_events(spark, sf_dir, profile=False).where(F.col("device.deviceCategory") == "mobile")
    return s.orderBy(F.desc("visitStartTime"), F.desc("visitId"), F.desc("clientId")).limit(1).select(
        "clientId", "visitId", "visitStartTime")


@register("union_all_split", O.with_a(
    f"SELECT clientid, y_conversions FROM joined WHERE y_conversions = 0 AND "
    f"{O.uniform('clientid', FIXTURE.seed)} <= {FIXTURE.downsample_majority_class} "
    "UNION ALL SELECT clientid, y_conversions FROM joined WHERE y_conversions = 1", *O.features_ctes(True)))
def q_union_all_split(spark, sf_dir):

    f = labelled_features(feature_sessions(spark, sf_dir), FIXTURE).select("clientid", "y_conversions")
    return union_all_split(f, FIXTURE.downsample_majority_class, FIXTURE.seed)


# ---------------------------------------------------------------- scalar functions


@register("bucket_rare", O.with_a(
    "SELECT clientId, visitId, device.browser AS raw_browser, "
    f"IF(device.browser NOT IN {O.KEEP_BROWSER}, 'Others', device.browser) AS browser, "
    "device.operatingSystem AS raw_os, "
    f"IF(device.operatingSystem NOT IN {O.KEEP_OS}, 'Others', device.operatingSystem) AS operatingSystem "
    "FROM sessions"))
def q_bucket_rare(spark, sf_dir):
    return sessions_from_events(spark, sf_dir, profile=False).select(
        "clientId", "visitId",
        F.col("device.browser").alias("raw_browser"),
        S.bucket_rare(F.col("device.browser"), S.BROWSER_KEEP).alias("browser"),
        F.col("device.operatingSystem").alias("raw_os"),
        S.bucket_rare(F.col("device.operatingSystem"), S.OS_KEEP).alias("operatingSystem"))


@register("bool_flag", O.with_a(
    "SELECT clientId, visitId, CASE WHEN device.isMobile = TRUE THEN 1 ELSE 0 END AS isMobile "
    "FROM sessions"))
def q_bool_flag(spark, sf_dir):
    return sessions_from_events(spark, sf_dir, profile=False).select("clientId", "visitId", S.bool_flag(F.col("device.isMobile")).alias("isMobile"))


@register("ifnull_zero", O.with_a(
    "SELECT clientId, CAST(SUM(totals.bounces) AS BIGINT) AS bounces_raw, "
    f"CAST(IFNULL(SUM(totals.bounces), 0) AS BIGINT) AS bounces FROM sessions WHERE {O.B_ALL} GROUP BY clientId"))
def q_ifnull_zero(spark, sf_dir):
    g = all_sessions(spark, sf_dir).groupBy("clientId").agg(F.sum("totals.bounces").alias("bounces_raw"))
    return g.withColumn("bounces", S.ifnull_zero(F.col("bounces_raw")))


@register("label_binary", O.with_a(
    "SELECT clientId, CAST(converted.y_conversions IS NOT NULL AS INTEGER) AS y_conversions "
    "FROM hit_counts LEFT JOIN converted USING (clientId)",
    O.session_hits_cte(), O.converted_cte()))
def q_label_binary(spark, sf_dir):
    sh = A.event_counts(lookback(spark, sf_dir), FIXTURE_RULES).select("clientId")
    conv = A.conversion_counts(conversion_window(spark, sf_dir), FIXTURE_CONVERSION)
    return join_on_client(sh, conv, "left").select("clientId", S.label_binary(F.col("y_conversions")).alias("y_conversions"))


@register("concat_source_medium", O.with_a(
    "SELECT clientId, visitId, trafficSource.source || ' / ' || trafficSource.medium AS source_medium "
    "FROM sessions"))
def q_concat_source_medium(spark, sf_dir):
    return sessions_from_events(spark, sf_dir, profile=False).select(
        "clientId", "visitId", S.concat_pair(F.col("trafficSource.source"), F.col("trafficSource.medium")).alias("source_medium"))


@register("upper_case", O.with_a(
    "SELECT clientId, visitId, UPPER(h.eventInfo.eventLabel) AS label_upper "
    "FROM sessions g, UNNEST(g.hits) AS u(h)"))
def q_upper_case(spark, sf_dir):
    hits = unnest_hits(sessions_from_events(spark, sf_dir, profile=False), "clientId", "visitId")
    return hits.select("clientId", "visitId", F.upper(F.col("eventInfo.eventLabel")).alias("label_upper"))


@register("epoch_to_ts", O.with_a(
    "SELECT clientId, visitId, strftime(make_timestamp(visitStartTime * 1000000), '%Y-%m-%d %H:%M:%S') AS start_utc, "
    "visitStartTime AS round_trip FROM sessions"))
def q_epoch_to_ts(spark, sf_dir):
    s = sessions_from_events(spark, sf_dir, profile=False)
    return s.select(
        "clientId", "visitId",
        F.date_format(S.epoch_to_ntz(F.col("visitStartTime")), "yyyy-MM-dd HH:mm:ss").alias("start_utc"),
        F.unix_seconds(S.epoch_to_ts(F.col("visitStartTime"))).alias("round_trip"))


@register("local_hour", O.with_a(
    f"SELECT clientId, visitId, CAST({O.HOUR} AS INTEGER) AS local_hour FROM sessions"))
def q_local_hour(spark, sf_dir):
    return sessions_from_events(spark, sf_dir, profile=False).select(
        "clientId", "visitId", S.local_hour(F.col("visitStartTime"), FIXTURE.time_zone).alias("local_hour"))


@register("revenue_scaled", O.with_a("SELECT clientId, revenue FROM totals", O.totals_cte(None)))
def q_revenue_scaled(spark, sf_dir):
    g = all_sessions(spark, sf_dir).groupBy("clientId").agg(
        S.revenue_scaled(F.sum("totals.totalTransactionRevenue"), FIXTURE.revenue_divisor).alias("revenue"))
    return g.withColumn("revenue", F.round("revenue", 6))


@register("hash_uniform", O.with_a(
    f"SELECT DISTINCT clientId, {O.u32('clientId', FIXTURE.seed)} AS h32, "
    f"ROUND({O.uniform('clientId', FIXTURE.seed)}, 12) AS u FROM sessions"))
def q_hash_uniform(spark, sf_dir):
    c = sessions_from_events(spark, sf_dir, profile=False).select("clientId").distinct()
    return c.select(
        "clientId",
        S.hash_u32(F.col("clientId"), FIXTURE.seed).alias("h32"),
        F.round(S.hash_uniform(F.col("clientId"), FIXTURE.seed), 12).alias("u"))


@register("date_minus_days", O.with_a(
    "SELECT DISTINCT suffix, strftime(strptime(suffix, '%Y%m%d') - INTERVAL 30 DAY, '%Y%m%d') AS minus_30 FROM sessions"))
def q_date_minus_days(spark, sf_dir):
    s = sessions_from_events(spark, sf_dir, profile=False).select("suffix").distinct()
    return s.select("suffix", S.date_to_text(S.date_minus_days(S.text_to_date(F.col("suffix")), 30)).alias("minus_30"))


@register("date_to_text", "SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events")
def q_date_to_text(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select("event_id", S.date_to_text(F.to_date("ts")).alias("day"))


@register("md5_digest", O.with_a("SELECT DISTINCT clientId, md5(clientId) AS md5 FROM sessions"))
def q_md5_digest(spark, sf_dir):
    c = sessions_from_events(spark, sf_dir, profile=False).select("clientId").distinct()
    return c.select("clientId", S.md5_digest(F.col("clientId")).alias("md5"))


@register("segment_label", (
    f"SELECT event_id, CASE WHEN {O.SEGMENT} > {FIXTURE.high_class_value} THEN 'high' "
    f"WHEN {O.SEGMENT} > {FIXTURE.medium_class_value} THEN 'medium' ELSE 'low' END AS segment FROM events"))
def q_segment_label(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    p = F.col("value") / F.lit(SEGMENT_DIVISOR)
    return ev.select("event_id", S.segment_label(p, FIXTURE.medium_class_value, FIXTURE.high_class_value).alias("segment"))


@register("window_bounds", O.with_a(
    f"SELECT suffix, suffix BETWEEN '{LB_START}' AND '{LB_END}' AS in_lookback, "
    f"suffix BETWEEN '{CV_START}' AND '{CV_END}' AS in_conversion, "
    f"suffix BETWEEN '{FIXTURE.windows().scoring_start}' AND '{FIXTURE.windows().scoring_end}' AS in_scoring "
    "FROM (SELECT DISTINCT suffix FROM sessions)"))
def q_window_bounds(spark, sf_dir):
    w = FIXTURE.windows()
    s = sessions_from_events(spark, sf_dir, profile=False).select("suffix").distinct()
    return s.select(
        "suffix",
        F.col("suffix").between(w.lookback_start, w.lookback_end).alias("in_lookback"),
        F.col("suffix").between(w.conversion_start, w.conversion_end).alias("in_conversion"),
        F.col("suffix").between(w.scoring_start, w.scoring_end).alias("in_scoring"))


# ---------------------------------------------------------------- composite datasets


@register("training_dataset", O.training_sql())
def q_training_dataset(spark, sf_dir):
    return training_dataset(feature_sessions(spark, sf_dir), FIXTURE, form="fused")


@register("training_dataset_literal", O.training_sql())
def q_training_dataset_literal(spark, sf_dir):
    return training_dataset(feature_sessions(spark, sf_dir), FIXTURE, form="literal")


@register("scoring_dataset", O.SCORING_SQL)
def q_scoring_dataset(spark, sf_dir):
    return scoring_dataset(feature_sessions(spark, sf_dir), FIXTURE)


# ---------------------------------------------------------------- learning


_FEATURES = O.features_ctes(True)
# the rows a learning run starts from: all positives and the sampled negatives
_SAMPLED = [*_FEATURES, f"sampled AS (SELECT * FROM joined WHERE {O.sampled_where(FIXTURE_RUN.downsample_majority_class)})"]
_PARTS = [*_SAMPLED, *O.balanced_ctes("sampled"), *O.split_ctes(FIXTURE_RUN.test_size, FIXTURE_RUN.split_seed)]


def _features(spark, sf_dir):
    """The labelled feature table, written once: the steps after it read it several times."""
    return materialise(labelled_features(feature_sessions(spark, sf_dir), FIXTURE_RUN), "features")


def _layout(df):
    return M.FeatureLayout.of(df, exclude=FIXTURE_RUN.exclude_columns)


_TEXT = [c for c in CATEGORICAL if c not in FIXTURE_RUN.exclude_columns]
_NUMS = [*NUMERIC, *[r.name for r in FIXTURE_RULES]]


@register("undersample_majority", O.with_a(
    "SELECT clientid, y_conversions FROM balanced", *_FEATURES, *O.balanced_ctes()))
def q_undersample_majority(spark, sf_dir):
    return undersample_majority(_features(spark, sf_dir), FIXTURE_RUN.seed).select("clientid", "y_conversions")


@register("stratified_split", O.with_a(
    "SELECT clientid, y_conversions, is_test FROM split", *_FEATURES, *O.balanced_ctes(),
    *O.split_ctes(FIXTURE_RUN.test_size, FIXTURE_RUN.split_seed)))
def q_stratified_split(spark, sf_dir):
    balanced = undersample_majority(_features(spark, sf_dir), FIXTURE_RUN.seed)
    parts = stratified_split(balanced, FIXTURE_RUN.test_size, FIXTURE_RUN.split_seed)
    return parts.select("clientid", "y_conversions", "is_test")


@register("category_codes", O.with_a(
    "SELECT j.clientid, " + ", ".join(f"CAST(codes_{c}.code AS DOUBLE) AS {c}_idx" for c in _TEXT) + " FROM joined j "
    + " ".join(f"JOIN codes_{c} ON COALESCE(j.{c}, '__null__') = codes_{c}.v" for c in _TEXT),
    *_FEATURES, *[O.codes_cte(c) for c in _TEXT]))
def q_category_codes(spark, sf_dir):
    f = _features(spark, sf_dir)
    layout = _layout(f)
    prepared = layout.prepare(f)
    model = Pipeline(stages=M.category_indexers(layout.text)).fit(prepared)
    return model.transform(prepared).select("clientid", *[f"{c}_idx" for c in layout.text])


@register("one_hot", O.with_a(
    "SELECT j.clientid, " + ", ".join(f"CAST(codes_{c}.code AS BIGINT) AS {c}_hot" for c in _TEXT) + " FROM joined j "
    + " ".join(f"JOIN codes_{c} ON COALESCE(j.{c}, '__null__') = codes_{c}.v" for c in _TEXT),
    *_FEATURES, *[O.codes_cte(c) for c in _TEXT]))
def q_one_hot(spark, sf_dir):
    """Position of the 1.0 in each one-hot vector (-1 for the zero vector of unseen values)."""
    f = _features(spark, sf_dir)
    layout = _layout(f)
    prepared = layout.prepare(f)
    model = Pipeline(stages=[*M.category_indexers(layout.text), M.one_hot_encoder(layout.text)]).fit(prepared)
    out = model.transform(prepared)
    return out.select(
        "clientid",
        *[(F.array_position(vector_to_array(f"{c}_vec"), 1.0) - 1).cast("bigint").alias(f"{c}_hot") for c in layout.text])


def _z(c: str) -> str:
    return f"(CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END)"


def _fitted_vectors(spark, sf_dir):
    """The stages the classifier is trained behind, fitted and applied to the feature table."""
    f = _features(spark, sf_dir)
    layout = _layout(f)
    prepared = layout.prepare(f)
    return layout, Pipeline(stages=M.feature_stages(layout, f.count())).fit(prepared).transform(prepared)


@register("standardize", O.with_a(
    "SELECT clientid, " + ", ".join(f"ROUND({_z(c)}, 6) AS {c}" for c in _NUMS) + " FROM joined", *_FEATURES))
def q_standardize(spark, sf_dir):
    layout, out = _fitted_vectors(spark, sf_dir)
    z = vector_to_array("_num_scaled")
    return out.select("clientid", *[F.round(z.getItem(i), 6).alias(c) for i, c in enumerate(layout.numbers)])


@register("assemble_features", O.with_a(
    "SELECT clientid, CAST((" + " + ".join(f"(SELECT COUNT(DISTINCT COALESCE({c}, '__null__')) FROM joined)" for c in _TEXT)
    + f") + {len(_NUMS)} AS INTEGER) AS vec_size, CAST({len(_TEXT)} AS DOUBLE) AS hot, "
    "ROUND(" + " + ".join(_z(c) for c in _NUMS) + ", 4) AS scaled_sum FROM joined", *_FEATURES))
def q_assemble_features(spark, sf_dir):
    """The vector the trees are fitted on: its length, the sum of its one-hot and of its scaled slots."""
    layout, out = _fitted_vectors(spark, sf_dir)
    arr = vector_to_array("features")
    slots = F.size(arr) - len(layout.numbers)

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    return out.select(
        "clientid",
        F.size(arr).alias("vec_size"),
        total(F.slice(arr, F.lit(1), slots)).alias("hot"),
        F.round(total(F.slice(arr, slots + 1, F.lit(len(layout.numbers)))), 4).alias("scaled_sum"))


def _rule_prediction(df):
    return df.withColumn("prediction", F.when(F.col("Event03") > 0, 1).otherwise(0))


@register("accuracy_score", O.with_a(
    "SELECT is_test, ROUND(AVG(CASE WHEN (CASE WHEN Event03 > 0 THEN 1 ELSE 0 END) = y_conversions THEN 1 ELSE 0 END), 6) "
    "AS accuracy, COUNT(1) AS n FROM split GROUP BY is_test",
    *_FEATURES, *O.balanced_ctes(), *O.split_ctes(FIXTURE_RUN.test_size, FIXTURE_RUN.split_seed)))
def q_accuracy_score(spark, sf_dir):
    balanced = undersample_majority(_features(spark, sf_dir), FIXTURE_RUN.seed)
    parts = stratified_split(balanced, FIXTURE_RUN.test_size, FIXTURE_RUN.split_seed)
    acc = M.accuracy(_rule_prediction(parts), by=["is_test"])
    return acc.withColumn("accuracy", F.round("accuracy", 6))


def _trained(spark, sf_dir, cfg=None, sessions=None):
    return train(spark, cfg or FIXTURE_RUN, feature_sessions(spark, sf_dir) if sessions is None else sessions)


# Fitted models have no SQL; the queries below return facts about every row of their real
# results that must hold for any correct fit, with the rows themselves checked by SQL.
def _in_unit():
    return F.col("prob").between(0.0, 1.0)


@register("train_classifier", O.with_a(
    "SELECT clientid, y_conversions, TRUE AS prob_in_unit, TRUE AS prediction_agrees FROM split WHERE NOT is_test", *_PARTS))
def q_train_classifier(spark, sf_dir):
    training = materialise(training_dataset(feature_sessions(spark, sf_dir), FIXTURE_RUN), "training")
    layout = _layout(training)
    parts = materialise(split_for_training(training, FIXTURE_RUN), "training_parts")
    train_part = parts.where(~F.col("is_test"))
    model = M.fit(train_part, layout, max_iter=FIXTURE_RUN.max_iter, max_depth=FIXTURE_RUN.max_depth,
                  step_size=FIXTURE_RUN.step_size, seed=FIXTURE_RUN.seed)
    walked = walked_probability(spark, model, train_part, layout, "clientid").withColumnRenamed("prob", "walked")
    agrees = (F.col("prediction") == 1.0) == (F.col("walked") > 0.5)
    return M.predict_proba(model, train_part, layout).join(walked, "clientid").select(
        "clientid", "y_conversions", _in_unit().alias("prob_in_unit"), agrees.alias("prediction_agrees"))


_SCORED = O.features_ctes(False, lb=O._win(CV_START, CV_END))


def _equal(a: str, b: str):
    """Equal to 1e-9; a missing value equals nothing."""
    return F.coalesce(F.abs(F.col(a) - F.col(b)) <= 1e-9, F.lit(False))


@register("predict_proba", O.with_a("SELECT clientid, TRUE AS prob_in_unit, TRUE AS equals_walked_trees FROM joined", *_SCORED))
def q_predict_proba(spark, sf_dir):
    """Every client's probability against the exported trees, walked by joins."""
    sessions = stored_sessions(spark, sf_dir)
    t = _trained(spark, sf_dir, sessions=sessions)
    scoring = materialise(scoring_dataset(sessions, FIXTURE_RUN), "scoring")
    discard(spark, sessions)
    walked = walked_probability(spark, t.model, scoring, t.layout, "clientid").withColumnRenamed("prob", "walked")
    prob = M.predict_proba(t.model, scoring, t.layout).select("clientid", "prob")
    return prob.join(walked, "clientid", "full").select(
        "clientid", _in_unit().alias("prob_in_unit"), _equal("prob", "walked").alias("equals_walked_trees"))


def _segment_of(prob: str):
    c = FIXTURE_RUN
    return F.when(F.col(prob) > c.high_class_value, "high").when(F.col(prob) > c.medium_class_value, "medium").otherwise("low")


@register("audience_export", O.with_a("SELECT clientid, TRUE AS segment_agrees FROM joined", *_SCORED))
def q_audience_export(spark, sf_dir):
    """Every client's exported segment against the segment rule applied to the walked trees."""
    sessions = stored_sessions(spark, sf_dir)
    t = _trained(spark, sf_dir, sessions=sessions)
    scoring = materialise(scoring_dataset(sessions, FIXTURE_RUN), "scoring")
    discard(spark, sessions)
    c = FIXTURE_RUN
    out = audience(t.model, scoring, t.layout, c.medium_class_value, c.high_class_value, c.index_dimension, c.value_dimension)
    walked = walked_probability(spark, t.model, scoring, t.layout, "clientid")
    return walked.join(out, F.col("clientid") == F.col(c.index_dimension), "full").select(
        "clientid", F.col(c.value_dimension).eqNullSafe(_segment_of("prob")).alias("segment_agrees"))


# a stored model over raw features, two trees of depth 2: (tree, node, feature or None, threshold, left, right, value, weight)
STORED_TREES = (
    (0, 0, "total_hits", 12.5, 1, 2, 0.0, 1.0),
    (0, 1, "Event04", 0.5, 3, 4, 0.0, 1.0),
    (0, 2, "total_pageviews", 6.5, 5, 6, 0.0, 1.0),
    (0, 3, None, None, None, None, -0.75, 1.0),
    (0, 4, None, None, None, None, 0.125, 1.0),
    (0, 5, None, None, None, None, 0.375, 1.0),
    (0, 6, None, None, None, None, 0.875, 1.0),
    (1, 0, "num_sources", 5.5, 1, 2, 0.0, 0.5),
    (1, 1, None, None, None, None, -0.625, 0.5),
    (1, 2, "total_evening_visits", 2.5, 3, 4, 0.0, 0.5),
    (1, 3, None, None, None, None, 0.25, 0.5),
    (1, 4, None, None, None, None, 1.0, 0.5),
)
_STORED_MARGIN = (
    "CASE WHEN total_hits <= 12.5 THEN CASE WHEN Event04 <= 0.5 THEN -0.75 ELSE 0.125 END "
    "ELSE CASE WHEN total_pageviews <= 6.5 THEN 0.375 ELSE 0.875 END END::DOUBLE + 0.5::DOUBLE * "
    "CASE WHEN num_sources <= 5.5 THEN -0.625 ELSE CASE WHEN total_evening_visits <= 2.5 THEN 0.25 ELSE 1.0 END END"
)


@register("walk_trees", O.with_a(
    f"SELECT clientid, round(p, 9) AS prob, CASE WHEN p > {FIXTURE_RUN.high_class_value} THEN 'high' "
    f"WHEN p > {FIXTURE_RUN.medium_class_value} THEN 'medium' ELSE 'low' END AS segment "
    f"FROM (SELECT clientid, 1 / (1 + exp(-2 * ({_STORED_MARGIN}))) AS p FROM joined)", *_SCORED))
def q_walk_trees(spark, sf_dir):
    """A stored node table over the scoring features: real probabilities and segments."""
    names = [*NUMERIC, *[r.name for r in FIXTURE_RULES]]
    slots = [(t, n, None if f is None else names.index(f), at, None, *rest) for t, n, f, at, *rest in STORED_TREES]
    nodes = spark.createDataFrame(slots, NODES)
    rows = scoring_dataset(feature_sessions(spark, sf_dir), FIXTURE_RUN)
    rows = rows.select("clientid", F.array(*[F.col(c).cast("double") for c in names]).alias("features"))
    return walk(rows, nodes, "clientid", "features", depth=2).select(
        "clientid", F.round("prob", 9).alias("prob"), _segment_of("prob").alias("segment"))


def _registry_cfg(spark):
    return replace(FIXTURE_RUN, trained_model_table=scratch_path(spark, "registry"))


@register("registry_append", (
    f"SELECT '{FIXTURE_RUN.name}' AS name, CAST(1 AS BIGINT) AS n, TRUE AS has_versions, TRUE AS verified, TRUE AS scores_in_unit"))
def q_registry_append(spark, sf_dir):
    cfg = _registry_cfg(spark)
    _trained(spark, sf_dir, cfg)
    rows = read_back(spark, cfg.trained_model_table)
    verified = registry_verify(spark, rows.first())
    scores = [F.col(c).isNull() | F.col(c).between(0.0, 1.0) for c in ("score_train", "score_test")]
    return rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"),
        F.every(F.col("spark_version").isNotNull() & F.col("python_version").isNotNull()).alias("has_versions"),
        F.lit(verified).alias("verified"),
        F.every(scores[0] & scores[1]).alias("scores_in_unit"))


@register("registry_lookup", (
    f"SELECT '{FIXTURE_RUN.name}' AS name, TRUE AS newest, TRUE AS own_version, CAST(4 AS BIGINT) AS rows_in_registry"))
def q_registry_lookup(spark, sf_dir):
    """Two rows of one name, then a newer one of another name and a newer one of another version."""
    cfg = _registry_cfg(spark)
    t = _trained(spark, sf_dir, cfg)
    newer = registry_append(spark, cfg.trained_model_table, t.model, cfg.name, t.score_train, t.score_test)
    registry_append(spark, cfg.trained_model_table, t.model, "another_audience", t.score_train, t.score_test)
    reg = read_back(spark, cfg.trained_model_table)
    other = reg.where(F.col("model_path") == newer["model_path"]).withColumn("spark_version", F.lit("0.0"))
    write_append(materialise(other.withColumn("timestamp", F.expr("timestamp + INTERVAL 1 DAY")), "decoy"), cfg.trained_model_table)
    found = registry_lookup(spark, cfg.trained_model_table, cfg.name)
    reg = read_back(spark, cfg.trained_model_table)
    return reg.agg(F.count(F.lit(1)).alias("rows_in_registry")).select(
        F.lit(found["name"]).alias("name"),
        F.lit(found["model_path"] == newer["model_path"]).alias("newest"),
        F.lit(found["spark_version"] == runtime_versions()["spark_version"]).alias("own_version"),
        "rows_in_registry")


@register("registry_verify", "SELECT * FROM (VALUES ('damaged', FALSE), ('intact', TRUE)) AS t(copy, verified)")
def q_registry_verify(spark, sf_dir):
    cfg = _registry_cfg(spark)
    t = _trained(spark, sf_dir, cfg)
    row = t.registry_row.asDict()
    intact = registry_verify(spark, row)
    # one more file in the model's folder is damage
    read_back(spark, cfg.trained_model_table).select("name").write.text(f"{row['model_path']}/stray")
    damaged = registry_verify(spark, row)
    reg = read_back(spark, cfg.trained_model_table)
    results = F.array(*[F.struct(F.lit(n).alias("copy"), F.lit(v).alias("verified")) for n, v in (("intact", intact), ("damaged", damaged))])
    return reg.select(F.explode(results).alias("r")).select("r.copy", "r.verified")


@register("load_or_train", O.with_a(
    "SELECT clientid, TRUE AS same_segment, CAST(1 AS BIGINT) AS models FROM joined", *_SCORED))
def q_load_or_train(spark, sf_dir):
    """The first run finds no model and trains one, the second loads it: one model, equal segments."""
    cfg = replace(_registry_cfg(spark), load_trained_model=True)
    sessions = stored_sessions(spark, sf_dir)
    first = materialise(run(spark, cfg, sessions), "first_audience")
    second = run(spark, cfg, sessions)
    key, value = cfg.index_dimension, cfg.value_dimension
    models = read_back(spark, cfg.trained_model_table).count()
    both = first.select(F.col(key).alias("clientid"), F.col(value).alias("a")).join(
        second.select(F.col(key).alias("clientid"), F.col(value).alias("b")), "clientid", "full")
    return both.select("clientid", F.col("a").eqNullSafe(F.col("b")).alias("same_segment"), F.lit(models).cast("bigint").alias("models"))


def audience_run(spark, sf_dir):
    """The whole run: train, score, write; returns the written audience."""
    cfg = replace(FIXTURE_RUN, destination_table=scratch_path(spark, "audience"))
    return run(spark, cfg, feature_sessions(spark, sf_dir))


@register("run_pipeline", O.with_a(f"SELECT clientid AS {FIXTURE_RUN.index_dimension}, TRUE AS segment_agrees FROM joined", *_SCORED))
def q_run_pipeline(spark, sf_dir):
    """The written audience against the trees the run has registered, read from the stored model and walked by joins."""
    cfg = replace(_registry_cfg(spark), destination_table=scratch_path(spark, "audience"))
    sessions = stored_sessions(spark, sf_dir)
    out = run(spark, cfg, sessions)
    row = registry_lookup(spark, cfg.trained_model_table, cfg.name)
    model = PipelineModel.load(row["model_path"])
    scoring = materialise(scoring_dataset(sessions, cfg), "scoring")
    discard(spark, sessions)  # the written features no longer read them
    walked = walked_probability(spark, model, scoring, layout_of(model), "clientid", row["model_path"])
    both = out.join(walked, F.col("clientid") == F.col(cfg.index_dimension), "full")
    return both.select(F.col("clientid").alias(cfg.index_dimension), F.col(cfg.value_dimension).eqNullSafe(_segment_of("prob")).alias("segment_agrees"))


@register("daily_features", O.FEATURES_SQL)
def q_daily_features(spark, sf_dir):
    """The training features from daily states: all days but the last first, then the last one alone."""
    spec = training_spec(FIXTURE)
    state = DailyState(scratch_path(spark, "daily_state"), spec.rules, spec.conversion_rule, spec.tz)
    sessions = feature_sessions(spark, sf_dir)
    days = days_between(LB_START, CV_END)
    state.bring_up_to_date(sessions, days[0], days[-2])
    state.bring_up_to_date(sessions, days[0], days[-1])
    return state.features(spark, spec)


# ---------------------------------------------------------------- the campaign's own rule set


_CAMPAIGN = replace(FIXTURE, rules=CAMPAIGN_RULES, conversion_rule=CONVERSION_RULE)


@register("campaign_features", O.with_a(
    "SELECT * FROM joined", *O.features_ctes(True, rules=CAMPAIGN_RULES, conversion=CONVERSION_RULE), campaign=True))
def q_campaign_features(spark, sf_dir):
    """The 25 campaign rules and the campaign conversion rule over sessions with campaign hits."""
    return labelled_features(feature_sessions(spark, sf_dir, campaign=True), _CAMPAIGN)
