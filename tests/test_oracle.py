"""Every registered query against its DuckDB oracle on sf0.001 (the driver uses sf0.01)."""

from __future__ import annotations

import os
from dataclasses import replace

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
# the queries of the library itself; the training-data queries have their tests in tests/llm
OWN = __import__("cohortex.catalog.queries", fromlist=["ORACLE"])
KEYS = sorted(OWN.ORACLE)
LEARNING = {
    "train_classifier", "predict_proba", "audience_export", "registry_append", "registry_lookup", "registry_verify", "load_or_train", "run_pipeline",
}


@pytest.fixture(scope="module", autouse=True)
def short_fits():
    """Tests fit fewer trees than the registered queries."""
    whole = OWN.FIXTURE_RUN
    OWN.FIXTURE_RUN = replace(whole, max_iter=5)
    yield
    OWN.FIXTURE_RUN = whole


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_registered():
    q = entry.queries()
    assert set(entry.oracle_sql()) <= set(q)
    assert len(OWN.QUERIES) == len(OWN.ORACLE) == 71
    assert set(OWN.QUERIES) <= set(q)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["dimension14", "dimension28"]
    assert df.count() >= 0


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("key", sorted(set(KEYS) - LEARNING))
def test_query_stays_in_the_jvm(spark, key):
    """No row-at-a-time or pandas Python stage in any SQL-checked query plan."""
    df = entry.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES), key


CAMPAIGN_COLUMNS = [f"Event{i:02d}" for i in range(1, 26)] + ["y_conversions"]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_campaign_rule_has_matches_and_misses(sf):
    """No column of the campaign check is empty, so a wrong rule cannot stay green."""
    c = duckdb.connect()
    for t in TABLES:
        p = f"/root/testdata/{sf}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sums = ", ".join(f"sum({k}), count(*) FILTER ({k} = 0)" for k in CAMPAIGN_COLUMNS)
    row = c.sql(f"SELECT {sums} FROM ({OWN.ORACLE['campaign_features']})").fetchall()[0]
    assert all(n > 0 for n in row[0::2]), [k for k, n in zip(CAMPAIGN_COLUMNS, row[0::2]) if not n]
    if sf != "sf0.001":  # 15 clients hold nearly every hit; Event14 tests one label only, which every client has
        assert [k for k, n in zip(CAMPAIGN_COLUMNS, row[1::2]) if not n] == ["Event14"]


def test_event_scan_gets_the_window_and_no_hits_move_by_user(spark):
    from cohortex.sources.fixtures import sessions_from_events

    plan = sessions_from_events(spark, SF, "20240105", "20240110")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line]
    assert exchanges
    # whatever is dealt by user alone comes from the slim frame of session keys
    for line in exchanges:
        if "suffix" not in line.split("ENSURE")[0]:
            below = plan[plan.index(line) + len(line):].splitlines()[:3]
            assert not any("hits" in b for b in below), below


def test_session_is_user_day_and_hour(spark, tmp_path):
    """A hot user: hits of a session are bounded by the hour, at any size."""
    from pyspark.sql import functions as F

    from cohortex.sources.fixtures import sessions_from_events

    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    events = spark.range(5000).select(
        F.col("id").alias("event_id"),
        (start + F.make_dt_interval(mins=F.col("id").cast("int") * 7)).alias("ts"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(1).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit('{"k": 3}').alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    for t in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    s = sessions_from_events(spark, str(tmp_path))
    want = events.select("user_id", F.date_trunc("HOUR", "ts")).distinct().count()
    assert s.count() == want
    assert s.agg(F.max(F.size("hits"))).first()[0] <= 9
    hot = s.where("clientId = '1'").agg(F.count("*").alias("n"), F.max("visitNumber").alias("m")).first()
    assert hot.n == hot.m
