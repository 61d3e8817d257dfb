"""Learning, registry and run: save/load, digest check, lookup, unseen values, fallback."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortex.catalog import queries
from cohortex.catalog.setup import FIXTURE_RUN
from cohortex.context import scratch_path
from cohortex.operators import ml as M
from cohortex.operators.registry import (
    REGISTRY_SCHEMA,
    latest_matching,
    load_verified,
    registry_append,
    registry_lookup,
    registry_verify,
    runtime_versions,
)
from cohortex.plans.datasets import scoring_dataset, training_dataset
from cohortex.plans.run import run, train
from cohortex.sources.fixtures import sessions_from_events
from cohortex.sources.sinks import read_back

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    cfg = replace(FIXTURE_RUN, trained_model_table=scratch_path(spark, "registry"), max_iter=5)
    sessions = sessions_from_events(spark, SF).cache()
    return cfg, sessions, train(spark, cfg, sessions)


def test_select_by_dtype(spark):
    df = spark.createDataFrame([("a", 1, 2.0, True)], "s string, i int, d double, b boolean")
    assert M.select_by_dtype(df) == (["s"], ["i", "d"])


def test_fitted_scaler_uses_the_population_deviation(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (5.0, 5.0)], "x double, c double")
    out = Pipeline(stages=M.feature_stages(M.FeatureLayout((), ("x", "c")), 4)).fit(df).transform(df)
    rows = [r[0] for r in out.select(vector_to_array("_num_scaled")).collect()]
    assert [round(r[0], 4) for r in rows] == [-1.2649, -0.6325, 0.6325, 1.2649]
    assert all(r[1] == 0.0 for r in rows)


def test_model_beats_the_majority_rule(spark):
    """Planted signal: the label follows one number, with one in ten flipped."""
    rows = [(str(i), "ab"[i % 2], float(i % 10), int((i % 10 > 5) != (i % 10 == 0 and i % 20 == 0))) for i in range(400)]
    df = spark.createDataFrame(rows, "clientid string, t string, x double, y_conversions int")
    layout = M.FeatureLayout.of(df)
    model = M.fit(df, layout, max_iter=10)
    acc = M.accuracy(M.predict_proba(model, df, layout)).first()["accuracy"]
    majority = max(sum(r[3] for r in rows), sum(1 - r[3] for r in rows)) / len(rows)
    assert acc > majority + 0.2


def test_event_filter_value_alone_filters_the_category():
    cfg = replace(FIXTURE_RUN, event_filter_value="purchase")
    rule = cfg.effective_conversion_rule()
    assert (rule.eventCategory, rule.eventAction, rule.eventLabel) == ("purchase", None, None)
    with pytest.raises(ValueError):
        replace(FIXTURE_RUN, event_filter_type="eventAction").effective_conversion_rule()


def test_save_load_same_predictions(spark, trained):
    cfg, sessions, t = trained
    scoring = scoring_dataset(sessions, cfg)
    loaded = PipelineModel.load(t.registry_row["model_path"])
    a = M.predict_proba(t.model, scoring, t.layout).select("clientid", "prob").collect()
    b = M.predict_proba(loaded, scoring, t.layout).select("clientid", "prob").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    plan = M.predict_proba(t.model, scoring, t.layout)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan  # scoring stays in the JVM


def test_registry_verify_detects_change(spark, trained, tmp_path):
    cfg, _, t = trained
    row = registry_lookup(spark, cfg.trained_model_table, cfg.name)
    assert row is not None and registry_verify(spark, row)
    # copy the model, damage one file of the copy, verify the copy's row fails
    import shutil

    src = row["model_path"].split(":", 1)[-1]
    dst = str(tmp_path / "copy")
    shutil.copytree(src, dst)
    meta = next(os.path.join(d, f) for d, _, fs in os.walk(dst) for f in fs if f.startswith("part-"))
    with open(meta, "a") as fh:
        fh.write(" ")
    damaged = row.asDict() | {"model_path": dst}
    assert not registry_verify(spark, damaged)


def test_registry_lookup_newest_of_version_and_name(spark):
    now = dt.datetime(2024, 1, 1, 12)
    v = runtime_versions()
    rows = [
        (now, v["spark_version"], v["python_version"], "a", "p1", "m", 1.0, 1.0),
        (now + dt.timedelta(hours=1), v["spark_version"], v["python_version"], "a", "p2", "m", 1.0, 1.0),
        (now + dt.timedelta(hours=2), "0.0", v["python_version"], "a", "p3", "m", 1.0, 1.0),
        (now + dt.timedelta(hours=3), v["spark_version"], v["python_version"], "b", "p4", "m", 1.0, 1.0),
        (now - dt.timedelta(hours=1), v["spark_version"], v["python_version"], "a", "p5", "m", 1.0, 1.0),
    ]
    reg = spark.createDataFrame(rows, REGISTRY_SCHEMA)
    got = latest_matching(reg, "timestamp", name="a", **v).collect()
    assert [r.model_path for r in got] == ["p2"]
    assert latest_matching(reg, "timestamp", name="zzz", **v).collect() == []


def test_missing_registry_gives_none(spark):
    assert load_verified(spark, scratch_path(spark, "nothing"), "x") is None


def test_load_or_train_falls_back_when_nothing_loads(spark, trained):
    cfg, sessions, _ = trained
    registry = scratch_path(spark, "fresh_registry")
    c = replace(cfg, trained_model_table=registry, load_trained_model=True)
    run(spark, c, sessions)  # empty registry: trains and registers one model
    assert read_back(spark, registry).count() == 1


def test_unseen_category_scores(spark, trained):
    cfg, sessions, t = trained
    scoring = scoring_dataset(sessions, cfg).withColumn("city", F.lit("NEVER_SEEN")).withColumn("browser", F.lit(None))
    out = M.predict_proba(t.model, scoring, t.layout).select("prob").collect()
    assert out and all(0.0 <= r.prob <= 1.0 for r in out)


def test_run_writes_audience_and_loads_model(spark, trained):
    cfg, sessions, _ = trained
    dest = scratch_path(spark, "audience")
    c = replace(cfg, destination_table=dest, load_trained_model=True)
    before = read_back(spark, cfg.trained_model_table).count()
    out = run(spark, c, sessions)
    assert read_back(spark, cfg.trained_model_table).count() == before  # loaded, not retrained
    assert out.columns == [c.index_dimension, c.value_dimension]
    assert {r[1] for r in out.collect()} <= {"low", "medium", "high"}
    assert out.count() == scoring_dataset(sessions, cfg).count()
    assert read_back(spark, dest).count() == out.count()


def test_training_dataset_requires_two_classes(spark):
    sessions = sessions_from_events(spark, SF)
    cfg = replace(FIXTURE_RUN, downsample_majority_class=0.0)
    only_pos = training_dataset(sessions, cfg).where(F.col("y_conversions") == 1)
    with pytest.raises(ValueError):
        M.fit(only_pos, M.FeatureLayout.of(only_pos))


TRAINING_TEMPLATE = """
WITH t AS (
  SELECT clientId AS clientid, COUNT(1) AS sessions, SUM(totals.hits) AS hits, MAX(channelGrouping) AS channel
  FROM IDENTIFIER(:table)
  WHERE suffix BETWEEN :lookback_start_date AND :lookback_end_date AND clientId IS NOT NULL
  GROUP BY clientId),
c AS (
  SELECT clientId AS clientid, COUNT(1) AS n
  FROM IDENTIFIER(:table) LATERAL VIEW explode(hits) ex AS h
  WHERE suffix BETWEEN :conversion_window_start_date AND :conversion_window_end_date
    AND h.eventInfo.eventCategory = 'purchase' AND h.eventInfo.eventAction = 'k3'
    AND UPPER(h.eventInfo.eventLabel) LIKE '%PLAN%'
  GROUP BY clientId)
SELECT t.*, IF(COALESCE(c.n, 0) > 0, 1, 0) AS y_conversions FROM t LEFT JOIN c ON t.clientid = c.clientid
"""
CLASSIFICATION_TEMPLATE = """
SELECT clientId AS clientid, COUNT(1) AS sessions, SUM(totals.hits) AS hits, MAX(channelGrouping) AS channel
FROM IDENTIFIER(:table)
WHERE suffix BETWEEN :classification_start_date AND :classification_end_date AND clientId IS NOT NULL
GROUP BY clientId
"""


def test_run_with_user_query_templates(spark, trained, tmp_path):
    cfg, sessions, _ = trained
    (tmp_path / "training_query_template.sql").write_text(TRAINING_TEMPLATE)
    (tmp_path / "classification_query_template.sql").write_text(CLASSIFICATION_TEMPLATE)
    c = replace(cfg, queries_location=str(tmp_path), trained_model_table=None, destination_table=None)
    out = run(spark, c, sessions)
    w = c.windows()
    want = sessions.where(F.col("suffix").between(w.scoring_start, w.scoring_end)).select("clientId").distinct().count()
    assert out.columns == ["dimension14", "dimension28"] and out.count() == want


def test_a_repeated_run_leaves_one_registry_row(spark, trained):
    _, _, t = trained
    registry = scratch_path(spark, "run_registry")
    first = registry_append(spark, registry, t.model, "a", 0.5, 0.5, run_id="2024-01-30")
    again = registry_append(spark, registry, t.model, "a", 0.5, 0.5, run_id="2024-01-30")
    assert again["model_path"] == first["model_path"] and read_back(spark, registry).count() == 1
    registry_append(spark, registry, t.model, "a", 0.5, 0.5)  # another run
    registry_append(spark, registry, t.model, "b", 0.5, 0.5, run_id="2024-01-30")  # another audience of that run
    assert sorted(r[0] for r in read_back(spark, registry).select("name").collect()) == ["a", "a", "b"]
    assert registry_verify(spark, registry_lookup(spark, registry, "b"))


@pytest.mark.parametrize("name", ["run_pipeline", "load_or_train", "predict_proba", "audience_export"])
def test_sessions_are_built_once(spark, monkeypatch, name):
    """The learning queries pass sessions that are stored, not a plan that is computed at every use."""
    seen = []

    class Stop(Exception):
        pass

    def stop(spark, cfg, sessions):
        seen.append(sessions)
        raise Stop

    monkeypatch.setattr(queries, "run", stop)
    monkeypatch.setattr(queries, "train", stop)
    with pytest.raises(Stop):
        queries.QUERIES[name](spark, SF)
    built = queries.feature_sessions(spark, SF)
    assert seen[0].columns == built.columns and not any("events.parquet" in f for f in seen[0].inputFiles())
    assert sorted(map(repr, seen[0].collect())) == sorted(map(repr, built.collect()))
