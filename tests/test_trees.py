"""The exported trees give the model's own probabilities, in Spark and in DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortex.catalog.setup import FIXTURE_RUN
from cohortex.operators import ml as M
from cohortex.operators.trees import node_table, probability_sql, slot_expressions, walked_probability
from cohortex.plans.datasets import scoring_dataset, training_dataset
from cohortex.plans.run import materialise, split_for_training
from cohortex.sources.fixtures import sessions_from_events


@pytest.fixture(scope="module")
def fitted(spark):
    sessions = sessions_from_events(spark, "/root/testdata/sf0.01")
    parts = materialise(split_for_training(training_dataset(sessions, FIXTURE_RUN), FIXTURE_RUN), "parts")
    layout = M.FeatureLayout.of(parts.drop("is_test"), exclude=FIXTURE_RUN.exclude_columns)
    model = M.fit(parts.where(~F.col("is_test")), layout, max_iter=8)
    scoring = scoring_dataset(sessions, FIXTURE_RUN)
    # values the model has not seen, and nulls
    odd = scoring.limit(3).withColumns({"clientid": F.concat(F.lit("odd"), "clientid"), "city": F.lit("Nowhere's"), "browser": F.lit(None).cast("string"), "current_visit": F.lit(None).cast("long")})
    return model, layout, materialise(scoring.unionByName(odd), "scoring")


def test_nodes_are_whole_trees(spark, fitted):
    model, _, _ = fitted
    nodes = {(r.tree, r.node): r for r in node_table(spark, model).collect()}
    assert {t for t, _ in nodes} == set(range(8))
    for (t, _), r in nodes.items():
        assert (r.left is None) == (r.slot is None) == (r.threshold is None and r.categories is None)
        assert r.left is None or {(t, r.left), (t, r.right)} <= set(nodes)


def test_walked_probabilities_are_the_models(spark, fitted):
    model, layout, scoring = fitted
    want = M.predict_proba(model, scoring, layout).select("clientid", F.col("prob").alias("want"))
    both = walked_probability(spark, model, scoring, layout, "clientid").join(want, "clientid", "full").collect()
    assert len(both) == scoring.count() > 100
    assert all(abs(r.prob - r.want) <= 1e-9 for r in both)
    assert len({round(r.prob, 6) for r in both}) > 10


def test_duckdb_gives_the_models_probabilities(spark, fitted, tmp_path):
    model, layout, scoring = fitted
    sql = probability_sql(node_table(spark, model), slot_expressions(model, layout))
    scoring.write.parquet(str(tmp_path / "features"))
    got = dict(duckdb.sql(f"SELECT clientid, {sql} FROM read_parquet('{tmp_path}/features/*.parquet')").fetchall())
    want = {r.clientid: r.prob for r in M.predict_proba(model, scoring, layout).select("clientid", "prob").collect()}
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) <= 1e-9 for c in want)
    in_spark = {r[0]: r[1] for r in scoring.selectExpr("clientid", f"{sql} AS p").collect()}
    assert all(abs(in_spark[c] - want[c]) <= 1e-9 for c in want)
