"""Text columns of very many values: bounded dictionaries, categorical splits, saved with the model."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from cohortex.operators import ml as M
from cohortex.operators.trees import node_table, probability_sql, slot_expressions, walked_probability
from cohortex.plans.run import layout_of


def cities(spark, n=120_000):
    """100,000 cities seen once, 40 frequent ones; half of the frequent ones convert."""
    i = F.col("id")
    city = F.when(i < 100_000, F.concat(F.lit("rare's "), i.cast("string"))).otherwise(F.concat(F.lit("big"), (i % 40).cast("string")))
    label = F.when(i < 100_000, (i % 10 == 0).cast("int")).otherwise((i % 40 < 20).cast("int"))
    return spark.range(0, n, 1, 4).select(
        i.cast("string").alias("clientid"), F.when(i % 1000 == 1, None).otherwise(city).alias("city"),
        F.concat(F.lit("d"), (i % 3).cast("string")).alias("device"), (i % 7).alias("visits"), label.alias("y_conversions"))


@pytest.fixture(scope="module")
def fitted(spark):
    df = cities(spark).cache()
    layout = M.FeatureLayout.of(df)
    return df, layout, M.fit(df, layout, max_iter=3)


def test_a_city_of_100_000_values_fits_in_bounded_dictionaries(spark, fitted):
    df, layout, model = fitted
    sizes = {c: len(v) for s in model.stages if isinstance(s, StringIndexerModel) for c, v in zip(s.getInputCols(), s.labelsArray, strict=True)}
    assert sizes["device"] == 3 and sizes["city" + M.FOLDED] <= M.WIDE_KEPT + 1
    scored = M.predict_proba(model, df, layout)
    assert scored.select("features").first()[0].size == 3 + 1 + 1
    assert model.stages[-1].getOrDefault("maxBins") <= M.WIDE_KEPT + 2
    assert M.accuracy(scored).first()["accuracy"] > 0.9
    big = scored.where("city LIKE 'big%'").agg(F.min(F.col("prediction") == F.col("y_conversions"))).first()[0]
    assert big  # the frequent cities are told apart by categorical splits


def test_it_is_saved_and_exported(spark, fitted, tmp_path):
    df, layout, model = fitted
    few = df.where("clientid % 997 = 0 OR city IS NULL AND clientid % 9 = 0")
    few = few.unionByName(few.limit(5).withColumns({"city": F.lit("never seen"), "clientid": F.concat(F.lit("n"), "clientid")}))
    want = {r.clientid: r.prob for r in M.predict_proba(model, few, layout).collect()}
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert sorted(layout_of(again).text) == sorted(layout.text) and layout_of(again).numbers == layout.numbers
    assert {r.clientid: r.prob for r in M.predict_proba(again, few, layout).collect()} == want
    walked = {r.clientid: r.prob for r in walked_probability(spark, again, few, layout, "clientid").collect()}
    few.write.parquet(str(tmp_path / "rows"))
    sql = probability_sql(node_table(spark, model), slot_expressions(model, layout))
    in_duckdb = dict(duckdb.sql(f"SELECT clientid, {sql} FROM read_parquet('{tmp_path}/rows/*.parquet')").fetchall())
    assert walked.keys() == in_duckdb.keys() == want.keys() and len(want) > 100
    assert all(abs(walked[c] - p) <= 1e-9 and abs(in_duckdb[c] - p) <= 1e-9 for c, p in want.items())


def test_narrow_columns_give_the_one_hot_stages(spark):
    df = cities(spark).drop("city").limit(500)
    layout = M.FeatureLayout.of(df)
    assert M.wide_columns(layout.prepare(df), layout.text) == []
    assert [type(s) for s in M.feature_stages(layout, 10)] == [type(s) for s in M.feature_stages(layout, 10, {})]


def test_frequent_values_are_exact(spark):
    rows = [(f"v{k}",) for k in range(300) for _ in range(1 + k // 10)] + [("v299",)] * 3
    df = spark.createDataFrame(rows, "c string").repartition(5)
    want = sorted({f"v{k}" for k in range(300)}, key=lambda v: (-sum(r[0] == v for r in rows), v))[:25]
    assert M.frequent_values(df, "c", 25) == want
