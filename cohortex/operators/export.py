"""Audience assembly (M9): score, segment (F14), select and rename."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortex.functions.scalar import segment_label
from cohortex.operators.ml import KEY, FeatureLayout, predict_proba


def rename_output(df: DataFrame, key_name: str, value_name: str, key: str = KEY, value: str = "segment") -> DataFrame:
    return df.select(F.col(key).alias(key_name), F.col(value).alias(value_name))


def audience(
    model: PipelineModel,
    features: DataFrame,
    layout: FeatureLayout,
    medium: float = 0.3,
    high: float = 0.7,
    key_name: str = "dimension14",
    value_name: str = "dimension28",
) -> DataFrame:
    """One row per client: ``(key_name, value_name)`` with low / medium / high."""
    scored = predict_proba(model, features, layout).withColumn("segment", segment_label(F.col("prob"), medium, high))
    return rename_output(scored, key_name, value_name)
