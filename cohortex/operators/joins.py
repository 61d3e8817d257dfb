"""Joins of the feature queries: array unnest (J1) and equi-joins on the client."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HIT_INFO = "eventInfo"


def unnest_hits(sessions: DataFrame, *keep: str) -> DataFrame:
    """``t, UNNEST(t.hits) h``: one row per hit with its ``eventInfo`` struct; sessions with
    empty or null hits vanish.

    The array is exploded through the field access ``hits.eventInfo`` (an array of the
    event structs), which lets the parquet scan read only those nested fields: a hit of a
    session export has many more (page, product, custom dimensions, ...).
    """
    return sessions.select(*keep, F.explode(F.col("hits").getField(HIT_INFO)).alias(HIT_INFO))


def join_on_client(left: DataFrame, right: DataFrame, how: str = "inner", key: str = "clientId") -> DataFrame:
    """Equi-join on the client key. Both sides are already one row per client, so the join
    is a co-partitioned sort-merge (or a broadcast that AQE picks from runtime sizes)."""
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins are used by the feature queries")
    return left.join(right, on=key, how=how)
