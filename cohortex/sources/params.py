"""Parameterised queries (S5): named SQL templates with bound markers, never interpolated.

Table names are bound through ``IDENTIFIER(:name)``; values through ``:name`` markers.
Unused parameters are allowed, so callers may pass one parameter dict to all templates.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

TEMPLATES: dict[str, str] = {
    # sessions per client in a shard window
    "client_sessions": (
        "SELECT clientId AS clientid, COUNT(1) AS sessions, SUM(totals.hits) AS hits "
        "FROM IDENTIFIER(:table) "
        "WHERE suffix BETWEEN :start AND :end AND clientId IS NOT NULL "
        "GROUP BY clientId"
    ),
}


def param_query(spark: SparkSession, template: str, params: Mapping[str, object]) -> DataFrame:
    """Run a named template (or SQL text) with the parameters bound as named arguments.

    Spark ignores arguments the text does not use and rejects markers left unbound
    (``UNBOUND_SQL_PARAMETER``), so one parameter dict serves every template.
    """
    return spark.sql(TEMPLATES.get(template, template), args=dict(params))
