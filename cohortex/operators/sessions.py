"""Per-session projections and the latest / first session of each client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortex.functions.scalar import BROWSER_KEEP, OS_KEEP, bool_flag, bucket_rare

# Order of "newest session": visitId, then visitStartTime, then the shard suffix. The
# ascending order (first session) uses the same keys; nulls sort first ascending and last
# descending, as in the reference dialect. Sessions that tie in all of them are ordered by
# their attributes, in the order of the selected columns.
SESSION_ORDER = ("visitId", "visitStartTime", "suffix")


def session_attributes(sessions: DataFrame) -> DataFrame:
    """Latest-session attributes with nested field access and rare-value folding."""
    return sessions.select(
        "clientId",
        "visitId",
        "visitStartTime",
        "suffix",
        "visitNumber",
        "channelGrouping",
        bucket_rare(F.col("device.browser"), BROWSER_KEEP).alias("browser"),
        F.col("device.deviceCategory").alias("deviceCategory"),
        bucket_rare(F.col("device.operatingSystem"), OS_KEEP).alias("operatingSystem"),
        F.col("geoNetwork.region").alias("region"),
        F.col("geoNetwork.city").alias("city"),
        bool_flag(F.col("device.isMobile")).alias("isMobile"),
    )


def _ranked(df: DataFrame, key: str, newest: bool) -> Column:
    rest = [c for c in df.columns if c not in (key, *SESSION_ORDER)]
    order = [F.desc(c) if newest else F.asc(c) for c in (*SESSION_ORDER, *rest)]
    return F.row_number().over(Window.partitionBy(key).orderBy(*order))


def top1_per_client(df: DataFrame, newest: bool, key: str = "clientId") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY visitId ..) = 1``, then ``* EXCEPT(rn)``.

    Catalyst plans this as a partial ``WindowGroupLimit`` before the shuffle, so each map
    task sends at most one row per client: a client with a huge share of the sessions does
    not move all of them.
    """
    return df.withColumn("rn", _ranked(df, key, newest)).where(F.col("rn") == 1).drop("rn")


def latest_session(sessions: DataFrame) -> DataFrame:
    """Attributes of each client's newest session."""
    attrs = session_attributes(sessions)
    return top1_per_client(attrs, newest=True).drop("visitId", "visitStartTime", "suffix")


def first_session(sessions: DataFrame) -> DataFrame:
    """Channel of each client's first session."""
    cols = sessions.select("clientId", "channelGrouping", *SESSION_ORDER)
    return top1_per_client(cols, newest=False).select("clientId", "channelGrouping")

