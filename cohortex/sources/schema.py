"""Declared schema of the nested session export (one row per visit, hits nested)."""

from pyspark.sql import types as T

EVENT_INFO = T.StructType(
    [
        T.StructField("eventCategory", T.StringType()),
        T.StructField("eventAction", T.StringType()),
        T.StructField("eventLabel", T.StringType()),
    ]
)
HIT = T.StructType([T.StructField("eventInfo", EVENT_INFO)])

DEVICE = T.StructType(
    [
        T.StructField("browser", T.StringType()),
        T.StructField("operatingSystem", T.StringType()),
        T.StructField("deviceCategory", T.StringType()),
        T.StructField("isMobile", T.BooleanType()),
    ]
)
GEO = T.StructType([T.StructField("region", T.StringType()), T.StructField("city", T.StringType())])
TRAFFIC = T.StructType([T.StructField("source", T.StringType()), T.StructField("medium", T.StringType())])
TOTALS = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("visits", "pageviews", "hits", "timeonsite", "bounces", "transactions", "totalTransactionRevenue")
    ]
)

# ``suffix`` is the shard date as yyyyMMdd text; in a parquet layout it is the partition column.
SESSION_SCHEMA = T.StructType(
    [
        T.StructField("clientId", T.StringType()),
        T.StructField("visitId", T.LongType()),
        T.StructField("visitNumber", T.LongType()),
        T.StructField("visitStartTime", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("channelGrouping", T.StringType()),
        T.StructField("device", DEVICE),
        T.StructField("geoNetwork", GEO),
        T.StructField("trafficSource", TRAFFIC),
        T.StructField("totals", TOTALS),
        T.StructField("hits", T.ArrayType(HIT)),
        T.StructField("suffix", T.StringType()),
    ]
)
SESSION_COLUMNS = [f.name for f in SESSION_SCHEMA.fields]
