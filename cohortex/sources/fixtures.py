"""Nested sessions derived from the benchmark tables (the test tables hold no sessions).

Fixture A (``sessions_from_events``): one session per user, day and hour of ``events`` (a rule
of time, the same at every size, that bounds the hits of a session by one user's hour); the
user's customer row gives the city (nation) and region. Fixture B (``sessions_from_orders``): one
session per order, its line items are the hits; orders without lines have no hits.

Both are plain Spark jobs (aggregate, join, window); the DuckDB oracle derives the same rows
with the same rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortex.functions.scalar import seconds_since_epoch
from cohortex.sources.schema import DEVICE, SESSION_COLUMNS

# --- fixed values: how a value k (0..99) of an event maps to session attributes -------
CHANNELS = ("Direct", "Organic Search", "Paid Search", "Referral", "Social")
BROWSERS = ("Chrome", "Safari", "Firefox", "Edge", "Opera", "Samsung Internet", "Android Webview", None)
SYSTEMS = ("Android", "iOS", "Windows", "Macintosh", "Linux", "Chrome OS", None)
DEVICES = ("mobile", "desktop", "tablet")
MEDIUMS = ("cpc", "organic", "referral", None)
LABELS = ("Plan-Basic", "plan-plus", "other", None)
N_SOURCES = 6
# (category, action, label) of campaign hits: one hit for every campaign rule and near misses
# (other case, other value, missing field, missing token); event value k picks k % len
CAMPAIGN_HITS = (
    ("tim-controle-lp", "x", "contratar-agora!"),
    ("tim-controle-conheca-os-planos-e-promocoes", None, "contratar-agora"),
    ("tim-controle-conheca-os-planos-e-promocoes", "tim-controle-planos", "mais-planos-controle"),
    ("tim-controle-modal", "abrir", "portabilidade-migracao"),
    ("tim-controle-light-planos-tim", "tim-controle-light", "contratar-agora"),
    ("menu-principal", "menu-planos", "tim-controle"),
    ("home-para-voce", "banner-superior-item", "controle"),
    ("home-para-voce-banner-central", None, None),
    ("menu-principal", "menu-planos", "controle"),
    ("ecommerce-controle", "dados-pessoais", "sucesso"),
    ("Ecommerce-Controle", "criar-cadastro", "sucesso"),
    ("CONTROLE", "endereco", "sucesso"),
    (None, None, "sucesso"),
    ("ecommerce-chatbot", "adesao", "plano-Controle-b"),
    ("ecommerce-controle", "pagamento-fatura-impressa", "sucesso"),
    ("ecommerce-controle", "pagamento-express-impressa", "sucesso"),
    ("ecommerce-controle", "pagamento-debito-impressa", "sucesso"),
    ("ecommerce-controle", "pagamento-fatura-digital", "sucesso"),
    ("ecommerce-controle", "pagamento-express-digital", "sucesso"),
    ("ecommerce-controle", "pagamento-debito-digital", "sucesso"),
    ("ecommerce-controle", "tim-negocia", "sucesso"),
    ("ecommerce-controle", "sms", "sucesso"),
    ("ecommerce-controle", "oferta-pre", "sucesso"),
    ("ecommerce-controle", "oferta-express", "sucesso"),
    ("ecommerce", "adesao", "tim-controle-light"),
    ("tim-controle-lp", "x", "contratar-agora"),
    ("Tim-Controle-Lp", "x", "contratar-agora!"),
    ("tim-controle-conheca-os-planos-e-promocoes", "tim-controle-planos", "mais-planos"),
    ("menu-principal", None, "controle"),
    ("home-para-voce", "banner-superior-item", "Controle"),
    ("ecommerce-pos", "dados-pessoais", "Sucesso"),
    ("ecommerce-controle", "sms", "erro"),
    ("ecommerce-controle", "oferta-pre", None),
    ("ecommerce", "adesao", "tim-pos"),
    ("ecommerce", "adesao", None),
    ("Ecommerce", "adesao", "tim-controle"),
)
# --- end of fixed values ----------------------------------------------------------------


def _pick(values, k):
    """``values[k % len(values)]``; null k gives null."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.try_element_at(arr, (k % len(values)) + 1)


def _hits(arr_of_keyed_hits):
    """Sort (key..., hit) structs and keep the hits, in event order."""
    return F.transform(F.sort_array(arr_of_keyed_hits), lambda x: x.getField("hit"))


def _day_start(events: DataFrame, suffix: str, days: int = 0):
    """The start of a yyyyMMdd day (plus ``days``) as a literal of the type of ``ts``, so that a
    comparison with it reaches the parquet scan."""
    day = dt.datetime.strptime(suffix, "%Y%m%d") + dt.timedelta(days=days)
    return F.lit(day.strftime("%Y-%m-%d %H:%M:%S")).cast(events.schema["ts"].dataType)


def _default_hit():
    return (
        F.col("event_type"),
        F.concat(F.lit("k"), (F.col("k") % 10).cast("string")),
        _pick(LABELS, F.col("k")),
    )


def _campaign_hit():
    return tuple(_pick([h[i] for h in CAMPAIGN_HITS], F.col("k")) for i in range(3))


def sessions_from_events(
    spark: SparkSession,
    sf_dir: str,
    start: str | None = None,
    end: str | None = None,
    profile: bool = True,
    campaign: bool = False,
) -> DataFrame:
    """Nested sessions of ``events``; a session is (user_id, day, hour of the day).

    ``start`` and ``end`` (yyyyMMdd, inclusive) limit the sessions and reach the scan as a
    range of ``ts``. ``visitNumber`` counts all sessions of the user and ``geoNetwork`` comes
    from the customer tables: both are computed on a slim frame of the distinct session keys
    (at most 24 rows per user and day) and joined once on the complete key, so no hits array
    is ever partitioned by user alone. With ``profile=False`` both are left null and neither
    the slim frame nor the customer tables are read. ``campaign`` picks campaign hits.
    """
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    keys = ["user_id", "suffix", "hr"]
    session_key = [F.col("user_id"), F.date_format("ts", "yyyyMMdd").alias("suffix"), F.hour("ts").alias("hr")]
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("ts") >= _day_start(raw, start))
    if end is not None:
        inside = inside & (F.col("ts") < _day_start(raw, end, 1))
    ev = raw.where(inside).select(
        *session_key,
        "ts",
        "event_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        seconds_since_epoch("ts").alias("us"),
    )
    category, action, label = _campaign_hit() if campaign else _default_hit()
    hit = F.struct(
        F.struct(category.alias("eventCategory"), action.alias("eventAction"), label.alias("eventLabel")).alias("eventInfo")
    )
    is_purchase = F.col("event_type") == "purchase"
    per_session = ev.groupBy(*keys).agg(
        F.min("us").alias("visitId"),
        F.max("us").alias("last_us"),
        F.min_by("k", F.struct("ts", "event_id")).alias("k0"),
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "view").alias("pageviews"),
        F.count_if(is_purchase).alias("transactions"),
        F.sum(F.when(is_purchase, F.round(F.col("value") * 1_000_000).cast("bigint"))).alias("revenue"),
        _hits(F.collect_list(F.struct("ts", "event_id", hit.alias("hit")))).alias("hits"),
    )
    if profile:
        number = F.row_number().over(Window.partitionBy("user_id").orderBy("suffix", "hr")).cast("bigint")
        slim = raw.select(*session_key).distinct().withColumn("visitNumber", number)
        geo = (
            spark.read.parquet(f"{sf_dir}/customer.parquet")
            .select("c_custkey", "c_nationkey")
            # nation and region are tiny dimensions: the planner broadcasts them from their
            # measured size (autoBroadcastJoinThreshold), no hint needed
            .join(spark.read.parquet(f"{sf_dir}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(spark.read.parquet(f"{sf_dir}/region.parquet"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("user_id"), "n_name", "r_name")
        )
        per_session = per_session.join(slim.join(geo, "user_id", "left"), keys, "left")
    else:
        nothing = F.lit(None).cast("string")
        per_session = per_session.withColumns({"visitNumber": F.lit(None).cast("bigint"), "n_name": nothing, "r_name": nothing})
    k0 = F.col("k0")
    sessions = per_session.select(
        F.col("user_id").cast("string").alias("clientId"),
        "visitId",
        "visitNumber",
        F.col("visitId").alias("visitStartTime"),
        F.col("suffix").alias("date"),
        _pick(CHANNELS, k0).alias("channelGrouping"),
        F.struct(
            _pick(BROWSERS, k0).alias("browser"),
            _pick(SYSTEMS, k0).alias("operatingSystem"),
            _pick(DEVICES, k0).alias("deviceCategory"),
            ((k0 % 3) == 0).alias("isMobile"),
        ).alias("device"),
        F.struct(F.col("r_name").alias("region"), F.col("n_name").alias("city")).alias("geoNetwork"),
        F.struct(
            F.concat(F.lit("src"), (k0 % N_SOURCES).cast("string")).alias("source"),
            _pick(MEDIUMS, k0).alias("medium"),
        ).alias("trafficSource"),
        F.struct(
            F.lit(1).cast("bigint").alias("visits"),
            F.col("pageviews").cast("bigint").alias("pageviews"),
            F.col("n_events").cast("bigint").alias("hits"),
            (F.col("last_us") - F.col("visitId")).alias("timeonsite"),
            F.when(F.col("n_events") == 1, F.lit(1).cast("bigint")).alias("bounces"),
            F.col("transactions").cast("bigint").alias("transactions"),
            F.col("revenue").alias("totalTransactionRevenue"),
        ).alias("totals"),
        "hits",
        "suffix",
    )
    return sessions.select(*SESSION_COLUMNS)


def sessions_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    hit = F.struct(
        F.struct(
            F.col("l_returnflag").alias("eventCategory"),
            F.col("l_linestatus").alias("eventAction"),
            F.lit(None).cast("string").alias("eventLabel"),
        ).alias("eventInfo")
    )
    hits = lines.groupBy("l_orderkey").agg(
        _hits(F.collect_list(F.struct("l_linenumber", hit.alias("hit")))).alias("hits")
    )
    start = seconds_since_epoch("o_orderdate")
    sessions = orders.join(hits, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_custkey").cast("string").alias("clientId"),
        F.col("o_orderkey").alias("visitId"),
        F.lit(None).cast("bigint").alias("visitNumber"),
        start.alias("visitStartTime"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("date"),
        F.col("o_orderpriority").alias("channelGrouping"),
        F.lit(None).cast(DEVICE).alias("device"),
        F.lit(None).cast("struct<region:string,city:string>").alias("geoNetwork"),
        F.lit(None).cast("struct<source:string,medium:string>").alias("trafficSource"),
        F.struct(
            F.lit(1).cast("bigint").alias("visits"),
            F.lit(None).cast("bigint").alias("pageviews"),
            F.when(F.col("hits").isNotNull(), F.size("hits")).cast("bigint").alias("hits"),
            F.lit(None).cast("bigint").alias("timeonsite"),
            F.lit(None).cast("bigint").alias("bounces"),
            F.lit(None).cast("bigint").alias("transactions"),
            F.lit(None).cast("bigint").alias("totalTransactionRevenue"),
        ).alias("totals"),
        "hits",
        F.date_format("o_orderdate", "yyyyMMdd").alias("suffix"),
    )
    return sessions.select(*SESSION_COLUMNS)
