"""Scans of the date-sharded session table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.sources.schema import SESSION_SCHEMA


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Nested sessions stored as parquet partitioned by ``suffix``.

    The schema is declared, so ``suffix`` stays text (inference would make it an int and
    break the text comparison of the window bounds).
    """
    return spark.read.schema(SESSION_SCHEMA).parquet(path)


def load_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, else a parquet location. Lazy: nothing is collected."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return spark.table(name_or_path)
    return spark.read.parquet(name_or_path)


def suffix_between(start: str, end: str, column: str = "suffix") -> Column:
    """Text comparison, both ends inclusive: shards such as ``intraday_2024..`` fall out."""
    return F.col(column).between(F.lit(start), F.lit(end))


def scan_suffix_range(sessions: DataFrame, start: str, end: str) -> DataFrame:
    """Shards whose suffix lies in ``[start, end]``; on a partitioned table a partition filter."""
    return sessions.where(suffix_between(start, end))


def client_not_null(sessions: DataFrame, key: str = "clientId") -> DataFrame:
    return sessions.where(F.col(key).isNotNull())


def scan_window(sessions: DataFrame, start: str, end: str) -> DataFrame:
    """The scan every feature query starts with: window on the shard and a known client."""
    return client_not_null(scan_suffix_range(sessions, start, end))


def shard_suffixes(names: list[str], prefix: str, start: str, end: str) -> dict[str, str]:
    """Shard table name -> suffix for names ``<prefix><suffix>`` with ``start <= suffix <= end``
    (text comparison, as for the partition column)."""
    out = {}
    for name in names:
        if name.lower().startswith(prefix.lower()):
            suffix = name[len(prefix):]
            if start <= suffix <= end:
                out[name] = suffix
    return out


def read_sharded_tables(spark: SparkSession, prefix: str, start: str, end: str, database: str | None = None) -> DataFrame:
    """A family of date-sharded catalog tables ``<prefix>yyyyMMdd`` as one session frame.

    Only table names (catalog metadata) reach the driver; shards outside the window are
    never read. Each shard gets its ``suffix`` as a column, so the rest of the engine sees
    the same frame as from a partitioned table.
    """
    names = [t.name for t in spark.catalog.listTables(database, pattern=f"{prefix}*")]
    shards = shard_suffixes(names, prefix, start, end)
    if not shards:
        return spark.createDataFrame([], SESSION_SCHEMA)
    frames = []
    for name, suffix in sorted(shards.items(), key=lambda kv: kv[1]):
        table = spark.table(f"{database}.{name}" if database else name)
        frames.append(table.drop("suffix").withColumn("suffix", F.lit(suffix)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*[c for c in SESSION_SCHEMA.fieldNames() if c in out.columns])


def load_sessions(spark: SparkSession, source: str, start: str, end: str) -> DataFrame:
    """The session source of a run: ``[db.]prefix*`` is a family of shard tables (only
    shards in ``[start, end]`` are read), a path is parquet partitioned by ``suffix`` read
    with the declared schema, anything else a catalog table."""
    if source.endswith("*"):
        db, _, prefix = source[:-1].rpartition(".")
        return read_sharded_tables(spark, prefix, start, end, db or None)
    if "/" in source or ":" in source:
        return read_sessions(spark, source)
    return spark.table(source)
