"""Model registry.

A model is a saved MLlib ``PipelineModel`` directory in the shared work folder. The
registry is an append-only table with one row per training: time, runtime versions,
name, model location, digest and the two accuracies. Before a stored model is used its
digest is recomputed from the files and compared (detects damage; MLlib's format holds no
pickled code).
"""

from __future__ import annotations

import datetime as dt
import logging
import platform
import re
import uuid

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortex.context import work_root
from cohortex.sources.sinks import RUN_ID, exists, read_back, write_append

log = logging.getLogger("cohortex")

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("spark_version", T.StringType()),
        T.StructField("python_version", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("md5", T.StringType()),
        T.StructField("score_train", T.DoubleType()),
        T.StructField("score_test", T.DoubleType()),
    ]
)


def runtime_versions() -> dict[str, str]:
    return {"spark_version": pyspark.__version__, "python_version": platform.python_version()}


def model_digest(spark: SparkSession, path: str) -> str | None:
    """md5 over the sorted ``relative path:md5(content)`` list of the model's files.

    One aggregation on the executors; only the final digest reaches the driver. None if the
    folder does not exist or is empty; any other error is the caller's.
    """
    if not exists(spark, path):
        return None
    root = path.rstrip("/").split(":", 1)[-1].lstrip("/")
    rel = F.regexp_replace(F.col("path"), "^.*?" + re.escape(root) + "/", "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    entries = files.select(F.concat(rel, F.lit(":"), F.md5("content")).alias("e"))
    row = entries.agg(
        F.md5(F.array_join(F.sort_array(F.collect_list("e")), "\n")).alias("d"), F.count("e").alias("n")
    ).first()
    return row["d"] if row and row["n"] else None


def save_model(spark: SparkSession, model: PipelineModel, name: str, model_root: str | None = None) -> tuple[str, str]:
    root = (model_root or f"{work_root(spark)}/models").rstrip("/")
    path = f"{root}/{name}/{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    model.write().overwrite().save(path)
    digest = model_digest(spark, path)
    if digest is None:
        raise OSError(f"model was not written to {path}")
    return path, digest


def registry_append(
    spark: SparkSession,
    registry: str,
    model: PipelineModel,
    name: str,
    score_train: float | None,
    score_test: float | None,
    model_root: str | None = None,
    run_id: str | None = None,
) -> Row:
    """Save the model, append its registry row, return the row.

    A run that is in the registry already (``run_id``; a fresh one if not given) saves nothing and
    returns its row, so a repeated run leaves one row; concurrent runs leave one each.
    """
    run_id = run_id or uuid.uuid4().hex
    known = read_registry(spark, registry)
    if known is not None and (row := latest_matching(known, "timestamp", run_id=run_id, name=name).first()):
        return row
    path, digest = save_model(spark, model, name, model_root)
    row = Row(
        timestamp=dt.datetime.now(dt.timezone.utc),
        **runtime_versions(),
        name=name,
        model_path=path,
        md5=digest,
        score_train=None if score_train is None else float(score_train),
        score_test=None if score_test is None else float(score_test),
    )
    write_append(spark.createDataFrame([row], REGISTRY_SCHEMA), registry, run_id, within=("name",))
    return row


def read_registry(spark: SparkSession, registry: str) -> DataFrame | None:
    """The registry's rows, None if there is none; rows written before run ids were kept have null there."""
    if not exists(spark, registry):
        return None
    rows = read_back(spark, registry, merge_schema=True)
    return rows if RUN_ID in rows.columns else rows.withColumn(RUN_ID, F.lit(None).cast("string"))


def latest_matching(df: DataFrame, order_by: str, **equal) -> DataFrame:
    """Rows equal on the given columns, newest first (ties by the other columns), one row."""
    for col, value in equal.items():
        df = df.where(F.col(col) == F.lit(value))
    return df.orderBy(F.col(order_by).desc(), *[F.col(c).desc() for c in df.columns if c != order_by]).limit(1)


def registry_lookup(spark: SparkSession, registry: str, name: str) -> Row | None:
    """Newest row of ``name`` written by the same Spark and Python versions, or None."""
    rows = read_registry(spark, registry)
    return None if rows is None else latest_matching(rows, "timestamp", name=name, **runtime_versions()).first()


def registry_verify(spark: SparkSession, row: Row | None) -> bool:
    """Whether the row's model files are those that were registered; files that cannot be read are not."""
    if row is None:
        return False
    try:
        return model_digest(spark, row["model_path"]) == row["md5"]
    except Exception:
        log.exception("model %s could not be read", row["model_path"])
        return False


def load_verified(spark: SparkSession, registry: str, name: str) -> PipelineModel | None:
    """The newest stored model whose digest still matches, else None (the caller trains anew).

    A missing registry row and a digest that does not match are ordinary outcomes and are
    logged with the model's path; any other error is logged with its stack before the
    fall-back, so that a permission or network problem cannot pass as "no model".
    """
    try:
        row = registry_lookup(spark, registry, name)
        if row is None:
            log.info("no stored model %r in %s", name, registry)
            return None
        if not registry_verify(spark, row):
            log.warning("stored model %s of %s does not match its digest %s", row["model_path"], row["timestamp"], row["md5"])
            return None
        model = PipelineModel.load(row["model_path"])
    except Exception:
        log.exception("stored model %r of %s could not be loaded", name, registry)
        return None
    log.info(
        "loaded model %s of %s, digest %s, accuracy train=%s test=%s",
        row["model_path"], row["timestamp"], row["md5"], row["score_train"], row["score_test"],
    )
    return model
