"""Sinks: staged full overwrite (S3) and append (S4), to a catalog table or a parquet location.

An overwrite never touches the old rows until the new ones are whole: they are written beside
the target, read back and counted, and then swapped in by renaming. A job that fails before that
leaves the old target readable and removes what it staged; :func:`recover` ends a swap that was
broken off between its two renames. An append can carry a run id: a run that has rows in the
target already adds none, so a repeated or retried run leaves each row once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_ID = "run_id"
_STAGED, _REPLACED = "__staged_", "__replaced_"


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _file_system(spark: SparkSession, target: str):
    """(file system, path class) of a location."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    return path(target).getFileSystem(context._jsc.hadoopConfiguration()), path


def _remove(spark: SparkSession, target: str) -> None:
    if _is_path(target):
        fs, path = _file_system(spark, target)
        fs.delete(path(target), True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(target)}")


def _quoted(table: str) -> str:
    return ".".join(f"`{p}`" for p in table.replace("`", "").split("."))


def _rename(spark: SparkSession, source: str, target: str) -> None:
    if not _is_path(target):
        spark.sql(f"ALTER TABLE {_quoted(source)} RENAME TO {_quoted(target)}")
        return
    fs, path = _file_system(spark, target)
    if not fs.rename(path(source), path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def _written(df: DataFrame, target: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def write_overwrite(df: DataFrame, target: str) -> None:
    """Replace rows and schema of ``target`` (not a dynamic partition overwrite), staged.

    ``df`` may read the target: it is evaluated in full before the swap.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    recover(spark, target)
    tag = uuid.uuid4().hex[:12]
    staged, replaced = f"{target}{_STAGED}{tag}", f"{target}{_REPLACED}{tag}"
    try:
        _written(df, staged, "errorifexists")
        found = read_back(spark, staged)
        found.count()  # every file's footer can be read
        if found.columns != df.columns:
            raise OSError(f"{staged} has the columns {found.columns}, not {df.columns}")
        there = exists(spark, target)
        if there:
            _rename(spark, target, replaced)
        try:
            _rename(spark, staged, target)
        except BaseException:
            if there:
                _rename(spark, replaced, target)
            raise
    except BaseException:
        _remove(spark, staged)
        raise
    if there:
        _remove(spark, replaced)


def _beside(spark: SparkSession, target: str, mark: str) -> list[str]:
    """The targets staged or replaced beside ``target``, oldest first."""
    if not _is_path(target):
        database, _, name = target.rpartition(".")
        names = spark.catalog.listTables(database or None, pattern=f"{name}{mark}*")
        return [f"{database}.{t.name}" if database else t.name for t in names]
    fs, path = _file_system(spark, target)
    found = fs.globStatus(path(f"{target}{mark}*")) or []
    return [s.getPath().toString() for s in sorted(found, key=lambda s: s.getModificationTime())]


def recover(spark: SparkSession, target: str) -> None:
    """Put the replaced rows back where a swap was broken off before the new ones took their place."""
    target = target.rstrip("/")
    if not exists(spark, target) and (left := _beside(spark, target, _REPLACED)):
        _rename(spark, left[-1], target)


def write_append(df: DataFrame, target: str, run_id: str | None = None, within: tuple[str, ...] = ()) -> None:
    """Append rows; the target is created when missing.

    With ``run_id`` the rows carry it in the column ``run_id``, and rows that the target has of
    that run already (with the same values of the columns ``within``) are left out by an anti-join.
    """
    if run_id is not None:
        spark, df = df.sparkSession, df.withColumn(RUN_ID, F.lit(run_id))
        if exists(spark, target):
            known = read_back(spark, target, merge_schema=True)
            if RUN_ID in known.columns:
                same = [RUN_ID, *within]
                left = df.join(known.where(F.col(RUN_ID) == run_id).select(*same).distinct(), same, "left_anti").select(*df.columns)
                if left.isEmpty():  # no empty part file for a repeated run
                    return
                df = left
            elif not _is_path(target):
                spark.sql(f"ALTER TABLE {_quoted(target)} ADD COLUMNS ({RUN_ID} STRING)")
    _written(df, target, "append")


def read_back(spark: SparkSession, target: str, merge_schema: bool = False) -> DataFrame:
    if not _is_path(target):
        return spark.table(target)
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(target)


def exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.sparkContext
    except Exception:  # no JVM gateway (Spark Connect): ask the reader, and only "not found" means no
        from pyspark.errors import AnalysisException

        try:
            spark.read.format("binaryFile").load(target).schema
            return True
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
    fs, path = _file_system(spark, target)
    return bool(fs.exists(path(target)))
