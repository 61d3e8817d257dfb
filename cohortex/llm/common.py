"""Shared helpers of the training-data operators: table access, durable tables, words.

Words are the runs of ``[^\\x20\\x09-\\x0D]+`` (everything but ASCII white space);
``lower_az`` lower-cases A-Z only. Both are byte-wise rules, so they mean the same in
Spark, in numpy over UTF-8 bytes and in DuckDB.
"""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.context import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
AZ_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
AZ_LOWER = "abcdefghijklmnopqrstuvwxyz"


def release_memory() -> None:
    """Give freed arrays back to the system: a Python worker stays alive between its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, with :func:`release_memory` when the task ends."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back; ``compression``: another than the session's.

    Cuts lineage in a way that survives a lost executor: the rows are files that every
    executor can read, not blocks held by one of them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and broadcasts of finished jobs that nothing refers to any more.

    Spark does so when the driver's JVM collects its garbage; a driver with little to do may not
    for hours, while files of several times the input lie on the executors' disks. To be called
    between the large steps of a query, after :func:`durable` has cut what came before. One
    collection is not enough: a job that has just ended is still referred to for a moment. The
    collections also give free heap back to the system.
    """
    gc.collect()  # frames that Python has dropped still hold their plans in the JVM
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        return
    jvm.System.gc()
    time.sleep(0.3)
    jvm.System.gc()


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def word_count(column: str) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named c0, c1, ... (no helper column is named so), and the new name of each."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
