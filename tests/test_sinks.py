"""Staged overwrite and idempotent append."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortex.sources import sinks
from cohortex.sources.sinks import read_back, recover, write_append, write_overwrite


def values(spark, target):
    return sorted(r[0] for r in read_back(spark, target).select("v").collect())


@pytest.fixture(params=["path", "table"])
def target(request, tmp_path, spark):
    if request.param == "path":
        yield str(tmp_path / "audience")
    else:
        name = f"audience_{os.path.basename(str(tmp_path)).replace('-', '_')}"
        yield name
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def left_over(spark, target):
    return sinks._beside(spark, target, "__staged_") + sinks._beside(spark, target, "__replaced_")


def test_overwrite_replaces_rows_and_schema(spark, target):
    write_overwrite(spark.range(5).selectExpr("id AS v", "'x' AS old"), target)
    write_overwrite(spark.range(3).selectExpr("id AS v"), target)
    assert values(spark, target) == [0, 1, 2] and read_back(spark, target).columns == ["v"]
    assert left_over(spark, target) == []


def test_a_job_that_fails_keeps_the_old_rows(spark, target):
    write_overwrite(spark.range(4).selectExpr("id AS v"), target)
    late = F.when(F.col("id") == 900, F.raise_error(F.lit("lost in the middle"))).otherwise(F.col("id"))
    with pytest.raises(PySparkException, match="lost in the middle"):
        write_overwrite(spark.range(0, 1000, 1, 8).select(late.alias("v")), target)
    assert values(spark, target) == [0, 1, 2, 3] and left_over(spark, target) == []


def test_a_swap_that_fails_puts_the_old_rows_back(spark, target, monkeypatch):
    write_overwrite(spark.range(2).selectExpr("id AS v"), target)
    rename, calls = sinks._rename, []

    def second_fails(spark, source, to):
        calls.append(to)
        if len(calls) == 2:
            raise OSError("no rename")
        rename(spark, source, to)

    monkeypatch.setattr(sinks, "_rename", second_fails)
    with pytest.raises(OSError, match="no rename"):
        write_overwrite(spark.range(9).selectExpr("id AS v"), target)
    monkeypatch.undo()
    assert values(spark, target) == [0, 1] and left_over(spark, target) == []


def test_a_swap_broken_off_between_its_renames_is_recovered(spark, target):
    write_overwrite(spark.range(2).selectExpr("id AS v"), target)
    sinks._rename(spark, target, f"{target}__replaced_0123")
    assert not sinks.exists(spark, target)
    recover(spark, target)
    assert values(spark, target) == [0, 1]


def test_overwrite_may_read_its_target(spark, target):
    write_overwrite(spark.range(3).selectExpr("id AS v"), target)
    write_overwrite(read_back(spark, target).selectExpr("v + 10 AS v"), target)
    assert values(spark, target) == [10, 11, 12]


def test_the_same_run_twice_leaves_its_rows_once(spark, target):
    rows = spark.range(2).selectExpr("id AS v")
    for run in ("a", "a", "b", "a"):
        write_append(rows, target, run_id=run)
    assert values(spark, target) == [0, 0, 1, 1]
    assert sorted(r[0] for r in read_back(spark, target).select("run_id").distinct().collect()) == ["a", "b"]


def test_concurrent_runs_leave_one_row_each(spark, tmp_path):
    target = str(tmp_path / "registry")
    errors = []

    def append(run):
        try:
            write_append(spark.range(1).selectExpr("id AS v"), target, run_id=run)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    write_append(spark.range(0).selectExpr("id AS v"), target, run_id="none")
    threads = [threading.Thread(target=append, args=(r,)) for r in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and values(spark, target) == [0, 0]


def test_run_ids_join_an_older_target(spark, target):
    write_append(spark.range(1).selectExpr("id AS v"), target)
    write_append(spark.range(1, 2).selectExpr("id AS v"), target, run_id="a")
    write_append(spark.range(1, 2).selectExpr("id AS v"), target, run_id="a")
    assert values(spark, target) == [0, 1]
