"""Sources and sinks: schema, parameterised SQL, overwrite / append semantics."""

from __future__ import annotations

import json

import pytest

from cohortex.context import scratch_path
from pyspark.errors import AnalysisException

from cohortex.sources.params import param_query
from cohortex.sources.sessions import read_sessions
from cohortex.sources.sinks import exists, read_back, write_append, write_overwrite
from tests.conftest import session


def test_read_sessions_keeps_suffix_text(spark, sessions_df, tmp_path):
    df = sessions_df(session(visit_id=1, suffix="20240101"), session(visit_id=2, suffix="intraday_20240102"))
    path = str(tmp_path / "s")
    df.write.partitionBy("suffix").parquet(path)
    got = read_sessions(spark, path)
    assert dict(got.dtypes)["suffix"] == "string"
    assert sorted(r.suffix for r in got.select("suffix").collect()) == ["20240101", "intraday_20240102"]


def test_param_query_binds_and_ignores_unused(spark, sessions_df):
    df = sessions_df(session(client="a", suffix="20240101"), session(client="a", visit_id=2, suffix="20240102"),
                     session(client="b", suffix="20240301"))
    df.createOrReplaceTempView("param_sessions")
    out = param_query(spark, "client_sessions", {"table": "param_sessions", "start": "20240101", "end": "20240131",
                                                 "unused": 1, "prediction_type": "x"}).collect()
    assert [(r.clientid, r.sessions) for r in out] == [("a", 2)]
    with pytest.raises(AnalysisException, match="UNBOUND_SQL_PARAMETER"):
        param_query(spark, "client_sessions", {"table": "param_sessions"})


def test_overwrite_replaces_rows_and_schema_append_creates(spark):
    target = scratch_path(spark, "sink")
    assert not exists(spark, target)
    write_append(spark.range(3), target)
    write_append(spark.range(2), target)
    assert read_back(spark, target).count() == 5
    write_overwrite(spark.createDataFrame([("x",)], "name string"), target)
    got = read_back(spark, target)
    assert got.columns == ["name"] and got.count() == 1


def test_sharded_tables_window(spark, sessions_df):
    from cohortex.sources.sessions import read_sharded_tables, shard_suffixes

    for i, suffix in enumerate(["20240101", "20240102", "20240103", "intraday_20240104"]):
        sessions_df(session(visit_id=i, suffix=suffix)).drop("suffix").createOrReplaceTempView(f"shardtest_{suffix}")
    assert shard_suffixes(["shardtest_20240101", "other_20240101"], "shardtest_", "20240101", "20240131") == {
        "shardtest_20240101": "20240101"}
    got = read_sharded_tables(spark, "shardtest_", "20240102", "20240131")
    assert sorted(r.suffix for r in got.collect()) == ["20240102", "20240103"]
    assert got.columns[-1] == "suffix"


def test_command_line_run(spark, tmp_path):
    from cohortex.__main__ import main
    from cohortex.sources.fixtures import sessions_from_events

    src = str(tmp_path / "sessions")
    sessions_from_events(spark, "/root/testdata/sf0.001").write.partitionBy("suffix").parquet(src)
    dest = str(tmp_path / "audience")
    rules = tmp_path / "campaign.json"
    rules.write_text(json.dumps({
        "rules": [{"name": "Event01", "eventCategory": "click", "eventLabel": "other"},
                  {"name": "Event02", "eventLabel": {"contains": "PLAN"}}],
        "conversion": {"eventCategory": "purchase", "eventAction": "k3", "eventLabel": {"contains": "PLAN"}},
    }))
    main(["--source_table", src, "--destination_table", dest, "--as_of", "2024-01-30", "--rules_file", str(rules),
          "--training_windows_start_in_days", "30", "--classification_window_start_in_days", "15",
          "--downsample_majority_class", "1.0", "--max_iter", "5"])
    out = read_back(spark, dest)
    assert out.columns == ["dimension14", "dimension28"] and out.count() > 0
