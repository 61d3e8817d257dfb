"""Daily state: merged days equal the full scan; a new day reads only itself."""

from __future__ import annotations

from dataclasses import replace

import pytest

from cohortex.catalog.setup import FIXTURE
from cohortex.plans.daily import DailyState, days_between
from cohortex.plans.datasets import datasets_from_shared, scoring_dataset, scoring_spec, shared_from_state, training_dataset, training_spec
from cohortex.plans.features import feature_table
from cohortex.sources.fixtures import sessions_from_events
from cohortex.sources.sessions import read_sessions
from tests.test_features import edge_sessions, rows, spec


def state_of(spec, root):
    return DailyState(str(root), spec.rules, spec.conversion_rule, spec.tz)


def test_state_equals_scan_on_edge_cases(spark, sessions_df, tmp_path):
    s = spec(True)
    state = state_of(s, tmp_path)
    df = edge_sessions(sessions_df)
    state.bring_up_to_date(df, "20240101", "20240110")
    assert state.bring_up_to_date(df, "20240101", "20240130") == days_between("20240111", "20240130")
    got, want = state.features(spark, s), feature_table(df, s, "literal")
    assert got.columns == want.columns and rows(got, *got.columns) == rows(want, *want.columns)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sessions") / "s")
    sessions_from_events(spark, "/root/testdata/sf0.001").write.partitionBy("suffix").parquet(path)
    return read_sessions(spark, path)


def test_a_sliding_window_reads_one_new_day(spark, table, tmp_path):
    first = training_spec(FIXTURE)
    state = state_of(first, tmp_path)
    state.bring_up_to_date(table, first.start, "20240129")
    read = table.where("suffix = '20240130'")
    # the next day's run is given nothing but the new day's sessions
    assert state.bring_up_to_date(read, first.start, "20240130") == ["20240130"]
    got, want = state.features(spark, first), feature_table(table, first)
    assert rows(got, *got.columns) == rows(want, *want.columns)
    plan = state.of(table, "20240130", "20240130")._jdf.queryExecution().executedPlan().toString()
    assert "20240130" in plan and "PartitionFilters" in plan
    scan = state.features(spark, first)._jdf.queryExecution().executedPlan().toString().split("FileScan", 1)[1]
    assert "eventInfo" not in scan and str(tmp_path) in scan  # no hits: the stored days only


def test_repeating_a_day_changes_nothing(spark, table, tmp_path):
    s = training_spec(FIXTURE)
    state = state_of(s, tmp_path)
    state.add(table, s.start, "20240130")
    before = rows(state.features(spark, s), "*")
    state.add(table, "20240110", "20240112")
    assert rows(state.features(spark, s), "*") == before


def test_both_datasets_of_a_run(spark, table, tmp_path):
    cfg = replace(FIXTURE, daily_state=str(tmp_path))
    training, scoring = datasets_from_shared(shared_from_state(table, cfg), cfg)
    for got, want in ((training, training_dataset(table, FIXTURE)), (scoring, scoring_dataset(table, FIXTURE))):
        assert rows(got, *got.columns) == rows(want, *want.columns)


def test_other_rules_do_not_meet_the_state(spark, table, tmp_path):
    s = training_spec(FIXTURE)
    state = state_of(s, tmp_path)
    state.add(table, "20240129", "20240130")
    other = replace(s, rules=s.rules[:2])
    assert state_of(other, tmp_path).stored_days(spark) == set()
    with pytest.raises(ValueError, match="not those of the state"):
        state.features(spark, other)
    assert scoring_spec(FIXTURE).rules == s.rules


def test_days_between():
    assert days_between("20231230", "20240102") == ["20231230", "20231231", "20240101", "20240102"]
