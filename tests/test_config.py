"""Options as text, rule sets as data, the command-line parser."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from cohortex.__main__ import parse
from cohortex.config import AudienceConfig
from cohortex.functions.rules import CAMPAIGN_RULES, Contains, rules_from_json


def test_defaults_are_the_original_option_defaults():
    c = AudienceConfig()
    assert (c.name, c.load_trained_model, c.test_size, c.downsample_majority_class) == ("lead_scoring", False, 0.5, 0.01)
    assert (c.medium_class_value, c.high_class_value) == (0.3, 0.7)
    assert (c.index_dimension, c.value_dimension) == ("dimension14", "dimension28")
    assert (c.training_windows_start_in_days, c.classification_window_start_in_days) == (60, 30)
    assert c.rules == CAMPAIGN_RULES


def test_all_original_options_accepted():
    names = ["name", "source_table", "destination_table", "trained_model_table", "load_trained_model",
             "prediction_type", "event_filter_type", "event_filter_value", "test_size", "downsample_majority_class",
             "medium_class_value", "high_class_value", "index_dimension", "value_dimension",
             "training_windows_start_in_days", "classification_window_start_in_days", "queries_location"]
    values = {"load_trained_model": "false", "test_size": "0.5", "downsample_majority_class": "0.01",
              "medium_class_value": "0.3", "high_class_value": "0.7", "training_windows_start_in_days": "60",
              "classification_window_start_in_days": "30"}
    cfg = AudienceConfig.from_options({n: values.get(n, "x") for n in names})
    assert cfg.event_filter_type == "x" and cfg.queries_location == "x"


def test_from_options_converts_text():
    c = AudienceConfig.from_options({
        "load_trained_model": "true", "test_size": "0.25", "training_windows_start_in_days": "45",
        "as_of": "2024-01-30", "exclude_columns": "region, city", "source_table": "s", "prediction_type": None,
    })
    assert c.load_trained_model is True and c.test_size == 0.25 and c.training_windows_start_in_days == 45
    assert c.as_of == dt.date(2024, 1, 30) and c.exclude_columns == ("region", "city") and c.source_table == "s"
    assert AudienceConfig.from_options({"load_trained_model": "false"}).load_trained_model is False
    with pytest.raises(KeyError):
        AudienceConfig.from_options({"no_such_option": "1"})


def test_rules_from_json():
    doc = {"rules": [{"name": "E1", "eventCategory": "a", "eventLabel": {"contains": "x"}}],
           "conversion": {"eventAction": "buy"}}
    rules, conv = rules_from_json(json.dumps(doc))
    assert rules[0].eventLabel == Contains("x") and rules[0].eventAction is None
    assert conv.name == "y_conversions" and conv.eventAction == "buy"
    with pytest.raises(ValueError):
        rules_from_json(json.dumps({"rules": [{"name": "E", "colour": "red"}]}))


def test_command_line_parser():
    cfg, rules_file = parse(["--source_table", "/d/s", "--destination_table", "aud", "--load_trained_model", "true",
                             "--rules_file", "/d/r.json"])
    assert cfg.source_table == "/d/s" and cfg.load_trained_model and rules_file == "/d/r.json"


def test_invalid_windows_are_rejected():
    from cohortex.config import window_bounds
    from cohortex.functions.rules import EventRule
    from cohortex.plans.features import FeatureSpec

    with pytest.raises(ValueError):
        window_bounds(dt.date(2024, 1, 30), 10, 30)
    with pytest.raises(ValueError):
        window_bounds(dt.date(2024, 1, 30), 10, -1)
    with pytest.raises(ValueError):
        FeatureSpec("20240110", "20240101", ())
    with pytest.raises(ValueError):
        FeatureSpec("20240101", "20240110", (), conversion_rule=EventRule("y", eventCategory="x"))
