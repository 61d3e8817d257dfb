"""Typed run options and the date-window arithmetic (lookback, conversion, scoring)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from cohortex.functions.rules import CAMPAIGN_RULES, CONVERSION_RULE, EventRule


@dataclass(frozen=True)
class Windows:
    """Inclusive ``yyyyMMdd`` bounds of the three scan windows."""

    lookback_start: str
    lookback_end: str
    conversion_start: str
    conversion_end: str
    scoring_start: str
    scoring_end: str


def date_to_text(d: dt.date) -> str:
    return d.strftime("%Y%m%d")


def window_bounds(
    as_of: dt.date,
    training_days: int = 60,
    classification_days: int = 30,
    exclusive_lookback_end: bool = False,
) -> Windows:
    """Lookback ``[D-training, D-classification]``, conversion and scoring ``[D-classification, D]``.

    Both ends are inclusive, so day ``D-classification`` belongs to the lookback and to the
    conversion window; ``exclusive_lookback_end`` moves the lookback end one day back.
    """
    if classification_days < 0:
        raise ValueError("classification_window_start_in_days must not be negative")
    if training_days <= classification_days:
        raise ValueError("training window must start before the classification window")
    lb_start = as_of - dt.timedelta(days=training_days)
    split = as_of - dt.timedelta(days=classification_days)
    lb_end = split - dt.timedelta(days=1) if exclusive_lookback_end else split
    return Windows(
        lookback_start=date_to_text(lb_start),
        lookback_end=date_to_text(lb_end),
        conversion_start=date_to_text(split),
        conversion_end=date_to_text(as_of),
        scoring_start=date_to_text(split),
        scoring_end=date_to_text(as_of),
    )


@dataclass(frozen=True)
class AudienceConfig:
    """Options of one audience run. Defaults are the reference's option defaults."""

    name: str = "lead_scoring"
    source_table: str | None = None  # table name or parquet path of nested sessions
    destination_table: str | None = None  # table name or path of the audience
    trained_model_table: str | None = None  # table name or path of the model registry
    load_trained_model: bool = False
    prediction_type: str = "transaction"  # carried for parity, not used by any query
    # optional conversion predicate eventInfo.<type> = <value>; replaces the default rule
    event_filter_type: str | None = None
    event_filter_value: str | None = None
    test_size: float = 0.5
    downsample_majority_class: float = 0.01
    medium_class_value: float = 0.3
    high_class_value: float = 0.7
    index_dimension: str = "dimension14"
    value_dimension: str = "dimension28"
    training_windows_start_in_days: int = 60
    classification_window_start_in_days: int = 30
    # folder of Spark SQL templates (training_query_template.sql,
    # classification_query_template.sql) with bound parameters; unset: built-in plans
    queries_location: str | None = None
    # additions: fixed date instead of today, seeds, zone, model size
    as_of: dt.date | None = None
    seed: int = 42
    split_seed: int = 4
    time_zone: str = "America/Sao_Paulo"
    revenue_divisor: int = 100000
    exclude_columns: tuple[str, ...] = ("region", "operatingSystem")
    exclusive_lookback_end: bool = False
    rules: tuple[EventRule, ...] = CAMPAIGN_RULES
    conversion_rule: EventRule = CONVERSION_RULE
    max_iter: int = 100
    max_depth: int = 3
    step_size: float = 0.1
    model_root: str | None = None  # folder for saved models; default: shared work folder
    run_id: str | None = None  # names the run in the registry; a repeated run adds no second row
    daily_state: str | None = None  # folder of per-day partial features; unset: every run scans its windows

    @staticmethod
    def from_options(options: dict[str, str | None]) -> "AudienceConfig":
        """Build from text options (command line style): ``'true'`` / ``'0.5'`` / ``'60'`` /
        ``'2024-01-30'`` are converted by field type; unknown names are rejected."""
        known = {f.name: f for f in fields(AudienceConfig)}
        typed: dict = {}
        for name, text in options.items():
            if text is None:
                continue
            if name not in known:
                raise KeyError(f"unknown option {name!r}")
            default = known[name].default
            if name == "as_of":
                typed[name] = dt.date.fromisoformat(text)
            elif name == "exclude_columns":
                typed[name] = tuple(c.strip() for c in text.split(",") if c.strip())
            elif isinstance(default, bool):
                typed[name] = text.strip().lower() == "true"
            elif isinstance(default, int):
                typed[name] = int(text)
            elif isinstance(default, float):
                typed[name] = float(text)
            elif name in ("rules", "conversion_rule"):
                raise ValueError(f"{name} is set from a rules file, not a text option")
            else:
                typed[name] = text
        return AudienceConfig(**typed)

    def windows(self) -> Windows:
        return window_bounds(
            self.as_of or dt.date.today(),
            self.training_windows_start_in_days,
            self.classification_window_start_in_days,
            self.exclusive_lookback_end,
        )

    def query_parameters(self, table: str) -> dict[str, object]:
        """Parameters bound into user query templates (names of the original job)."""
        w = self.windows()
        return {
            "table": table,
            "lookback_start_date": w.lookback_start,
            "lookback_end_date": w.lookback_end,
            "conversion_window_start_date": w.conversion_start,
            "conversion_window_end_date": w.conversion_end,
            "classification_start_date": w.scoring_start,
            "classification_end_date": w.scoring_end,
            "prediction_type": self.prediction_type,
            "event_filter_type": self.event_filter_type,
            "event_filter_value": self.event_filter_value,
            "downsample_majority_class": self.downsample_majority_class,
        }

    def effective_conversion_rule(self) -> EventRule:
        """The event filter when a value is given (type ``eventCategory`` unless named), else the default rule."""
        if self.event_filter_value is not None:
            return EventRule.from_filter("y_conversions", self.event_filter_type or "eventCategory", self.event_filter_value)
        if self.event_filter_type:
            raise ValueError("event_filter_type needs event_filter_value")
        return self.conversion_rule
