"""Training and scoring datasets from an AudienceConfig."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortex.config import AudienceConfig
from cohortex.operators.sampling import downsample_majority
from cohortex.plans.daily import DailyState
from cohortex.plans.features import FeatureSpec, feature_table, features_fused_many, select_spec, windows_of


def training_spec(cfg: AudienceConfig) -> FeatureSpec:
    w = cfg.windows()
    return FeatureSpec(
        start=w.lookback_start,
        end=w.lookback_end,
        rules=tuple(cfg.rules),
        tz=cfg.time_zone,
        conversion_start=w.conversion_start,
        conversion_end=w.conversion_end,
        conversion_rule=cfg.effective_conversion_rule(),
    )


def scoring_spec(cfg: AudienceConfig) -> FeatureSpec:
    w = cfg.windows()
    return FeatureSpec(start=w.scoring_start, end=w.scoring_end, rules=tuple(cfg.rules), tz=cfg.time_zone)


def labelled_features(sessions: DataFrame, cfg: AudienceConfig, form: str = "fused") -> DataFrame:
    return feature_table(sessions, training_spec(cfg), form)


def training_dataset(sessions: DataFrame, cfg: AudienceConfig, form: str = "fused") -> DataFrame:
    """Labelled features with the negatives downsampled (seeded, partition independent)."""
    return downsample_majority(labelled_features(sessions, cfg, form), cfg.downsample_majority_class, cfg.seed)


def scoring_dataset(sessions: DataFrame, cfg: AudienceConfig, form: str = "fused") -> DataFrame:
    return feature_table(sessions, scoring_spec(cfg), form)


def shared_feature_table(sessions: DataFrame, cfg: AudienceConfig) -> DataFrame:
    """Per-client aggregates of the training and the scoring spec from one scan (the
    scoring window lies inside the training scan). Materialise it, then take both
    datasets with :func:`datasets_from_shared`."""
    return features_fused_many(sessions, {"t": training_spec(cfg), "s": scoring_spec(cfg)})


def shared_from_state(sessions: DataFrame, cfg: AudienceConfig) -> DataFrame:
    """The same aggregates from the daily state, after adding the days of the windows it lacks."""
    training, scoring = training_spec(cfg), scoring_spec(cfg)
    state = DailyState(cfg.daily_state, training.rules, training.conversion_rule, cfg.time_zone)
    windows = [*windows_of(training), *windows_of(scoring)]
    state.bring_up_to_date(sessions, min(w[0] for w in windows), max(w[1] for w in windows))
    return state.merged(sessions.sparkSession, {"t": training, "s": scoring})


def datasets_from_shared(shared: DataFrame, cfg: AudienceConfig) -> tuple[DataFrame, DataFrame]:
    """(training dataset with sampled negatives, scoring dataset)."""
    labelled = select_spec(shared, training_spec(cfg), "t")
    training = downsample_majority(labelled, cfg.downsample_majority_class, cfg.seed)
    return training, select_spec(shared, scoring_spec(cfg), "s")


TEMPLATE_FILES = {"training": "training_query_template.sql", "classification": "classification_query_template.sql"}


def read_template(spark, location: str, name: str) -> str:
    """Text of ``<location>/<name>_query_template.sql`` (a small file, read whole)."""
    path = f"{location.rstrip('/')}/{TEMPLATE_FILES[name]}"
    return spark.read.text(path, wholetext=True).first()[0]


def templated_datasets(spark, sessions: DataFrame, cfg: AudienceConfig) -> tuple[DataFrame, DataFrame]:
    """(training, scoring) datasets from the user's Spark SQL templates in
    ``cfg.queries_location``. The sessions are bound as ``IDENTIFIER(:table)`` through a
    uniquely named temporary view; the window dates and options as ``:markers``."""
    import uuid

    from cohortex.sources.params import param_query

    view = f"sessions_{uuid.uuid4().hex[:12]}"
    sessions.createOrReplaceTempView(view)
    params = cfg.query_parameters(view)
    training = param_query(spark, read_template(spark, cfg.queries_location, "training"), params)
    scoring = param_query(spark, read_template(spark, cfg.queries_location, "classification"), params)
    spark.catalog.dropTempView(view)  # both plans are resolved
    return training, scoring
