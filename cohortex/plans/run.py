"""The whole audience run (C4): train or load, score, write.

Stages and what reaches the driver:
1. training and scoring features from one fused scan -> parquet in the shared folder;
2. hash histograms per class for exact balancing and splitting (bounded, 6 small jobs);
3. MLlib fit on the training part, accuracy on both parts (one row each);
4. registry append (one row) when a registry is configured;
5. scoring dataset -> ``transform`` -> segment -> overwrite of the audience table.
No per-client row is collected.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.config import AudienceConfig
from cohortex.context import scratch_path
from cohortex.operators.export import audience
from cohortex.operators.ml import FOLDED, LABEL, FeatureLayout, accuracy, fit, predict_proba
from cohortex.operators.registry import load_verified, registry_append
from cohortex.operators.sampling import stratified_split, undersample_majority
from cohortex.plans.datasets import (
    datasets_from_shared,
    scoring_dataset,
    shared_feature_table,
    shared_from_state,
    templated_datasets,
    training_dataset,
)
from cohortex.sources.sessions import load_sessions
from cohortex.sources.sinks import read_back, write_overwrite

log = logging.getLogger("cohortex")


@dataclass
class Trained:
    model: PipelineModel
    layout: FeatureLayout
    score_train: float | None = None
    score_test: float | None = None
    registry_row: object = None


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage (the files survive a lost executor); later passes read only the columns
    and row groups they need. :func:`discard` removes the folder after use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove the folders of materialised frames that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for frame in frames for f in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def split_for_training(training: DataFrame, cfg: AudienceConfig) -> DataFrame:
    balanced = undersample_majority(training, cfg.seed)
    return stratified_split(balanced, cfg.test_size, cfg.split_seed)


def train_on(spark: SparkSession, cfg: AudienceConfig, training: DataFrame) -> Trained:
    """Balance, split, fit and evaluate on a materialised training dataset.

    The balanced and split rows (at most twice the smaller class) are written once; fitting,
    scaling and both accuracies read that table.
    """
    log.info("training starts: columns %d", len(training.columns))
    layout = FeatureLayout.of(training, exclude=cfg.exclude_columns)
    parts = materialise(split_for_training(training, cfg), "training_parts")
    counts = {(r["is_test"], r[LABEL]): r["n"] for r in parts.groupBy("is_test", LABEL).agg(F.count(F.lit(1)).alias("n")).collect()}
    log.info("balanced rows by (test, class) %s", counts)
    model = fit(parts.where(~F.col("is_test")), layout, counts={c: n for (test, c), n in counts.items() if not test},
                max_iter=cfg.max_iter, max_depth=cfg.max_depth, step_size=cfg.step_size, seed=cfg.seed)
    # accuracy of both parts in one job
    acc = {r["is_test"]: r["accuracy"] for r in accuracy(predict_proba(model, parts, layout), by=["is_test"]).collect()}
    score_train, score_test = acc.get(False), acc.get(True)
    log.info("training done: accuracy train=%s test=%s", score_train, score_test)
    row = None
    if cfg.trained_model_table:
        row = registry_append(spark, cfg.trained_model_table, model, cfg.name, score_train, score_test, cfg.model_root, cfg.run_id)
        log.info("registered model %s, digest %s", row["model_path"], row["md5"])
    discard(spark, parts)
    return Trained(model, layout, score_train, score_test, row)


def train(spark: SparkSession, cfg: AudienceConfig, sessions: DataFrame, form: str = "fused") -> Trained:
    training = materialise(training_dataset(sessions, cfg, form), "training")
    trained = train_on(spark, cfg, training)
    discard(spark, training)
    return trained


def load(spark: SparkSession, cfg: AudienceConfig) -> Trained | None:
    """The newest verified model of the registry when asked to load one."""
    if cfg.load_trained_model and cfg.trained_model_table:
        model = load_verified(spark, cfg.trained_model_table, cfg.name)
        if model is not None:
            # the layout is the one the model was fitted with (read from its stages)
            return Trained(model, layout_of(model))
    return None


def layout_of(model: PipelineModel) -> FeatureLayout:
    from pyspark.ml.feature import StringIndexerModel, VectorAssembler

    text: tuple[str, ...] = ()
    for s in model.stages:
        if isinstance(s, StringIndexerModel):
            columns = tuple(s.getInputCols()) if s.isSet("inputCols") else (s.getInputCol(),)
            text += tuple(c.removesuffix(FOLDED) for c in columns)
    numbers: tuple[str, ...] = ()
    for s in model.stages:
        if isinstance(s, VectorAssembler) and s.getOutputCol() == "_num":
            numbers = tuple(s.getInputCols())
    return FeatureLayout(text, numbers)


def run(spark: SparkSession, cfg: AudienceConfig, sessions: DataFrame | None = None, form: str = "fused") -> DataFrame:
    """Train (or load), score the recent window and return / write the audience.

    When a model is trained with the fused plan, training and scoring features come from
    one scan of the sessions: the per-client aggregates of both windows are computed
    together and materialised once. With a daily state only days that it lacks are scanned.
    """
    if sessions is None:
        if not cfg.source_table:
            raise ValueError("no sessions given and no source_table configured")
        w = cfg.windows()
        sessions = load_sessions(spark, cfg.source_table, min(w.lookback_start, w.scoring_start), w.conversion_end)
    log.info("run %s: windows %s", cfg.name, cfg.windows())
    trained, shared = load(spark, cfg), None
    if cfg.queries_location:
        training, scoring = templated_datasets(spark, sessions, cfg)
        if trained is None:
            trained = train_on(spark, cfg, materialise(training, "training"))
    elif cfg.daily_state:
        shared = materialise(shared_from_state(sessions, cfg), "features")
        training, scoring = datasets_from_shared(shared, cfg)
        trained = trained or train_on(spark, cfg, training)
    elif trained is not None:
        scoring = scoring_dataset(sessions, cfg, form)
    elif form == "fused":
        shared = materialise(shared_feature_table(sessions, cfg), "features")
        training, scoring = datasets_from_shared(shared, cfg)
        trained = train_on(spark, cfg, training)
    else:
        trained = train(spark, cfg, sessions, form)
        scoring = scoring_dataset(sessions, cfg, form)
    scored = audience(
        trained.model,
        scoring,
        trained.layout,
        cfg.medium_class_value,
        cfg.high_class_value,
        cfg.index_dimension,
        cfg.value_dimension,
    )
    if cfg.destination_table:
        write_overwrite(scored, cfg.destination_table)
        log.info("audience written to %s", cfg.destination_table)
        if shared is not None:  # the written audience no longer reads the features
            discard(spark, shared)
        return read_back(spark, cfg.destination_table)
    return scored
