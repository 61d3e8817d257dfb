"""The corpus pipeline: documents -> language ID -> exact dedup -> near-duplicate join -> mixing -> packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``; the last returns the pieces of the sequences.

Each stage defines its results for null, empty, very long and repeated texts as its operator
does (see the operators' modules): a text without a letter is rejected by the first stage,
so empty texts do not reach the others. Extra columns pass through up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.llm import exact_dedup, language_id, mixing, near_join, packing
from cohortex.llm.common import durable, fold, fresh, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents whose language cannot be told (no letter) go."""
    model = language_id.fit(docs.where(fold("doc_id", 4) != 2))
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    return language_id.predict(docs, model, pred_col=pred, score_col=score).where(F.col(pred) != language_id.UNDETERMINED).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of documents with equal texts the one with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of similar documents the one with the least doc_id stays."""
    return near_join.deduplicate(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: sources repeated or cut to their targets; a document may appear twice."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the documents' tokens placed into sequences."""
    return packing.pack(packing.tokenize(docs)).drop("loss_tokens")


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", dedup_stage),
    ("near_join", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: language ID, near-duplicate classes and packing are not expressible in SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
