"""Learning operators on MLlib.

The fitted object is a ``PipelineModel``: per text column a ``StringIndexer`` (nulls folded
into a literal category first) and a ``OneHotEncoder`` (unseen values become the zero
vector), numeric columns assembled and standardised, then a gradient-boosted tree
classifier. Fitting runs as MLlib jobs on the executors; only model metadata (category
dictionaries, scaler moments, trees) reaches the driver. Scoring is a narrow
``transform``.

A text column of very many values (a city, a referrer) is *wide*: a one-hot slot, a dictionary
entry at the driver and a histogram for each value would grow with the data. Its most frequent
values are kept, the rest is folded into one, and the column enters the trees as a single
categorical slot whose splits MLlib orders by the target's rate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_CATEGORY = "__null__"
LABEL = "y_conversions"
KEY = "clientid"
OTHER_CATEGORY = "__other__"
FOLDED = "__folded"  # suffix of a wide column after folding
WIDE_FROM = 256  # distinct values (estimated) from which a text column is wide
WIDE_KEPT = 250  # values of a wide column that keep a category of their own
SKETCH_ITEMS = 16_384  # counters of the frequent-items sketch that proposes them
LEAST_BINS = 32  # of the trees; a wide column needs one for each category


def select_by_dtype(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(text columns, numeric columns) of ``df`` in schema order; booleans are neither."""
    text, numbers = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            text.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            numbers.append(f.name)
    return text, numbers


def fold_nulls(df: DataFrame, text: Sequence[str]) -> DataFrame:
    """Null text becomes its own category (otherwise it would share the unknown slot)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(NULL_CATEGORY)) for c in text})


def fill_numeric(df: DataFrame, numbers: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers})


def category_indexers(text: Sequence[str]) -> list[StringIndexer]:
    """Codes by descending frequency, ties alphabetical; unseen values get the extra slot.

    One multi-column indexer: all dictionaries come from a single pass."""
    return [StringIndexer(inputCols=list(text), outputCols=[f"{c}_idx" for c in text], handleInvalid="keep")]


def one_hot_encoder(text: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in text], outputCols=[f"{c}_vec" for c in text], dropLast=True
    )


def wide_columns(df: DataFrame, text: Sequence[str], wide_from: int = WIDE_FROM) -> list[str]:
    """The text columns with more than ``wide_from`` values, by one pass of distinct-count sketches."""
    if not text:
        return []
    found = df.agg(*[F.approx_count_distinct(F.col(c), 0.02).alias(c) for c in text]).first()
    return [c for c in text if found[c] > wide_from]


def frequent_values(df: DataFrame, column: str, kept: int = WIDE_KEPT) -> list[str]:
    """The ``kept`` most frequent values of a column, ties alphabetical.

    A sketch of bounded size proposes four times as many; their exact counts, combined before the
    shuffle, decide. At most ``kept`` values reach the driver.
    """
    proposed = df.agg(F.expr(f"approx_top_k(`{column}`, {4 * kept}, {SKETCH_ITEMS})").alias("top"))
    candidates = proposed.select(F.explode("top").alias("t")).select(F.col("t.item").alias(column)).where(F.col(column).isNotNull())
    counted = df.select(column).join(F.broadcast(candidates), column, "left_semi").groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return [r[0] for r in counted.orderBy(F.col("_n").desc(), column).limit(kept).collect()]


def fold_rare(column: str, values: Sequence[str]) -> SQLTransformer:
    """Values of a wide column outside ``values`` become one category (a stage that is saved with the model)."""
    listed = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return SQLTransformer(statement=f"SELECT *, CASE WHEN `{column}` IN ({listed}) THEN `{column}` ELSE '{OTHER_CATEGORY}' END AS `{column}{FOLDED}` FROM __THIS__")


@dataclass(frozen=True)
class FeatureLayout:
    text: tuple[str, ...]
    numbers: tuple[str, ...]

    @staticmethod
    def of(df: DataFrame, exclude: Sequence[str] = ()) -> "FeatureLayout":
        text, numbers = select_by_dtype(df, [KEY, LABEL, *exclude])
        return FeatureLayout(tuple(text), tuple(numbers))

    def prepare(self, df: DataFrame) -> DataFrame:
        """Null folding for text, double + zero-fill for numerics (as the stages expect)."""
        return fill_numeric(fold_nulls(df, self.text), self.numbers)


def feature_stages(layout: FeatureLayout, rows: int, wide: dict[str, list[str]] | None = None) -> list:
    """Indexers, one-hot encoder, numeric assembler, scaler, final assembler (M3-M5).

    ``wide``: the kept values of the wide columns; these are indexed but not one-hot encoded.

    MLlib's scaler divides by the sample deviation; with the number of training ``rows``
    known the product with sqrt(n / (n - 1)) makes it the population deviation.
    """
    stages: list = []
    parts: list[str] = []
    wide = wide or {}
    narrow = [c for c in layout.text if c not in wide]
    folded = [f"{c}{FOLDED}" for c in layout.text if c in wide]
    stages += [fold_rare(c, wide[c]) for c in layout.text if c in wide]
    if layout.text:
        stages += category_indexers([*narrow, *folded])
    if narrow:
        stages.append(one_hot_encoder(narrow))
        parts += [f"{c}_vec" for c in narrow]
    parts += [f"{c}_idx" for c in folded]
    if layout.numbers:
        stages.append(VectorAssembler(inputCols=list(layout.numbers), outputCol="_num"))
        stages.append(StandardScaler(inputCol="_num", outputCol="_num_sample", withMean=True, withStd=True))
        factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
        stages.append(
            ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(layout.numbers)), inputCol="_num_sample", outputCol="_num_scaled")
        )
        parts.append("_num_scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def classifier(max_iter: int = 100, max_depth: int = 3, step_size: float = 0.1, seed: int = 42, max_bins: int = LEAST_BINS) -> GBTClassifier:
    """Boosted trees, log loss; ``checkpointInterval`` cuts the lineage of long fits when the
    session has a checkpoint dir."""
    return GBTClassifier(
        labelCol=LABEL,
        featuresCol="features",
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step_size,
        lossType="logistic",
        seed=seed,
        maxBins=max_bins,
        checkpointInterval=10,
    )


def fit(df: DataFrame, layout: FeatureLayout, counts: dict | None = None, **params) -> PipelineModel:
    """Fit the pipeline; ``counts`` (rows by class) saves the counting job where they are known."""
    if counts is None:
        counts = {r[0]: r[1] for r in df.groupBy(LABEL).count().collect()}
    if len([c for c, n in counts.items() if n > 0]) < 2:
        raise ValueError(f"training rows have one class only: {counts}")
    prepared = layout.prepare(df)
    wide = {c: frequent_values(prepared, c) for c in wide_columns(prepared, layout.text)}
    bins = max([LEAST_BINS, *[len(v) + 2 for v in wide.values()]])  # the kept, the folded and the unseen
    stages = [*feature_stages(layout, sum(counts.values()), wide), classifier(max_bins=bins, **params)]
    return Pipeline(stages=stages).fit(prepared)


def predict_proba(model: PipelineModel, df: DataFrame, layout: FeatureLayout) -> DataFrame:
    """Adds ``prob``: probability of the positive class (M8)."""
    scored = model.transform(layout.prepare(df))
    return scored.withColumn("prob", vector_to_array("probability").getItem(1))


def accuracy(df: DataFrame, label: str = LABEL, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Fraction of rows whose prediction equals the label (M7): one row (per ``by`` group)."""
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("int")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))
