"""A fitted model as relations: its trees as a node table, its features as columns (M8).

``node_table`` exports the boosted trees of a saved model: one row per node with the vector slot
and threshold (or categories) it tests, its children, and its value. ``walk`` evaluates them by joins, one per
level, without the model object, and so proves the probabilities of ``predict_proba``;
``probability_sql`` writes the whole model, feature coding included, as one SQL expression over
the feature columns that any engine can run.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScalerModel, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.context import scratch_path
from cohortex.operators.ml import FOLDED, NULL_CATEGORY, OTHER_CATEGORY, FeatureLayout

#: a row goes left if its slot is at most the threshold or, where categories are given, one of them
NODES = "tree int, node int, slot int, threshold double, categories array<double>, left int, right int, value double, weight double"


def _classifier_folder(spark: SparkSession, path: str) -> str:
    """The folder of the last stage of a saved pipeline."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(context._jsc.hadoopConfiguration())
    stages = [s.getPath().toString() for s in fs.listStatus(hadoop(f"{path}/stages"))]
    return max(stages, key=lambda s: int(s.rsplit("/", 1)[1].split("_")[0]))


def node_table(spark: SparkSession, model: PipelineModel | str) -> DataFrame:
    """The nodes (``NODES``) of a fitted pipeline's trees, or of one saved at a path."""
    if isinstance(model, str):
        path = model
    else:
        path = scratch_path(spark, "tree_nodes")
        model.write().save(path)
    folder = _classifier_folder(spark, path)
    # by position: the names differ between Spark versions
    weights = spark.read.parquet(f"{folder}/treesMetadata").toDF("treeID", "metadata", "weights").drop("metadata")
    node = F.col("nodeData")
    leaf, nominal = node["leftChild"] < 0, node["split"]["numCategories"] > 0

    def inner(c: Column) -> Column:
        return F.when(~leaf, c)

    return (
        spark.read.parquet(f"{folder}/data").toDF("treeID", "nodeData")
        .join(weights, "treeID")
        .select(
            F.col("treeID").cast("int").alias("tree"),
            node["id"].cast("int").alias("node"),
            inner(node["split"]["featureIndex"]).cast("int").alias("slot"),
            inner(F.when(~nominal, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)))).alias("threshold"),
            inner(F.when(nominal, node["split"]["leftCategoriesOrThreshold"])).alias("categories"),
            inner(node["leftChild"]).cast("int").alias("left"),
            inner(node["rightChild"]).cast("int").alias("right"),
            node["prediction"].cast("double").alias("value"),
            F.col("weights").cast("double").alias("weight"),
        )
    )


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def walk(rows: DataFrame, nodes: DataFrame, key: str, features: str, depth: int) -> DataFrame:
    """(key, prob): every row of ``rows`` through every tree; ``features`` is an array of doubles.

    ``nodes`` has at most trees * 2^(depth + 1) rows, whatever the data, and is broadcast; rows
    are not shuffled until each has one partial sum per task.
    """
    trees = nodes.agg(F.max("tree")).first()[0] + 1
    small = F.broadcast(nodes.select("tree", "node", "slot", "threshold", "categories", "left", "right"))
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    at = rows.select(key, features, every.alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        x = F.get(F.col(features), F.col("slot"))
        goes_left = F.coalesce(x <= F.col("threshold"), F.array_contains("categories", x))
        step = F.when(F.col("left").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(small, ["tree", "node"]).select(key, features, "tree", step.alias("node"))
    reached = at.join(F.broadcast(nodes.select("tree", "node", "value", "weight")), ["tree", "node"])
    return reached.groupBy(key).agg(logistic(F.sum(F.col("value") * F.col("weight"))).alias("prob"))


def feature_arrays(model: PipelineModel, df: DataFrame, layout: FeatureLayout, key: str) -> DataFrame:
    """(key, features): the vectors the trees were fitted on, from the stages before the classifier."""
    coded = PipelineModel(model.stages[:-1]).transform(layout.prepare(df))
    return coded.select(key, vector_to_array("features").alias("features"))


def walked_probability(spark: SparkSession, model: PipelineModel, df: DataFrame, layout: FeatureLayout, key: str, path: str | None = None) -> DataFrame:
    """(key, prob) of the model's trees, evaluated by joins; of the copy saved at ``path`` if given."""
    depth = model.stages[-1].getMaxDepth()
    return walk(feature_arrays(model, df, layout, key), node_table(spark, path or model), key, "features", depth)


def slot_expressions(model: PipelineModel, layout: FeatureLayout) -> list[str]:
    """SQL of every slot of the feature vector over the feature columns."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    slots: list[str] = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for column, labels in zip(stage.getInputCols(), stage.labelsArray, strict=True):
                if column.endswith(FOLDED):  # one slot that holds the category's code
                    own, rest = column.removesuffix(FOLDED), float(labels.index(OTHER_CATEGORY) if OTHER_CATEGORY in labels else len(labels))
                    codes = " ".join(f"WHEN {text(v)} THEN {float(i)}" for i, v in enumerate(labels) if v != OTHER_CATEGORY)
                    slots.append(f"CASE COALESCE({own}, {text(NULL_CATEGORY)}) {codes} ELSE {rest} END")
                    continue
                slots += [f"CASE WHEN COALESCE({column}, {text(NULL_CATEGORY)}) = {text(v)} THEN 1.0 ELSE 0.0 END" for v in labels]
    mean = std = factor = None
    for stage in model.stages:
        if isinstance(stage, StandardScalerModel):
            mean, std = stage.mean.toArray(), stage.std.toArray()
        elif isinstance(stage, ElementwiseProduct):
            factor = stage.getScalingVec().toArray()
        elif isinstance(stage, VectorAssembler) and stage.getOutputCol() == "_num" and tuple(stage.getInputCols()) != layout.numbers:
            raise ValueError("the model's numeric columns are not those of the layout")
    for i, column in enumerate(layout.numbers):
        scale = float(factor[i] / std[i]) if std[i] else 0.0
        slots.append(f"(CAST(COALESCE({column}, 0) AS DOUBLE) - CAST({float(mean[i])!r} AS DOUBLE)) * CAST({scale!r} AS DOUBLE)")
    return slots


def probability_sql(nodes: DataFrame, slots: list[str]) -> str:
    """The model as one SQL expression over the feature columns.

    The driver reads the node table: at most trees * 2^(depth + 1) small rows.
    """
    known = {(r["tree"], r["node"]): r for r in nodes.collect()}

    def value(tree: int, node: int) -> str:
        r = known[tree, node]
        if r["left"] is None:
            return f"CAST({r['value'] * r['weight']!r} AS DOUBLE)"
        if r["categories"] is None:
            test = f"{slots[r['slot']]} <= CAST({r['threshold']!r} AS DOUBLE)"
        else:
            test = f"{slots[r['slot']]} IN ({', '.join(map(repr, r['categories']))})"
        return f"CASE WHEN {test} THEN {value(tree, r['left'])} ELSE {value(tree, r['right'])} END"

    margin = " + ".join(value(tree, 0) for tree in sorted({t for t, _ in known}))
    return f"1.0 / (1.0 + EXP(-2.0 * ({margin})))"
