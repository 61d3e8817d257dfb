"""Operator 7 on null and repeated ids: one representative row per node, one row left per group."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from cohortex.llm import near_join
from cohortex.llm.common import durable

from .test_near_and_packing import brute_components, near_rows

IDS = "doc_id long, text string"


def shared_id_rows():
    """A third of the rows without id, a third under one id, all with different texts; one row five times."""
    texts = [t for _, t in near_rows(8)]
    ids = [(None, 5, 100 + i)[i % 3] for i in range(len(texts))]
    return [*zip(ids, texts, strict=True), *[(77, "the very same row under the same id again")] * 5]


def test_a_node_is_read_from_one_row(spark):
    rows = shared_id_rows()
    df = spark.createDataFrame(rows, IDS).repartition(3)
    docs = df.withColumn("h", F.xxhash64("text"))
    named = docs.where("text is not null").groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("doc_id").alias("doc"), "h", F.xxhash64("doc_id", "h").alias("d1"), F.col("h").alias("d2"), (F.col("n") > 1).alias("twice"), F.monotonically_increasing_id().alias("node")
    )
    nodes = durable(named, "test_named")
    read = near_join._with_sets(docs, nodes, near_join.WIDTH, "node long", lambda rows: _nodes(rows)).groupBy("node").count().collect()
    assert len(read) == nodes.count() and {r["count"] for r in read} == {1}


def _nodes(rows):
    out = [int(node[i]) for i, _, _, _, (node,) in rows]
    yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["node"])


def test_null_and_shared_ids_are_exact(spark):
    rows = shared_id_rows()
    got = near_join.membership(spark.createDataFrame(rows, IDS).repartition(3)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_components(rows)))


def test_one_row_of_each_group_stays(spark):
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in (3, 20, 40)]
    far = [" ".join(f"{c}{i}" for i in range(20)) for c in "xyz"]
    rows = [
        *[(7, t) for t in near],  # near copies under one id
        (9, far[0]), (9, far[0]), (9, far[1]),  # a repeated row, and another text under its id
        (None, far[2]), (None, far[2]), (None, far[2] + " tail"),  # a group without ids
        (None, " ".join(base)),  # null, linked with the group of id 7
        (None, ""), (None, None), (3, " "), (3, " "),  # texts without words all stay
    ]
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], IDS + ", place int").repartition(3)
    kept = sorted(r.place for r in near_join.deduplicate(df).collect())
    groups = [{0, 1, 2, 9}, {3, 4}, {5}, {6, 7, 8}, {10}, {11}, {12}, {13}]
    assert [len(g.intersection(kept)) for g in groups] == [1] * len(groups) and 9 not in kept
