"""Exact dedup by a heavy-hitter split (DataFrame and SQL functions only).

1. One slim row per document: id, a row number, SHA-256 of the text. It is written to the
   shared folder once, so the texts are read once.
2. A frequent-items sketch (the Misra-Gries family; at most ``capacity`` counters, error at
   most 3.5 * rows / capacity) is built per input part, merged in two levels, and asked for
   its ``winners`` most frequent digests.
3. The winners are verified: an exact map-side combined count and maximum id. They are at
   most ``winners`` rows, so they are broadcast and their rows are answered map-side,
   without a shuffle, however large the group of copies is.
4. All other digests have few rows each; they are grouped and joined by ordinary shuffles.

Defined results: a null text counts as the empty text. Of equal texts the row with the
largest id stays; a null id is smaller than any other. Repeated rows (same id, same text)
are one group and exactly one of them stays. An empty table gives an empty result. Columns
besides id and text are not read by ``membership`` and are kept untouched by ``deduplicate``,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.llm.common import durable, positional, table, text_of

CAPACITY = 4096
WINNERS = 1024
LEVEL_ONE_GROUPS = 64


def frequent_digests(slim: DataFrame, capacity: int = CAPACITY, winners: int = WINNERS) -> DataFrame:
    """At most ``winners`` digests; holds every one with over 3.5 * rows / capacity rows."""
    states = slim.groupBy(F.pmod(F.spark_partition_id(), F.lit(LEVEL_ONE_GROUPS)).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate(digest, {capacity})").alias("state")
    )
    # one group rather than a global aggregate: an empty part then has no state to merge
    top = states.groupBy(F.lit(1).alias("one")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(state, {capacity}), {winners})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest")).where("digest is not null")


def membership(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, winners: int = WINNERS
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    slim = durable(
        df.select(
            F.col(id_col).alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.sha2(text_of(text_col).cast("binary"), 256).alias("digest"),
        ),
        "dedup_digests",
    )
    per_digest = [F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("keep")]
    candidates = frequent_digests(slim, capacity, winners)
    verified = durable(
        slim.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*per_digest).where("group_size > 1"),
        "dedup_winners",
    )
    hot = slim.join(F.broadcast(verified), "digest")
    rest = slim.join(F.broadcast(verified.select("digest")), "digest", "left_anti")
    cold = rest.join(rest.groupBy("digest").agg(*per_digest), "digest")
    return hot.unionByName(cold).select(
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with their own columns.

    Texts meet only the slim list of (id, digest) that go or repeat, in one join.
    """
    rows, name = positional(df)
    own_id, digest = F.col(name[id_col]), F.sha2(text_of(name[text_col]).cast("binary"), 256)
    members = membership(rows, name[id_col], name[text_col]).where("group_size > 1").withColumnRenamed(name[id_col], "id")
    named = members.groupBy("id", "keep_id", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    listed = durable(named.where(~stays | (F.col("times") > 1)).select("id", "text_sha256", stays.alias("stays")), "dedup_listed")
    same = own_id.eqNullSafe(F.col("id")) & (digest == F.col("text_sha256"))
    kept = rows.join(listed, same, "left_anti")
    twice = listed.where("stays")  # rows that repeat both id and text: one of them stays
    if not twice.isEmpty():
        kept = kept.unionByName(rows.join(twice, same).dropDuplicates(["id", "text_sha256"]).select(*rows.columns))
    return kept.toDF(*df.columns)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
FROM d JOIN g ON d.body = g.body
"""
