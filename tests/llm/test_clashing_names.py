"""Input columns that have the names of the operators' own helper and result columns pass through untouched."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortex.llm import exact_dedup, html_extract, mixing, near_join, toxicity

NAMES = [
    "_digest", "_k_id", "_k_h", "_k_digest", "_k_twice", "id", "digest", "row", "keep_id", "group_size", "kept", "times", "h", "part",
    "_mix_size", "_mix_source", "_mix_key", "_mix_start", "_o_source", "_rank", "_lang_pred", "_lang_score", "lang_pred", "_toxicity", "_main_text", "_html", "c0", "c3",
]


@pytest.fixture(scope="module")
def clash(odd_docs):
    """The odd rows with every name, each holding a value of its own."""
    return odd_docs.withColumns({n: F.concat(F.lit(n + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES})


def untouched(out, columns):
    assert out.columns == columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[n] == f"{n}:{'none' if r.doc_id is None else r.doc_id}" for n in NAMES)
    return rows


def test_exact_dedup(clash):
    rows = untouched(exact_dedup.deduplicate(clash), clash.columns)
    assert sorted((r.doc_id or 0) for r in rows) == [0, 2, 3, 4, 6, 7, 8, 9, 10, 11]  # 1 is empty like 2, 5 reads like 6


def test_near_join(clash):
    rows = untouched(near_join.deduplicate(clash), clash.columns)
    assert len(rows) == len({(r.doc_id, r.text) for r in rows})


def test_mixing(clash):
    rows = untouched(mixing.mix(clash), clash.columns)
    assert {r.doc_id for r in rows} >= {1, 2, 3}


def test_language_stage(spark, clash):
    rows = untouched(corpus_pipeline.language_stage(spark, clash, ""), clash.columns)
    assert not {1, 2, 3} & {r.doc_id for r in rows}


def test_toxicity(clash):
    out = toxicity.score(clash, toxicity.Model({}))
    assert out.columns == [*clash.columns, "__toxicity"]
    untouched(out.drop("__toxicity"), clash.columns)


def test_html(clash):
    out = html_extract.extract(clash.withColumn("html", F.concat(F.lit("<article><p>"), F.col("text"), F.lit("</p></article>"))))
    assert out.columns == [*clash.columns, "__main_text"]
    untouched(out.drop("__main_text"), clash.columns)


def test_exact_dedup_keeps_one_of_repeated_rows_in_any_layout(spark):
    rows = [(1, "a", 0), (1, "a", 1), (1, "a", 2), (None, "b", 3), (None, "b", 4), (2, "b", 5), (2, "b", 6), (None, "c", 7), (None, None, 8), (None, "", 9), (4, "d", 10)]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(parts)
        kept = [r.place for r in exact_dedup.deduplicate(df).collect()]
        groups = [{0, 1, 2}, {5, 6}, {7}, {8, 9}, {10}]
        assert len(kept) == 5 and all(len(g.intersection(kept)) == 1 for g in groups)


def test_mixing_spreads_rows_without_ids(spark):
    """A third of the rows without id: their keys, and so their ranges, differ by text."""
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "concat('text ', id, ' word') AS text", "'s' AS source")
    ranges = mixing.plan(df)
    assert ranges.count() == 3000
    none = spark.range(300).selectExpr("CAST(NULL AS long) AS doc_id", "concat('text ', id, ' word') AS text", "'s' AS source")
    taken = {r[0] for r in mixing.plan(none.unionByName(df)).where("doc_id IS NULL").select("_mix_epochs", "_mix_part").distinct().collect()}
    assert taken


def test_language_fit_does_not_depend_on_the_order_of_rows(spark, small_docs):
    from cohortex.llm import language_id

    # a third without id, a third under one id
    docs = small_docs.select(F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, 7).otherwise(F.col("doc_id")).alias("doc_id"), "text", "lang")
    one = language_id.fit(docs.repartition(1).sortWithinPartitions("text"), sample_rows=40)
    two = language_id.fit(docs.repartition(5).sortWithinPartitions(F.desc("text")), sample_rows=40)
    assert [p.weights.tobytes() for p in one.family_pairs] == [p.weights.tobytes() for p in two.family_pairs]
    assert one.families == two.families and one.members.keys() == two.members.keys()
