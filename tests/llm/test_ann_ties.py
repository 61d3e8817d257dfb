"""Operator 6: scaled copies of a vector tie, and ties go to the smaller id however many there are."""

from __future__ import annotations

from cohortex.llm import ann


def test_ties_of_one_direction_in_many_lengths(spark):
    base = [0.3, -0.7, 0.11, 0.05]
    whole = [int(v * 100) for v in base]
    rows = [(i, [float(v * (1 + (i * 37) % 300)) for v in whole]) for i in range(300)]  # exact multiples
    rows += [(1000 + i, [1.0, float(i), 2.0, -float(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(ann.index(df), df.where("vec_id in (0, 2, 299)")).orderBy("query_id", "rank").collect()
    want = {0: [1, 2, 3, 4, 5], 2: [0, 1, 3, 4, 5], 299: [0, 1, 2, 3, 4]}
    assert {q: [r.vec_id for r in got if r.query_id == q] for q in want} == want
