"""The rule index: all rules of a hit at once, equal to each rule's own predicate."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortex.functions.rules import CAMPAIGN_RULES, FIELDS, Contains, EventRule, RuleIndex

VALUES = ["a", "A", "ab", "b%", "c_d", "", "é", None]
HITS = "h struct<eventCategory:string,eventAction:string,eventLabel:string>"
constraint = st.one_of(st.none(), st.sampled_from([v for v in VALUES if v is not None]), st.sampled_from(["a", "B", "_"]).map(Contains))
rule = st.tuples(constraint, constraint, constraint)
hit = st.tuples(*[st.sampled_from(VALUES)] * 3)


def check(spark, rules, hits):
    df = spark.createDataFrame([(h,) for h in hits], HITS)
    index = RuleIndex(rules)
    masks = index.masks(F.col("h"))
    own = [F.when(r.predicate(F.col("h")), 1).otherwise(0) for r in rules]
    same = [index.flag(r, masks) == f for r, f in zip(rules, own, strict=True)]
    assert df.where(~F.array_min(F.array(*same))).count() == 0
    session = df.agg(F.collect_list("h").alias("hits")).withColumn("m", index.matches(F.col("hits")))
    counts = session.select(*[index.count(r, F.col("m")).alias(f"r{k}") for k, r in enumerate(rules)]).first()
    want = df.agg(*[F.sum(f).alias(f"r{k}") for k, f in enumerate(own)]).first()
    assert tuple(counts) == tuple(want)
    return session


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rules=st.lists(rule, min_size=1, max_size=12), hits=st.lists(hit, min_size=1, max_size=12))
def test_index_equals_predicates(spark, rules, hits):
    check(spark, [EventRule(f"r{k}", *c) for k, c in enumerate(rules)], hits)


@pytest.mark.parametrize("n", [63, 64, 130])
def test_more_rules_than_bits(spark, n):
    rules = [EventRule(f"r{k}", eventCategory=f"c{k}") for k in range(n - 1)] + [EventRule("last", eventLabel=Contains("X"))]
    assert RuleIndex(rules).words == -(-n // 63)
    check(spark, rules, [("c0", None, "x"), ("c62", "", None), ("c63", None, "ax"), (f"c{n - 2}", None, None)] * 2)


def test_null_hits_and_equal_rules(spark):
    index = RuleIndex([EventRule("one", "a"), EventRule("two", "a"), EventRule("all")])
    assert len(index.places) == 2
    df = spark.createDataFrame([(None,), ([],), ([("a", None, None), None],)], f"hits array<{HITS[2:]}>")
    got = df.select(index.count(EventRule("two", "a"), index.matches(F.col("hits"))).alias("a"), index.count(EventRule("all"), index.matches(F.col("hits"))).alias("n"))
    assert [tuple(r) for r in got.collect()] == [(None, None), (0, 0), (1, 2)]


def test_hits_are_passed_once(spark):
    """One transform over the hits, however many rules; the counts read the matches."""
    df = spark.createDataFrame([], f"hits array<{HITS[2:]}>")
    index = RuleIndex(CAMPAIGN_RULES)
    out = df.withColumn("m", index.matches(F.col("hits"))).select(*[index.count(r, F.col("m")).alias(r.name) for r in CAMPAIGN_RULES])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("transform(") == 1 and len(FIELDS) == 3
