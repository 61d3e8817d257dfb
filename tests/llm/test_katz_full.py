"""Operator 2 against a brute-force Katz model that keeps every bigram, those seen once too."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortex.llm import katz

from .test_learned import tokens


def full_katz(rows):
    """[(id, n_tokens, n_known, N, score)] of rows (id, text, train), with p(h, w) and the counts."""
    c1, c2 = Counter(), Counter()
    for _, text, train in rows:
        if train:
            t = tokens(text)
            c1.update(t)
            c2.update(zip(["<s>", *t[:-1]], t, strict=True))
    n = sum(c1.values())

    def discount(counts):
        types = Counter(counts.values())
        common = 6 * types[6] / types[1] if types[1] else 1.0
        d = {}
        for c in range(1, 6):
            ratio = (c + 1) * types[c + 1] / (c * types[c]) if types[c] else 1.0
            value = (ratio - common) / (1 - common) if common < 1 else 0.0
            d[c] = value if 0 < value < 1 else (c - 0.5) / c
        return lambda c: d.get(c, 1.0) * c

    kept1, kept2 = discount(c1), discount(c2)
    unknown = 1 - sum(map(kept1, c1.values())) / n
    p1 = lambda w: kept1(c1[w]) / n if c1.get(w) else unknown
    context, mass, seen = Counter(), Counter(), Counter()
    for (h, w), c in c2.items():
        context[h] += c
        mass[h] += kept2(c)
        seen[h] += p1(w)

    def p2(h, w):
        if h not in context:
            return p1(w)
        divisor = context[h] + (mass[h] > context[h] - 1e-9)
        c = c2.get((h, w), 0)
        return kept2(c) / divisor if c else (1 - mass[h] / divisor) / (1 - seen[h]) * p1(w)

    out = []
    for doc_id, text, _ in rows:
        t = tokens(text)
        out.append((doc_id, len(t), sum(w in c1 for w in t), n, sum(math.log10(p2(h, w)) for h, w in zip(["<s>", *t[:-1]], t, strict=True))))
    return out, (p2, c1, c2, context)


@pytest.mark.parametrize("block_tokens", [katz.BLOCK_TOKENS, 3000])
def test_katz_keeps_bigrams_seen_once(spark, small_docs, monkeypatch, block_tokens):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block_tokens)
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in small_docs.collect()]
    # contexts seen once, asked from another block and from the same one
    rows += [(10**9, "onceonly follows here", True), (10**9 + 1, "onceonly follows there", False), (10**9 + 2, "solitary word", True)]
    want, (p2, c1, c2, context) = full_katz(rows)
    assert 1 in c2.values()
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    got = {r.doc_id: r for r in katz.score(df.repartition(3)).collect()}
    for doc_id, n, known, total, score in want:
        r = got[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.score, score, rel_tol=1e-9)
    for h in ["onceonly", "<s>", *[*context][:: max(1, len(context) // 25)]]:
        assert math.isclose(sum(p2(h, w) for w in c1) + p2(h, "\x00unknown"), 1.0, rel_tol=1e-9)


def test_katz_full_model_on_odd_rows(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 50)
    rows = [(r.doc_id, r.text, i % 4 != 0) for i, r in enumerate(odd_docs.select("doc_id", "text").collect())]
    want, _ = full_katz(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumn("block", F.lit("clash"))
    got = katz.score(df.repartition(2)).select("doc_id", "n_tokens", "n_known", "train_tokens", "score").collect()
    shape = lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[4], 6))
    assert sorted(map(shape, got)) == sorted(map(shape, want))
