"""Substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortex.llm import substring_dedup as sd
from tests.llm.conftest import same_rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """(id, n_words, n_removed, kept text) of each (id, text)."""
    words = [(i, WORDS.findall(t or "")) for i, t in rows]
    least: dict = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[s : s + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def got(df, **options):
    rows, (n, removed, _, digest) = sd.with_kept(df, **options)
    return sorted(repr(tuple(r)) for r in rows.select("doc_id", n, removed, digest).collect())


def made_up(seed, docs=60):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdé") * rng.randint(1, 2) for _ in range(rng.randint(3, 40))] for _ in range(4)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice("abcdé") for _ in range(rng.randint(0, 15))]
        rows.append((rng.choice([i, i, i, i // 2, None]), rng.choice([" ", "\n ", "\t"]).join(words) if rng.random() < 0.95 else None))
    return rows + rows[:3] + [(docs, "x " * 500), (docs + 1, "x " * 700), (docs + 2, " ".join("ab") * 3)]


@pytest.mark.parametrize("hot_rows", [2_000, 3, 0])
@pytest.mark.parametrize("window", [2, 7, 12])
def test_is_brute_force(spark, monkeypatch, window, hot_rows):
    monkeypatch.setattr(sd, "GROUP_BYTES", 1 << 12)
    rows = made_up(window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df, window=window, minimiser=3, hot_rows=hot_rows) == brute(rows, window)


def test_is_the_sql(spark, small_docs):
    from cohortex.llm.queries import QUERIES

    same_rows(QUERIES["op13_substring_dedup"](spark, "/root/testdata/sf0.001"), sd.SQL)
    assert small_docs.count() == 200


def test_edges_and_clashing_names(spark, odd_docs, no_docs):
    clash = odd_docs.withColumns({c: F.lit("mine") for c in ("n_words", "h", "id", "spans", "kept", "s_id", "start", "words", "key")})
    out = sd.deduplicate(clash)
    assert out.columns == clash.columns and out.count() == clash.count()
    texts = {r.doc_id: r for r in out.collect()}
    assert all(r.h == "mine" and r.spans == "mine" for r in texts.values())
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(odd_docs) == brute(rows, sd.WINDOW)
    assert texts[9].text == "tail" and texts[3].text == "   \t\n " and texts[1].text is None
    assert sd.deduplicate(no_docs).collect() == []


def test_super_kmers_cover_every_window_once():
    data = np.frombuffer(("one two three four five six seven eight nine ten " * 4 + "end").encode(), np.uint8)
    offsets = np.array([0, 60, 60, len(data)])
    words = sd.Words(data, offsets)
    text, first, last, key = sd.super_kmers(words, 6, 3)
    at = [(t, s) for t, a, b in zip(text, first, last, strict=True) for s in range(a, b + 1)]
    want = [(t, s) for t in range(3) for s in range(words.bounds[t], words.bounds[t + 1] - 5)]
    assert sorted(at) == want and len(key) < len(want)
