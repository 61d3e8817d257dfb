"""Operators 1 and 7 and the pipeline against brute force, and their edge cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortex.llm import near_join, packing
from cohortex.llm.common import durable

from .conftest import LONG, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute_components(rows):
    """{row number: component id} by comparing every pair that shares a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j > i}:
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                parent[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(rows[i][0], len(sets[i]), least.get(find(i))) for i in range(len(rows))]


def near_rows(seed=3):
    """A group of near copies, pairs around the threshold, a passage many texts share, repeats and short texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(60):
        copy = list(base)
        for _ in range(r.randint(0, 4)):
            copy[r.randrange(len(copy))] = word()
        rows.append(" ".join(copy))
    for _ in range(40):
        rows.append(" ".join([word() for _ in range(r.randint(5, 200))] + passage + [word() for _ in range(r.randint(0, 60))]))
    for n in range(1, 12):
        rows += [" ".join(base[:n]), " ".join(base[:n]).upper()]
    rows += [None, "", " \t", rows[0], rows[1]]
    r.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("block", [near_join.BLOCK, 3])
def test_near_join_is_exact(spark, block, monkeypatch):
    monkeypatch.setattr(near_join, "BLOCK", block)
    monkeypatch.setattr(near_join.candidate_pairs, "__defaults__", (block,))
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, near_join.membership(df).collect()))
    assert got == sorted(brute_components(rows))


def test_near_join_without_star_rounds_is_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_join, "STAR_ROUNDS", 0)
    rows = near_rows(5)
    got = sorted(map(tuple, near_join.membership(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(brute_components(rows))


def test_least_shared_is_never_more_than_linked_sets_share(spark):
    r = np.random.default_rng(1)
    for _ in range(300):
        n = int(r.integers(1, 60))
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(r.integers(0, max(1, len(a) // 4 + 1)))
        b = np.unique(np.concatenate([a[drop:], r.integers(0, 2**63, int(r.integers(0, len(a) // 5 + 1)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 75 * (len(a) + len(b) - both):
            continue
        need = -(-75 * (len(a) + len(b)) // 175) - -(-75 * max(len(a), len(b)) // 100) + 1
        for order in (0, 1, 2):
            frequent = np.sort(a[:: max(1, len(a) // 3)])
            pa, pb = near_join.prefix(a, frequent, order), near_join.prefix(b, frequent, order)
            assert len(np.intersect1d(pa, pb)) >= need >= 1


def test_near_join_edges(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = sorted(map(repr, map(tuple, near_join.membership(odd_docs).collect())))
    assert got == sorted(map(repr, brute_components(rows)))
    assert near_join.deduplicate(odd_docs).columns == odd_docs.columns
    assert near_join.membership(no_docs).count() == 0 and near_join.deduplicate(no_docs).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def check_pieces(pieces, texts, tokenizer, cut=packing.SEQUENCE):
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        parts = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1])
        assert sum(p.length for p in parts) == len(ids) == parts[0].doc_tokens
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(np.asarray(ids[p.start : p.start + p.length], "<u4").tobytes())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == list(np.cumsum([0, *[p.length for p in s]])[:-1])
        assert sum(p.length for p in s) <= cut and len(s) <= packing.MAX_SEGMENTS
    return sequences


def test_packing_round_trip(spark, small_docs, tokenizer):
    pieces = packing.op1_packing(spark, SF).collect()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    sequences = check_pieces(pieces, texts, tokenizer)
    used = sum(p.length for p in pieces)
    assert used > 0.95 * packing.SEQUENCE * (len(sequences) - 1)


def test_packing_edges(spark, odd_docs, no_docs, tokenizer):
    unique = odd_docs.where("doc_id is not null and doc_id <> 6")
    pieces = packing.pack(packing.tokenize(odd_docs)).collect()
    assert sum(p.doc_id is None for p in pieces) == 1 and sum(p.doc_id == 6 for p in pieces) == 2
    check_pieces([p for p in packing.pack(packing.tokenize(unique)).collect()], {r.doc_id: r.text for r in unique.collect()}, tokenizer)
    assert packing.pack(packing.tokenize(no_docs)).count() == 0


def test_word_wise_encoding_is_the_tokenizers(tokenizer):
    enc = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    r = random.Random(4)
    letters = "abzABZ '’éÉßÿ×÷ªµ́İΣςσ\x1c\x1f\x85\xa0 ​09²½.,!?<|>s're\t\n\r\x0b\x0c中文😀ﬁ\x00\x7f"
    for _ in range(3000):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 14))) + ("<|endoftext|>" if r.random() < 0.05 else "")
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_dot_product_placement_respects_every_limit():
    r = np.random.default_rng(2)
    vectors = np.stack([r.integers(1, 50, 200), np.ones(200, int), r.integers(0, 20, 200)], axis=1)
    limits = np.array([100.0, 5.0, 30.0])
    bins, ranks = packing.place(vectors, limits)
    for b in np.unique(bins):
        assert (vectors[bins == b].sum(axis=0) <= limits).all()
        assert sorted(ranks[bins == b]) == list(range((bins == b).sum()))
    with pytest.raises(ValueError):
        packing.place(np.array([[101, 1, 0]]), limits)


def test_pipeline_against_brute_force(spark, small_docs, tokenizer):
    docs, seen = small_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, SF), f"test_{name}")
        seen[name] = docs
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    lettered = [(d, t) for d, t in rows if t and any(map(str.isalpha, t))]
    assert {r.doc_id for r in seen["language_id"].collect()} == {d for d, _ in lettered}
    last = {}
    for d, t in lettered:
        last[t] = max(d, last.get(t, d))
    assert {r.doc_id for r in seen["exact_dedup"].collect()} == set(last.values())
    left = [(d, t) for d, t in lettered if last[t] == d]
    stays = {d for d, _, c in brute_components(left) if d == c}
    assert sorted(r.doc_id for r in seen["near_join"].collect()) == sorted(stays)
    mixed = seen["mixing"].collect()
    whole = dict(left)
    counts = defaultdict(int)
    for r in mixed:
        counts[r.doc_id] += len(WORDS.findall(r.text))
        assert whole[r.doc_id].startswith(r.text)
    assert all(n <= 2 * len(WORDS.findall(whole[d])) for d, n in counts.items())
    total = sum(len(WORDS.findall(whole[d])) for d in stays)
    assert abs(sum(counts.values()) - 1.5 * total) <= 25
    pieces = seen["packing"]
    tokens = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert pieces.agg(F.sum("length")).first()[0] == tokens
    assert corpus_pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == tokens
    assert seen["mixing"].columns == small_docs.columns


def test_stages_take_odd_and_empty_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = durable(stage(spark, docs, SF), f"odd_{name}")
            if name != "packing":
                assert out.columns == docs.columns, name
            docs = out
        assert LONG
