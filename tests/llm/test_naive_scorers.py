"""Operators 3 and 10 against plain scorers: clauses without machines, n-grams counted one by one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from cohortex.llm import language_id, toxicity


def naive_toxicity(model, text):
    """Every hit of every clause by looking at the words around it."""
    entries, sums = model.entries, Counter()
    for clause in re.split(r"[.!?;\n]", (text or "").lower()):
        words = toxicity.WORD.findall(clause)
        special = [w in toxicity.TARGETS or w in toxicity.NEGATIONS or w in toxicity.REPORTS for w in words]
        for i, w in enumerate(words):
            found = [e for e in entries if w.startswith(e)]
            if special[i] or not found:
                continue
            kind, weight = entries[max(found, key=len)]
            near = words[max(0, i - toxicity.TARGET_SPAN) : i] + words[i + 1 : i + 1 + toxicity.TARGET_SPAN]
            directed = any(x in toxicity.TARGETS for x in near)
            negated = any(x in toxicity.NEGATIONS for x in words[max(0, i - toxicity.NEGATION_SPAN) : i])
            reported = any(x in toxicity.REPORTS for x in words[:i])
            sums[kind, int(directed), int(negated), int(reported)] += weight
    z = model.bias + sum(w * math.log1p(sums[k]) for k, w in zip(toxicity.KINDS, model.weights, strict=True))
    return 1 / (1 + math.exp(-z))


def test_toxicity_is_the_naive_clause_scorer():
    r = random.Random(4)
    model = toxicity.Model({w: (toxicity.INSULT, 0.8) for w in toxicity.INSULTS} | {w: (toxicity.THREAT, 0.6) for w in toxicity.THREATS} | {"scumb": (toxicity.INSULT, 1.0)})
    model.weights = np.array([0.3 + 0.1 * i for i in range(len(toxicity.KINDS))])
    pool = toxicity.INSULTS[:6] + toxicity.THREATS[:4] + toxicity.TARGETS[:5] + toxicity.NEGATIONS[:3] + toxicity.REPORTS[:3] + ["scumbag", "idiots", "the", "house", "l'idiot", "3idiot", "unkilled", "KILL"] * 3
    texts = [" ".join(r.choice(pool) + r.choice(["", "", "", ".", "!", "\n", ";", ","]) for _ in range(r.randint(0, 40))) for _ in range(300)] + [None, "", "..."]
    got = model.prepare().scores(texts)
    want = [naive_toxicity(model, t) for t in texts]
    assert max(abs(a - b) for a, b in zip(got, want, strict=True)) < 1e-12
    assert len({round(w, 6) for w in want}) > 150


def naive_features(text):
    raw = (" " + " ".join(text.lower().split()) + " ").encode("utf-8", "replace")
    counts = Counter()
    for n in language_id.ORDERS:
        for i in range(len(raw) - n + 1):
            code = int.from_bytes(raw[i : i + n], "big") % 2**32
            counts[((code + n) * 2654435761 % 2**32) >> 20] += 1
    total = sum(counts.values())
    return {k: math.sqrt(c / total) for k, c in counts.items()}


def naive_probabilities(x, names, pairs):
    """Each class by its duels: the normalised product of the pairwise probabilities."""
    logs = dict.fromkeys(names, 0.0)
    for p in pairs:
        margin = sum(v * float(p.weights[k]) for k, v in x.items()) + p.bias
        first = min(max(1 / (1 + math.exp(-max(-30, min(30, p.slope * margin + p.shift)))), 1e-12), 1 - 1e-12)
        logs[p.first] += math.log(first)
        logs[p.second] += math.log(1 - first)
    scale = 2 / len(names) if len(names) > 2 else 1
    raw = {n: math.exp(scale * (v - max(logs.values()))) for n, v in logs.items()}
    return {n: v / sum(raw.values()) for n, v in raw.items()}


def test_language_is_the_naive_scorer(spark, small_docs):
    model = language_id.fit(small_docs, sample_rows=80)
    assert len(model.families) >= 2 and any(len(m[0]) > 1 for m in model.members.values())
    texts = [t[:1500] for (t,) in small_docs.select("text").limit(60).collect()] + ["x", "ÄÖ", "été", "123", "", None]
    langs, scores = model.predict(texts)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        if not language_id.has_letter(text):
            assert (lang, score) == (language_id.UNDETERMINED, 0.0)
            continue
        x = naive_features(text)
        family = naive_probabilities(x, model.families, model.family_pairs)
        top = max(family, key=family.get)
        within = naive_probabilities(x, *model.members[top])
        best = max(within, key=within.get)
        assert abs(family[top] * within[best] - score) < 1e-3
        assert lang == best or abs(sorted(within.values())[-1] - sorted(within.values())[-2]) < 1e-3
