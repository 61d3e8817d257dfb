"""Operators 2, 3, 5, 6 and 10: brute force, exact texts, recall and held-out accuracy."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortex.llm import ann, html_extract, katz, language_id, toxicity

from .conftest import SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)})), None]


def brute_katz(rows):
    """{(id, text): (n_tokens, n_known, N, base, score)} of rows (id, text, train)."""
    c1, c2 = Counter(), Counter()
    for _, text, train in rows:
        if train:
            t = tokens(text)
            c1.update(t)
            c2.update(zip(["<s>", *t[:-1]], t, strict=True))
    n, v = sum(c1.values()), len(c1)
    types1, types2 = Counter(c1.values()), Counter(c2.values())

    def discounts(types):
        common = 6 * types[6] / types[1] if types[1] else 1.0
        d = [0.0] * 6
        for c in range(1, 6):
            ratio = (c + 1) * types[c + 1] / (c * types[c]) if types[c] else 1.0
            value = (ratio - common) / (1 - common) if common < 1 else 0.0
            d[c] = value if 0 < value < 1 else (c - 0.5) / c
        return d

    d1, d2 = discounts(types1), discounts(types2)
    unknown = sum(types1[c] * c * (1 - d1[c]) for c in range(1, 6)) / n if n else 1.0

    def p1(w):
        c = c1.get(w, 0)
        return (d1[c] if c <= 5 else 1) * c / n if c else unknown

    context, mass, seen = Counter(), Counter(), Counter()
    for (h, w), c in c2.items():
        context[h] += c
        mass[h] += (d2[c] if c <= 5 else 1) * c
        seen[h] += p1(w)
    divisor = {h: context[h] + (mass[h] > context[h] - 1e-9) for h in context}

    def p2(h, w):
        c = c2.get((h, w), 0)
        if c:
            return (d2[c] if c <= 5 else 1) * c / divisor[h]
        return ((1 - mass[h] / divisor[h]) / (1 - seen[h]) if h in seen else 1.0) * p1(w)

    out = []
    for doc_id, text, _ in rows:
        t = tokens(text)
        score = sum(math.log10(p2(h, w)) for h, w in zip(["<s>", *t[:-1]], t, strict=True))
        base = sum(math.log10((c1.get(w, 0) + 1) / (n + v + 1)) for w in t)
        out.append((doc_id, len(t), sum(c1.get(w, 0) > 0 for w in t), n, base, score))
    return out, (p2, c1, context)


def test_katz_is_the_brute_force_model(spark, small_docs):
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in small_docs.collect()]
    want, (p2, c1, context) = brute_katz(rows)
    got = {r.doc_id: r for r in katz.op2_katz(spark, SF).collect()}
    for doc_id, n, known, total, base, score in want:
        r = got[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    # every context sums to 1 over the vocabulary and the unknown type
    for h in [*context][:: max(1, len(context) // 25)]:
        assert math.isclose(sum(p2(h, w) for w in c1) + p2(h, "\x00unknown"), 1.0, rel_tol=1e-9)


def test_katz_edges(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 50)
    rows = [(r.doc_id, r.text, i % 4 != 0) for i, r in enumerate(odd_docs.select("doc_id", "text").collect())]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumn("block", F.lit("clash"))
    want, _ = brute_katz(rows)
    got = katz.score(df.repartition(2)).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    shape = lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[4], 6), round(r[5], 6))
    assert sorted(map(shape, got)) == sorted(map(shape, want))
    none = katz.score(df.withColumn("train", F.lit(False))).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in none} == {(0, 0, 0.0)}
    assert katz.score(no_docs.withColumn("train", F.lit(True))).count() == 0


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = language_id.op10_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    held = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held >= 0.97
    assert rows.where("score < 0 or score > 1").isEmpty()


def test_language_edges(spark, odd_docs, no_docs):
    model = language_id.fit(odd_docs)
    rows = {r.doc_id: r for r in language_id.predict(odd_docs, model).collect()}
    assert [rows[i]["_lang_pred"] for i in (1, 2, 3, 10)] == ["und"] * 4
    assert rows[4]["_lang_pred"] in ("en", "fr", "de") and 0 <= rows[4]["_lang_score"] <= 1
    assert language_id.predict(odd_docs, language_id.fit(no_docs)).where("_lang_pred <> 'und'").isEmpty()
    one = language_id.fit(odd_docs.where("lang = 'fr'"))
    assert {r["_lang_pred"] for r in language_id.predict(odd_docs.where("doc_id in (4, 11)"), one).collect()} == {"fr"}
    assert language_id.predict(no_docs, model).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = toxicity.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted").collect()
    caught = [r.predicted for r in rows if r.toxic == 1]
    alarms = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(caught) >= 0.75 and np.mean(alarms) <= 0.02


def test_toxicity_grammar(spark, odd_docs, no_docs):
    scanner = toxicity.Model({w: (toxicity.INSULT, 0.8) for w in toxicity.INSULTS} | {w: (toxicity.THREAT, 0.8) for w in toxicity.THREATS}).prepare()
    score = lambda t: float(scanner.scores([t])[0])
    assert score("you are an idiot") > score("an idiot") > score("a table") == score("") == score(None)
    assert score("you are not an idiot") < score("you are an idiot")
    assert score("he said you are an idiot") < score("you are an idiot")
    assert score("I will kill you.") > score("The frost may kill the roses.") > score("none")
    assert score("not now. you idiot") == score("you idiot")  # a negation ends with its clause
    assert score("reidiotic") == score("")
    both = toxicity.compose(toxicity.Transducer(({0: (1, 0), 1: (0, 0)},)), toxicity.Transducer(({0: ("a", 0), 1: ("b", 0)},)))
    assert both.run([0, 1, 1]) == ["b", "a", "a"]
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["_toxicity"] <= 1 for r in rows)
    empty = toxicity.fit(no_docs, labels.limit(0))
    assert toxicity.score(no_docs, empty).count() == 0


def test_html_main_text(spark):
    trees = html_extract.default_trees()
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
        "<div class=cookie-notice>We use cookies.</div><article><h1>A  title</h1><p>First &amp; long paragraph, with several words in it.\n It goes on <b>for a"
        " while</b>, and on.<p>Second paragraph of the text, which is long enough too.</p><div class=ad>Buy now</div></article>"
        "<section id=comments><div class=comment><p>I liked this very much, thanks.</p></div></section><aside class=sidebar><h3>More</h3><a href=/x>Other</a></aside>"
        "<footer>&copy; 2024</footer></body>"
    )
    got = html_extract.extract_texts([page, "", None, "<p", "plain"], trees)
    assert got[0] == "A title\n\nFirst & long paragraph, with several words in it. It goes on for a while, and on.\n\nSecond paragraph of the text, which is long enough too."
    assert got[1] == got[2] == ""
    rows = html_extract.op5_html_extraction(spark, SF).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(source) and all(r.n_chars == len(r.text) for r in rows)
    for r in rows:  # these pages hold their text in one article
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", source[r.page_id], re.S)[1]
        words = re.sub(r"<[^>]*>?", " ", body).replace("&amp;", "&").replace("&quot;", '"').split()
        assert r.text.split() == words
    none = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert html_extract.extract(none).count() == 0


def test_html_decoding_never_contradicts():
    page = html_extract.Page("<div><p>a</p><div><p>b</p></div></div>")
    r = np.random.default_rng(0)
    for _ in range(200):
        odds = r.normal(0, 2, len(page.tags))
        kept = html_extract.decode(page, odds)
        assert kept.dtype == bool and len(kept) == len(page.tags)
    assert html_extract.decode(page, np.full(len(page.tags), 9.0)).all()
    assert not html_extract.decode(page, np.full(len(page.tags), -9.0)).any()


def test_html_held_out_pages():
    r = np.random.default_rng(99)
    f1 = []
    for _ in range(40):
        source = html_extract.render_page(r)
        want = Counter(w for _, t, _ in html_extract.Page(source).texts if html_extract.MARKER in t for w in t.replace(html_extract.MARKER, "").split())
        got = Counter(html_extract.extract_texts([source.replace(html_extract.MARKER, "")], html_extract.default_trees())[0].split())
        f1.append(2 * sum((want & got).values()) / max(1, sum(want.values()) + sum(got.values())))
    assert np.mean(f1) >= 0.95


@pytest.mark.parametrize("shard", [4096, 300])
def test_ann_recall(spark, shard):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    valid = rows.where(ann.valid_vector(F.col("embedding")))
    got = ann.search(ann.index(valid, shard_rows=shard), valid.where("vec_id % 50 = 0")).collect()
    data = valid.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    ids, x = data.vec_id.values, np.stack(data.embedding.values).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for i, q in enumerate(ids):
        if q % 50 == 0:
            s = unit @ unit[i]
            s[i] = -9
            best = np.lexsort((ids, -s))[:5]
            mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
            assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
            hit += len({m[1] for m in mine} & set(ids[best]))
            total += 5
    assert hit / total >= 0.9


def test_ann_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("clash"))
    rows = df.where(F.col("vec_id").isNotNull() & ann.valid_vector(F.col("embedding"))).select("vec_id", "embedding")
    got = sorted(map(tuple, ann.search(ann.index(rows), rows.where("vec_id in (0, 10)")).collect()))
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 8), (0, 3, 9)]  # vector 10 has no vector of its length to meet
    hot = spark.range(500).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0).cast("float"), F.when(F.col("id") < 400, 0.0).otherwise(F.col("id")).cast("float")).alias("embedding"))
    near = ann.search(ann.index(hot), hot.where("vec_id = 2")).orderBy("rank").collect()
    assert [r.vec_id for r in near] == [0, 1, 3, 4, 5]
    none = rows.limit(0)
    assert ann.search(ann.index(none), none).count() == 0
