"""Operators 4, 8 and 9 against SQL, and their defined edge cases."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from cohortex.context import scratch_path
from cohortex.llm import exact_dedup, mixing, warc

from .conftest import LONG, SF, same_rows


def test_exact_dedup_matches_sql(spark):
    same_rows(exact_dedup.op9_exact_dedup(spark, SF), exact_dedup.SQL)


def test_exact_dedup_edges(spark, odd_docs, no_docs):
    rows = exact_dedup.membership(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    kept = [r for r in rows if r.kept]
    assert len({r.text_sha256 for r in rows}) == len(kept)
    empty = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in empty} == {(1, 2, 2, False), (2, 2, 2, True)}
    repeated = [r for r in rows if r.keep_id == 6]
    assert sorted((r.doc_id, r.group_size, r.kept) for r in repeated) == [(5, 3, False), (6, 3, False), (6, 3, True)]
    stays = exact_dedup.deduplicate(odd_docs)
    assert stays.columns == odd_docs.columns and stays.count() == len(kept)
    assert exact_dedup.membership(no_docs).count() == 0 and exact_dedup.deduplicate(no_docs).count() == 0


def test_exact_dedup_hot_group_is_split_off(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    rows = exact_dedup.membership(docs, capacity=64, winners=8).where("text_sha256 = sha2('hot', 256)")
    assert rows.agg(F.count("*"), F.min("keep_id"), F.max("group_size"), F.count_if("kept")).first() == (1000, 2997, 1000, 1)


def test_mixing_matches_sql(spark):
    same_rows(mixing.op4_mixing(spark, SF), mixing.SQL)


def test_mixing_cuts_at_the_budget_and_repeats_epochs(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(i, " ".join(["w"] * (1 + i % 7)), "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    p = mixing.plan(docs).withColumn("taken", F.col("_mix_epochs") * F.col("_mix_size") + F.col("_mix_part"))
    for r in p.groupBy("source").agg(F.sum("taken").alias("t"), F.first("_mix_target").alias("g"), F.first("_mix_source_size").alias("s")).collect():
        assert r.t == int(r.g) and r.g <= 2 * r.s
    out = mixing.mix(docs)
    words = out.select("source", F.size(F.split("text", " ")).alias("n")).groupBy("source").agg(F.sum("n").alias("n"))
    assert {r.source: r.n for r in words.collect()} == {r.source: r.t for r in p.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    odd = mixing.plan(odd_docs)
    assert odd.count() == odd_docs.count()
    assert odd.where("_mix_epochs * _mix_size + _mix_part > 2 * _mix_size").isEmpty()
    assert mixing.mix(odd_docs).columns == odd_docs.columns
    assert mixing.plan(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_mixing_targets_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), (None, 980)], "_mix_source string, _mix_source_size long")
    got = {r["_mix_source"]: r["_mix_target"] for r in mixing.targets(sizes).collect()}
    # a and c stop at twice their size; b (2) and null (5) share the rest until null stops too
    assert got["a"] == 20.0 and got["c"] == 20.0 and got[None] == 1960.0 and got["b"] == 3000 - 2000


def test_warc_matches_sql(spark):
    same_rows(warc.op8_warc(spark, SF), warc.SQL)


def test_warc_round_trip_at_any_split(spark):
    body = "<p>" + "text " * 400
    rows = [(1, "http://a", body), (2, None, body), (None, "http://c\r\nx", body), (3, "u", None), (4, "u", ""), (5, "u", "é" * 999), (6, "v", "é" * 999), (6, "v", "é" * 999), (7, "w", LONG), (8, "x", "\x1f\x8b\x08 WARC/1.1\r\n\r\n" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    manifest = warc.write(pages, scratch_path(spark, "warc_test"))
    whole = sorted(map(repr, warc.read(manifest, 1 << 30, payload=True).collect()))
    assert len(whole) == len(rows) and manifest.agg(F.sum("records")).first()[0] == len(rows)
    for split in (97, 1024):
        assert sorted(map(repr, warc.read(manifest, split, payload=True).collect())) == whole
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.read(manifest).collect()}
    assert {(1, "revisit", 2), (2, "response", None), (None, "revisit", 2), (5, "revisit", 6), (6, "response", None), (3, "response", None), (4, "response", None)} <= got
    texts = {r.page_id: bytes(r.payload).decode() for r in warc.read(manifest, payload=True).where("payload is not null").collect()}
    assert texts[7] == LONG and texts[8] == rows[-1][2] and texts[3] == ""
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(none, scratch_path(spark, "warc_none"))).count() == 0


def test_warc_bytes_are_read_once(tmp_path, monkeypatch):
    """A range of many small records is read through once, not a window for each record."""
    rng = random.Random(8)
    date, path = "1970-01-01T00:00:00Z", tmp_path / "many.warc.gz"
    rows = [{"page_id": i, "url": None, "payload": rng.randbytes(3000), "payload_bytes": 3000, "record_type": "response", "refers_to": None} for i in range(500)]
    path.write_bytes(b"".join(gzip.compress(warc.record(r | {"payload_digest": hashlib.sha1(r["payload"]).hexdigest()}, date)) for r in rows))
    size, asked, get = path.stat().st_size, [], warc.Window.get
    monkeypatch.setattr(warc.Window, "get", lambda self, pos, n: (asked.append(min(n, self.size - pos)), get(self, pos, n))[1])
    got = [r["payload"] for start in range(0, size, 1 << 20) for r in warc.records_in(f"file:{path}", size, start, min(size, start + (1 << 20)))]
    assert got == [r["payload"] for r in rows]
    assert sum(asked) < 10 * size  # each record asks for little more than itself


def foreign(fields, block):
    head = "".join(f"{k}: {v}\r\n" for k, v in fields) + f"content-length: {len(block)}\r\n"
    return gzip.compress(b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n")


def test_warc_of_another_writer(spark, tmp_path):
    """warcinfo, request and metadata records, lower-case and folded headers, base-32 and missing digests, no HTTP headers."""
    page = b"<p>hi</p>"
    sha = hashlib.sha1(page)
    http = b"HTTP/1.1 200 OK\r\nserver: x\r\nX-Folded: a\r\n b\r\n\r\n"
    records = [
        foreign([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:1>"), ("Content-Type", "application/warc-fields")], b"software: other\r\n"),
        foreign([("warc-type", "request"), ("WARC-Target-URI", "http://a/")], b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"),
        foreign([("WARC-TYPE", "response"), ("warc-target-uri", "http://a/"), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha.digest()).decode())], http + page),
        foreign([("WARC-Type", "response"), ("WARC-Target-URI", "http://b/"), ("WARC-Payload-Digest", "md5:00")], http + page * 2),
        foreign([("WARC-Type", "metadata")], b""),
        foreign([("WARC-Type", "revisit"), ("WARC-Refers-To", "<urn:uuid:3>"), ("WARC-Payload-Digest", "sha1:" + sha.hexdigest().upper())], b""),
        foreign([("WARC-Type", "resource"), ("X-Page-ID", "12")], page),
    ]
    (tmp_path / "other.warc.gz").write_bytes(b"".join(records))
    size = sum(map(len, records))
    manifest = spark.createDataFrame([(f"file:{tmp_path}/other.warc.gz", size, len(records))], warc.MANIFEST)
    for split in (1 << 20, 100):
        got = sorted((r.record_type, r.url, r.payload_bytes, r.payload_digest, r.page_id, r.refers_to) for r in warc.read(manifest, split).collect())
        assert [r[0] for r in got] == ["metadata", "request", "resource", "response", "response", "revisit", "warcinfo"]
        by_type = {(r[0], r[1]): r[2:] for r in got}
        assert by_type["response", "http://a/"] == (len(page), sha.hexdigest(), None, None)
        assert by_type["response", "http://b/"] == (2 * len(page), hashlib.sha1(page * 2).hexdigest(), None, None)
        assert by_type["revisit", None] == (None, sha.hexdigest(), None, None)
        assert by_type["resource", None] == (len(page), sha.hexdigest(), 12, None)
