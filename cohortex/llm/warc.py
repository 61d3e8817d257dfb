"""WARC archives: a writer with revisit records and a splittable reader.

Writer: every row becomes one record in its own gzip member. Of rows with equal payloads of
at least ``MIN_REVISIT`` bytes the one with the largest page_id is written as ``response``
with the payload, the others as ``revisit`` with headers only. Which ones is a map-side
combined aggregate over payload digests and one join; the pages are never gathered by group.
A task writes files under the shared folder through the file system of their address, each
attempt under a name of its own; only the files named by finished tasks (the manifest, a
written table) are ever read, so a lost executor leaves nothing half-written in the result.

Reader: files are dealt into byte ranges of ``SPLIT_BYTES``; a task scans its range for the
gzip magic, takes a position as a member only if its header flags are valid and the data
inflates to a WARC record (checked up to the member's checksum, and to what follows it), and
owns the records that start inside its range, reading past its end to finish the last one.
A task holds one record at a time. Archives of other writers are read too: header names in
any letter case, digests in base 32 or hexadecimal or missing, payloads with or without HTTP
headers; records of other types (warcinfo, request, metadata, ...) come back as their type.

Defined results: a null html is an empty payload (0 bytes, always ``response``). A null
page_id counts as smaller than any other and is read back as null. Rows that repeat the
largest page_id of a group are all responses. Null urls are read back as null; line breaks
in an url are percent-encoded. An empty table writes no file and gives an empty result. In records of other
writers page_id and refers_to are null unless they hold this writer's ids; a revisit without a
stated payload length has null there. Input columns besides page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.context import scratch_path
from cohortex.llm.common import durable, releasing, table, text_of

MIN_REVISIT = 1000
FILE_BYTES = 256 << 20
SPLIT_BYTES = 4 << 20
READ_BYTES = 1 << 20
CHUNK_BYTES = 1 << 16
MAGIC = b"\x1f\x8b\x08"
MANIFEST = "path string, size long, records long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def file_system(address: str):
    """pyarrow's file system and path of a Hadoop-style address (file:/x, hdfs://..., s3://..., /x)."""
    from pyarrow import fs

    if address.startswith("file:") and not address.startswith("file://"):
        address = "file://" + address[5:]
    return fs.FileSystem.from_uri(address)


def with_record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    payload = text_of("html").cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )
    groups = (
        rows.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select(F.col("payload_digest").alias("_digest"), "_first")
    )
    joined = rows.join(groups, F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.withColumns(
        {"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("_first"))}
    ).drop("_digest", "_first")


def record(row: dict, date: str) -> bytes:
    """The uncompressed record of one row."""
    size, digest = row["payload_bytes"], row["payload_digest"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    response = row["record_type"] == "response"
    block = http + (row["payload"] if response else b"")
    head = [f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}"]
    if row["page_id"] is not None:
        head.append(f"X-Page-ID: {row['page_id']}")
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if not response:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{row['refers_to']}>")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 4, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives under ``folder``; the manifest (path, size, records) as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, records, done = None, "", 0, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None:
                        path, size, records = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                        fs, inner = file_system(path)
                        fs.create_dir(inner.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(inner, compression=None)
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(record(row, date)) + packer.flush()
                    out.write(member)
                    size, records = size + len(member), records + 1
                    if size >= file_bytes:
                        out.close()
                        out = None
                        done.append((path, size, records))
        if out is not None:
            out.close()
            done.append((path, size, records))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                names=["path", "size", "records"],
            )

    return durable(with_record_types(pages).mapInArrow(releasing(run), MANIFEST), "warc_manifest")


class Window:
    """Bytes of an open file by position, holding only a sliding part."""

    def __init__(self, handle, size: int):
        self.handle, self.size, self.start, self.data = handle, size, 0, b""

    def get(self, pos: int, n: int) -> bytes:
        end = min(self.size, pos + n)
        if pos < self.start or end > self.start + len(self.data):
            self.handle.seek(pos)
            self.start, self.data = pos, self.handle.read(min(self.size - pos, max(n, READ_BYTES)))
        return self.data[pos - self.start : max(pos, end) - self.start]


def opens_record(window: Window, pos: int) -> bool:
    """Whether a gzip member that begins a WARC record may start at ``pos``."""
    head = window.get(pos, 512)
    if len(head) < 18 or head[:3] != MAGIC or head[3] & 0xE0:
        return False
    try:
        return zlib.decompressobj(31).decompress(head, 5) == b"WARC/"
    except zlib.error:
        return False


def read_member(window: Window, pos: int) -> tuple[bytes, int] | None:
    """The inflated member at ``pos`` and the position after it, None if it is not intact."""
    inflater, parts, at, n = zlib.decompressobj(31), [], pos, 1 << 12
    try:
        while not inflater.eof:
            chunk = window.get(at, n)
            if not chunk:
                return None
            parts.append(inflater.decompress(chunk))
            at, n = at + len(chunk), min(2 * n, CHUNK_BYTES)
    except zlib.error:
        return None
    return b"".join(parts), at - len(inflater.unused_data)


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-cased name; a line that begins with white space goes on with the last one."""
    out: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (" ", "\t") and name is not None:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = (part.strip() for part in line.split(":", 1))
            name = name.lower()
            out[name] = value
    return out


def _hex_digest(stated: str) -> str | None:
    """The lower-case hexadecimal form of a stated SHA-1, None for another kind of digest."""
    kind, _, value = stated.partition(":")
    if kind.lower() != "sha1":
        return None
    if len(value) == 32:
        try:
            return base64.b32decode(value.upper()).hex()
        except binascii.Error:
            return None
    return value.lower()


def _own_id(stated: str) -> int | None:
    digits = stated.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if re.fullmatch(r"-?[0-9]+", digits) else None


def parse(data: bytes) -> dict | None:
    """The fields of one record, None if its lengths do not agree."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head.decode("utf-8", "replace").split("\r\n")[1:])
    stated = fields.get("content-length", "")
    if not stated.isdigit() or len(rest) != int(stated) + 4:
        return None
    kind, block = fields.get("warc-type", "").lower(), rest[: int(stated)]
    payload, size = block, len(block)
    if kind in ("response", "revisit") and block[:5] == b"HTTP/":
        http, _, payload = block.partition(b"\r\n\r\n")
        own = _fields(http.decode("utf-8", "replace").split("\r\n")[1:]).get("content-length", "")
        size = len(payload) if kind == "response" else int(own) if own.isdigit() else None
    elif kind == "revisit":
        size = None
    digest = _hex_digest(fields.get("warc-payload-digest", ""))
    if kind != "revisit":
        found = hashlib.sha1(payload).hexdigest()
        if kind == "response" and digest not in (None, found):
            raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged")
        digest = found
    return {
        "page_id": _own_id(fields.get("x-page-id", "")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _own_id(fields.get("warc-refers-to", "")),
        "payload": payload if kind != "revisit" else None,
    }


def records_in(path: str, size: int, start: int, end: int) -> Iterator[dict]:
    """The records whose members start in [start, end)."""
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as handle:
        window, pos = Window(handle, size), start
        while pos < end:
            member = read_member(window, pos) if opens_record(window, pos) else None
            row = None
            if member is not None and (member[1] >= size or opens_record(window, member[1])):
                row = parse(member[0])
            if row is not None:
                yield row
                pos = member[1]
                continue
            # on to the next magic that starts before the end
            n = min(CHUNK_BYTES, end - pos - 1 + len(MAGIC) - 1)
            found = window.get(pos + 1, n).find(MAGIC)
            pos += 1 + (found if found >= 0 else n - len(MAGIC) + 1)


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = False) -> DataFrame:
    """The records of the manifest's files; with ``payload`` also the bytes of all but revisits."""
    ranges = manifest.select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start")
    ).select("path", "size", "start", F.least("size", F.col("start") + split_bytes).alias("stop"))
    n = manifest.agg(F.coalesce(F.sum(F.ceil(F.col("size") / split_bytes)), F.lit(0)).alias("n")).first()["n"]
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        + ([("payload", pa.binary())] if payload else [])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = []
                for row in records_in(r["path"], r["size"], r["start"], r["stop"]):
                    rows.append(row)
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.repartition(max(1, min(int(n), 10_000))).mapInArrow(releasing(run), RECORDS + (", payload binary" if payload else ""))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return read(write(pages, scratch_path(spark, "warc"))).drop("url")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (
  SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
         max(page_id) OVER (PARTITION BY h) AS newest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM g
"""
