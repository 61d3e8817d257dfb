"""Vector bin packing by the dot-product heuristic.

A piece is a vector (tokens, segments = 1, loss-bearing tokens); a sequence is a bin with a
limit in every dimension. For the open bin the heuristic takes, of all pieces that still
fit, the one whose vector (as shares of the limits) has the largest dot product with the
room left; when nothing fits, the bin is closed. Documents longer than a sequence are cut
into full sequences and one rest first, so no token is lost.

Pieces are dealt at random into shards of about ``PIECES_PER_SHARD`` slim rows (no texts, no
ids) and each shard is packed in one task; the number of shards grows with the input, the
size of a shard does not. The waste of a shard is one unfilled bin.

Tokens: the tokenizer of the named file, without special tokens, then the end id. The file's
vocabulary works on white-space separated words, so a task encodes every distinct word once
and keeps a bounded cache; words outside plain Latin-1 letters, digits and punctuation go
through the complete tokenizer. Both ways give the tokenizer's own ids.

Defined results: a null text is empty and gives one piece with the end id alone. Null ids
and repeated rows are packed like any others, each row once. A very long text gives many
pieces. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.llm.common import durable, release_memory, releasing, table

SEQUENCE = 4096
MAX_SEGMENTS = 256
PIECES_PER_SHARD = 2048
END_ID = 2
CACHE_WORDS = 600_000
VOCABULARY = "word_bpe_49k.json"

_PLAIN = re.compile("[!-;=-~À-ÖØ-öø-ÿ]+")  # no "<": it may open a special token
_PRETOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space for str.split, ordinary characters for the tokenizer
_WORDS_WITH_ODD = re.compile("[\\S\x1c-\x1f]+")

_encoders: dict[str, "Encoder"] = {}


def _byte_characters() -> dict[int, str]:
    """Code point -> its bytes as the byte-level alphabet writes them (printable bytes stand for themselves)."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(128, 256)}


class Encoder:
    """Text -> little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the word-wise way holds for this kind of file only
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = steps == ["NFC", "Replace", "Lowercase"] and spec["model"].get("end_of_word_suffix") == "</w>"
        self.model = self.full.model
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.letters = _byte_characters()
        del spec
        release_memory()

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.letters))]
        return np.asarray(ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
            self.parts.clear()
        for word in set(words).difference(self.cache):
            if _PLAIN.fullmatch(word):
                ids = b""
                for part in _PRETOKEN.findall(word.lower()):
                    known = self.parts.get(part)
                    if known is None:
                        known = self.parts[part] = self._part(part)
                    ids += known
                self.cache[word] = ids
            else:
                self.cache[word] = self._ids(word)

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self._ids(text)
        words = _WORDS_WITH_ODD.findall(text) if _ODD_SPACE.search(text) else text.split()
        try:
            return b"".join(map(self.cache.__getitem__, words))
        except KeyError:
            self._learn(words)
            return b"".join(map(self.cache.__getitem__, words))


def encoder(path: str) -> Encoder:
    """One per Python worker: the file is read and the cache filled once, not per task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenize(df: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, loss_tokens (here every token bears loss)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        else:
            path = tokenizer
        enc, end = encoder(path), np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for i, text in enumerate(batch.column(1)):
                ids = enc.encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    cut = ids[4 * start : 4 * (start + sequence)]
                    out.append((i, start, len(cut) // 4, zlib.crc32(cut), total))
            rows = np.asarray(out, dtype=np.int64).reshape(-1, 5)
            doc = batch.column(0).take(pa.array(rows[:, 0]))
            yield pa.RecordBatch.from_arrays(
                [doc, *(pa.array(rows[:, k]) for k in (1, 2, 3, 4)), pa.array(rows[:, 2])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens"],
            )

    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(releasing(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long")


def place(vectors: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and rank in the bin of each vector, by the dot-product heuristic (whole numbers, ties to the earlier row)."""
    n = len(vectors)
    bins, ranks = np.empty(n, np.int64), np.empty(n, np.int64)
    shares = vectors / limits
    order = np.argsort(-shares.sum(axis=1), kind="stable")
    left, share = vectors[order], shares[order]
    alive = order
    current, placed, room = 0, 0, limits.astype(np.int64)
    while len(alive):
        fits = np.flatnonzero((left <= room).all(axis=1))
        if not len(fits):
            if not placed:
                raise ValueError("a piece exceeds the limits of an empty sequence")
            current, placed, room = current + 1, 0, limits.astype(np.int64)
            continue
        best = fits[np.argmax(share[fits] @ (room / limits))]
        bins[alive[best]], ranks[alive[best]] = current, placed
        room = room - left[best]
        placed += 1
        left, share, alive = (np.delete(x, best, axis=0) for x in (left, share, alive))
    return bins, ranks


def pack(pieces: DataFrame, sequence: int = SEQUENCE, max_segments: int = MAX_SEGMENTS, max_loss: int = SEQUENCE, per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """``pieces`` (length, loss_tokens, ...) plus sequence_id and offset.

    No sequence exceeds ``sequence`` tokens, ``max_segments`` pieces or ``max_loss``
    loss-bearing tokens; a single piece must respect the limits.
    """
    stored = durable(pieces.withColumn("_row", F.monotonically_increasing_id()), "packing_pieces")
    shards = max(1, -(-stored.count() // per_shard))
    limits = np.asarray([sequence, max_segments, max_loss], dtype=np.float64)

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("_row")
        length = shard.column("length").to_numpy()
        loss = shard.column("loss_tokens").to_numpy()
        bins, ranks = place(np.stack([length, np.ones_like(length), loss], axis=1), limits)
        order = np.lexsort((ranks, bins))
        before = np.cumsum(length[order]) - length[order]
        first = np.r_[True, bins[order][1:] != bins[order][:-1]]
        offset = np.empty_like(length)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        sequence_id = (shard.column("_shard").to_numpy().astype(np.int64) << 32) + bins
        return shard.drop_columns(["_row", "_shard"]).append_column("sequence_id", pa.array(sequence_id)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    dealt = stored.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    return dealt.groupBy("_shard").applyInArrow(run, schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(tokenize(table(spark, sf_dir, "documents"))).drop("loss_tokens")
