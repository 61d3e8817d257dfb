"""Substring dedup: windows of 50 words counted exactly in super-k-mer buckets.

A word is removed when a window of ``window`` consecutive words that covers it also starts in
a document with a smaller id. Windows are judged on the input.

1. A window's minimiser is the least hash of its ``minimiser``-word grams. Consecutive windows
   of a document that share it (a super-k-mer) travel as one packed string, their words joined
   by one space, to the minimiser's bucket: about three times the text is shuffled instead of
   ``window`` times. Equal windows have equal minimisers, so they meet.
2. A bucket is sorted by minimiser and streamed; whole groups are taken in chunks of
   ``GROUP_BYTES``. There words get exact numbers (a dictionary of their bytes), runs of 2, 4,
   8, ... words get exact numbers from pairs of numbers, and so do windows; sorting the windows
   by number and id gives each one's least document. No hash decides equality.
3. Minimisers with over ``HOT_ROWS`` super-k-mers (at most ``HOT_LIST`` of them, the most
   frequent; any other holds less than 1 / ``HOT_LIST`` of the rows and stays in step 2) would
   make one task do a share of all work that grows with the input. Their windows travel one by
   one as 128-bit digests: least ids are combined before the shuffle, and the answers are joined
   back by digest, where Spark splits skewed keys.
4. The removed spans meet their documents by id and text hash in an ordinary join.

Defined results: a null text has no words. A null id is neither smaller nor larger than any
other: such a document loses nothing and takes nothing away. Rows that repeat an id are no
reason to remove: only smaller ids are. Texts of fewer words than a window lose nothing. An
empty table gives an empty result. ``deduplicate`` keeps every column, whatever its name; it
joins the kept words by one space where something was removed and leaves other texts as they
are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.llm.common import durable, fresh, give_back, table
from cohortex.llm.words import CHUNK_BYTES, mix, text_buffers

WINDOW = 50
MINIMISER = 4
HOT_ROWS = 2_000
HOT_LIST = 1 << 16
GROUP_BYTES = 8 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_STEP = np.uint64(0xFF51AFD7ED558CCD)
_powers = {base: np.ones(1, np.uint64) for base in _BASES}


class Words:
    """The words of some texts: ``packed`` holds them all, each followed by one space.

    Word i is ``packed[at[i]:at[i + 1] - 1]``; text r has the words ``bounds[r]`` to ``bounds[r + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = solid[:-1]
        starts = np.flatnonzero(solid & (~before | edge[:-1]))
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = solid[1:]
        lengths = np.flatnonzero(solid & (~after | edge[1:])) + 1 - starts
        n = len(starts)
        self.bounds = np.searchsorted(starts, offsets)
        self.at = np.zeros(n + 1, np.int64)
        np.cumsum(lengths + 1, out=self.at[1:])
        self._bytes, self._lengths = data[solid], lengths
        self._first = self.at[:-1] - np.arange(n)
        whole = np.full(int(self.at[-1]), 0x20, np.uint8)
        whole[np.arange(len(self._bytes)) + np.repeat(np.arange(n), lengths)] = self._bytes
        self.packed = whole.tobytes()

    def hashes(self, base: np.uint64 = _BASES[0]) -> np.ndarray:
        """A 64-bit polynomial of each word's bytes and its length."""
        if not len(self._lengths):
            return np.zeros(0, np.uint64)
        longest = int(self._lengths.max())
        if len(_powers[base]) < longest:
            _powers[base] = np.cumprod(np.r_[np.uint64(1), np.full(2 * longest, base)], dtype=np.uint64)
        place = np.arange(len(self._bytes)) - np.repeat(self._first, self._lengths)
        terms = (self._bytes.astype(np.uint64) + np.uint64(1)) * _powers[base][place]
        return mix(np.add.reduceat(terms, self._first) + self._lengths.astype(np.uint64) * _STEP)


def texts_of(column: pa.Array) -> Iterator[tuple[int, Words]]:
    """(first row, words) of chunks of rows, about ``CHUNK_BYTES`` of text or one row each."""
    data, offsets = text_buffers(column)
    row, n = 0, len(column)
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        stop = min(max(row + 1, stop), n)
        yield row, Words(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, from runs of half the width."""
    total, have = words, 1
    while have < width:
        step = min(have, width - have)
        total = mix(total[:-step] * _STEP + total[step:] + np.uint64(step)) if len(total) > step else total[:0]
        have += step
    return total


def least_of_runs(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


def super_kmers(words: Words, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, last window, minimiser) of the runs of windows that share a minimiser.

    Windows are named by their first word; all are those of one text.
    """
    minimiser = min(minimiser, window)
    least = least_of_runs(run_hashes(words.hashes(), minimiser), window - minimiser + 1)
    end = np.repeat(words.bounds[1:], np.diff(words.bounds))  # of each word's text
    valid = np.arange(len(least)) + window <= end[: len(least)]
    if not valid.any():
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    at = np.flatnonzero(valid)
    new = np.r_[True, (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]]) | (end[at[1:]] != end[at[:-1]])]
    first = at[new]
    last = at[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
    return np.searchsorted(words.bounds, first, side="right") - 1, first, last, least[first]


def _kmers(docs: DataFrame, window: int, minimiser: int, schema: str, make) -> DataFrame:
    """``make(words, ids, text hashes, super-k-mers) -> columns`` over ``docs`` (id, h, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, words in texts_of(batch.column(2)):
                found = super_kmers(words, window, minimiser)
                if len(found[0]):
                    names, columns = make(words, ids[row + found[0]], hashes[row + found[0]], found)
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def hot_minimisers(docs: DataFrame, window: int, minimiser: int, hot_rows: int) -> np.ndarray:
    """The minimisers of more than ``hot_rows`` super-k-mers, at most ``HOT_LIST``, sorted."""

    def make(words, ids, hashes, found):
        keys, counts = np.unique(found[3].view(np.int64), return_counts=True)
        return ["key", "n"], [pa.array(keys), pa.array(counts.astype(np.int64))]

    counted = _kmers(docs, window, minimiser, "key long, n long", make).groupBy("key").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") > hot_rows).orderBy(F.col("n").desc(), "key").limit(HOT_LIST)
    return np.sort(np.array([r["key"] for r in top.select("key").collect()], np.int64))


def packed_rows(docs: DataFrame, window: int, minimiser: int, hot: np.ndarray) -> DataFrame:
    """(key, id, h, start, words): the super-k-mers of minimisers that are not ``hot``."""

    def make(words, ids, hashes, found):
        text, first, last, key = found
        key = key.view(np.int64)
        cold = ~np.isin(key, hot)
        low, high = words.at[first[cold]], words.at[last[cold] + window] - 1
        packed = [words.packed[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        start = (first - words.bounds[text])[cold]
        columns = [pa.array(key[cold]), pa.array(ids[cold]), pa.array(hashes[cold]), pa.array(start), pa.array(packed, pa.binary()).cast(pa.string())]
        return ["key", "id", "h", "start", "words"], columns

    return _kmers(docs, window, minimiser, "key long, id long, h long, start long, words string", make)


def digest_rows(docs: DataFrame, window: int, minimiser: int, hot: np.ndarray) -> DataFrame:
    """(d1, d2, id, h, start): every window of the ``hot`` minimisers with its 128-bit digest."""

    def make(words, ids, hashes, found):
        text, first, last, key = found
        mine = np.flatnonzero(np.isin(key.view(np.int64), hot))
        counts = (last - first + 1)[mine]
        at = np.repeat(first[mine], counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        d = [run_hashes(words.hashes(base), window)[at].view(np.int64) if len(at) else np.zeros(0, np.int64) for base in _BASES]
        who = np.repeat(mine, counts)
        return ["d1", "d2", "id", "h", "start"], [pa.array(x) for x in (*d, ids[who], hashes[who], at - words.bounds[text[who]])]

    return _kmers(docs, window, minimiser, "d1 long, d2 long, id long, h long, start long", make)


def exact_numbers(words: pa.Array, width: int) -> np.ndarray:
    """One number for each run of ``width`` words; runs have equal numbers exactly if their words are equal."""
    number = pc.dictionary_encode(words).indices.to_numpy().astype(np.int64)
    have = 1
    while have < width:
        step = min(have, width - have)
        if len(number) <= step:
            return number[:0]
        pairs = number[:-step] * (int(number.max()) + 1) + number[step:]
        number = pc.dictionary_encode(pa.array(pairs)).indices.to_numpy().astype(np.int64)
        have += step
    return number


def repeated_in_bucket(rows: pa.Table, window: int) -> pa.RecordBatch:
    """(id, h, first, stop): spans of the super-k-mers' windows that a smaller id has too."""
    keys, ids = rows["key"].to_numpy(), rows["id"].to_numpy()
    groups = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
    shared = np.minimum.reduceat(ids, groups) < np.maximum.reduceat(ids, groups)
    rows = rows.filter(pa.array(np.repeat(shared, np.diff(np.r_[groups, len(keys)]))))  # others have nothing to meet
    if not len(rows):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=["id", "h", "first", "stop"])
    ids, hashes, start = (rows[c].to_numpy() for c in ("id", "h", "start"))
    split = pc.split_pattern(rows["words"].combine_chunks(), " ")
    first = np.asarray(split.offsets)[: len(rows)] - split.offsets[0].as_py()
    counts = pc.list_value_length(split).to_numpy().astype(np.int64) - window + 1
    number = exact_numbers(split.flatten(), window)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    owner = np.repeat(np.arange(len(rows)), counts)
    number, who = number[np.repeat(first, counts) + within], ids[owner]
    order = np.lexsort((who, number))
    new = np.r_[True, np.diff(number[order]) != 0]
    least = np.empty(len(order), np.int64)
    least[order] = who[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    hit = np.flatnonzero(who > least)
    begin = np.r_[True, (np.diff(hit) > 1) | (np.diff(owner[hit]) != 0)] if len(hit) else np.zeros(0, bool)
    low, high = hit[begin], hit[np.r_[np.flatnonzero(begin)[1:] - 1, len(hit) - 1]] if len(hit) else hit
    base = start[owner[low]]
    columns = (ids[owner[low]], hashes[owner[low]], base + within[low], base + within[high] + window)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "h", "first", "stop"])


def bucket_spans(packed: DataFrame, window: int) -> DataFrame:
    """The spans found in the buckets: groups of one minimiser, streamed in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.nbytes
            if size < GROUP_BYTES:
                continue
            last = batch.column(0)[len(batch) - 1].as_py()
            rows = pa.Table.from_batches(held)
            cut = int(np.searchsorted(rows["key"].to_numpy(), last))
            if cut:  # the last group may go on in the next batch
                yield repeated_in_bucket(rows.slice(0, cut), window)
                held = rows.slice(cut).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield repeated_in_bucket(pa.Table.from_batches(held), window)

    dealt = packed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "id long, h long, first long, stop long")


def digest_spans(windows: DataFrame, window: int) -> DataFrame:
    """The spans of windows whose digest a smaller id has too."""
    least = windows.groupBy("d1", "d2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    hit = windows.join(least.drop("most"), ["d1", "d2"]).where("id > least")
    return hit.select("id", "h", F.col("start").alias("first"), (F.col("start") + window).alias("stop"))


def repeated_spans(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, minimiser: int = MINIMISER, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(id, h, spans): for documents that lose words, the array of (first, stop) word spans to remove.

    ``h`` is xxhash64 of the text; id and ``h`` name the document. Spans may overlap.
    """
    text = F.col(text_col).cast("string")
    docs = df.where(F.col(id_col).isNotNull() & text.isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    hot = hot_minimisers(docs, window, minimiser, hot_rows)
    spans = bucket_spans(packed_rows(docs, window, minimiser, hot), window)
    if len(hot):
        spans = spans.unionByName(digest_spans(digest_rows(docs, window, minimiser, hot), window))
    found = durable(spans.distinct().groupBy("id", "h").agg(F.collect_list(F.struct("first", "stop")).alias("spans")), "substring_spans")
    give_back(df.sparkSession)  # the shuffled super-k-mers, before the texts are shuffled to their spans
    return found


def with_kept(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> tuple[DataFrame, list[str]]:
    """``df`` plus four columns of fresh names, which are returned too: n_words, n_removed, kept text, its SHA-256."""
    spans = repeated_spans(df, id_col, text_col, **options)
    names = [fresh(df, n) for n in ("n_words", "n_removed", "kept", "kept_sha256", "s_id", "s_h", "spans")]
    right = spans.toDF(names[4], names[5], names[6])
    text = F.col(text_col).cast("string")
    joined = df.join(right, (F.col(id_col).cast("long") == F.col(names[4])) & (F.xxhash64(text) == F.col(names[5])), "left")
    own = joined.select(*df.columns, text.alias(names[2]), names[6])
    place = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, counts, removed, kept, digests = batch.column(place + 1), [], [], [], []
            for row, words in texts_of(batch.column(place)):
                for r in range(len(words.bounds) - 1):
                    text, n, gone = _kept(words, r, spans[row + r].as_py())
                    counts.append(n)
                    removed.append(gone)
                    kept.append(text)
                    digests.append(hashlib.sha256(text).hexdigest())
            new = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], *new], names=[*batch.schema.names[:place], *names[:4]])

    result = df.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.lit(0).cast("long"), names[2]: F.lit(""), names[3]: F.lit("")}).schema
    return own.mapInArrow(run, result), names[:4]


def _kept(words: Words, r: int, spans: list | None) -> tuple[bytes, int, int]:
    """(kept words joined by one space, number of words, number of removed words) of text r."""
    low, high = int(words.bounds[r]), int(words.bounds[r + 1])
    if not spans:
        return words.packed[words.at[low] : max(words.at[low], words.at[high] - 1)], high - low, 0
    depth = np.zeros(high - low + 1, np.int64)
    np.add.at(depth, [s["first"] for s in spans], 1)
    np.add.at(depth, [s["stop"] for s in spans], -1)
    keep = np.cumsum(depth[:-1]) == 0
    edges = np.flatnonzero(np.diff(np.r_[False, keep, False].astype(np.int8))) + low
    pieces = [words.packed[words.at[a] : words.at[b]] for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return b"".join(pieces)[:-1], high - low, int((~keep).sum())


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with repeated windows removed from its texts; other columns and untouched texts as they were."""
    rows, (_, removed, kept, _) = with_kept(df, id_col, text_col, **options)
    return rows.withColumn(text_col, F.when(F.col(removed) > 0, F.col(kept)).otherwise(F.col(text_col))).select(*df.columns)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, (n, removed, _, digest) = with_kept(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col(n).alias("n_words"), F.col(removed).alias("n_removed"), F.col(digest).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM windows) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hits),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.p) AS body, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
