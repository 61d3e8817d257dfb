"""Katz backoff language model over words (bigram over unigram), counted and scored on Spark.

P(w | h) = d(c) c(h, w) / c(h)      if c = c(h, w) > 0
         = alpha(h) P(w)            else,
P(w)     = d(c) c(w) / N for words of the training texts, the rest of the mass for one
unknown type. d are Katz's Good-Turing discounts (counts up to ``TURING`` are discounted),
alpha(h) makes every context sum to exactly 1 over the vocabulary and the unknown type; a
context that the training texts do not have has alpha 1, one without any discounted count the
divisor c(h) + 1. All bigrams are kept, those seen once too. Every text starts from a start context and ends
with an end token that is scored like a word.

How the work is dealt: texts are read once into blocks (one row: word numbers of the block's
texts and the hashes of its distinct words), a table bucketed by block. A block asks for each
distinct word and bigram once: packed, sorted arrays, one row per block and partition. A
partition adds the training counts of all blocks, keeps the n-gram table of its hash range
and answers each block in the order of its question. Bigrams are partitioned by context, so a
partition sees whole contexts; contexts with over 1 / ``SPLIT`` of all tokens are spread over
all partitions and their sums (a few numbers each, at most ``SPLIT`` contexts) are combined.
Contexts that no other block holds (most of those seen once) are counted within their block.
Blocks and answers are joined on the bucketed key; the texts are never shuffled. What is
gathered grows with the input; the driver receives counts of counts and the split contexts.

Words and contexts are 64-bit hashes, the second word of a bigram 48 bits within its context.

Defined results: a null or empty text is the end token alone. Training rows are those whose
``train`` column is true; without any, N and V are 0 and every token has probability 1.
Repeated rows and ids are counted and scored like any others. An empty table gives an empty
result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.context import scratch_path
from cohortex.llm.common import durable, fold, give_back, release_memory, releasing, table
from cohortex.llm.words import mix, word_hashes

TURING = 5
SPLIT = 1000
BLOCK_TOKENS = 1_000_000  # a task holds one block; its distinct bigrams take most of a worker's memory
END = np.uint64(0x1B873593CC9E2D51)
START = np.uint64(0x2545F4914F6CDD1D)
STATS = TURING + 1  # per context: types with each count 2 .. TURING, mass of larger counts, P mass (types seen once follow from c(h))


def pack(values: np.ndarray) -> bytes:
    """Byte planes: equal high bytes lie together and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if len(values) else b""


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel() if data else np.zeros(0, kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def range_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a hash: equal ranges of the 64-bit values."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


# ---------------------------------------------------------------- blocks


def blocks_of(docs: DataFrame, buckets: int) -> DataFrame:
    """docs (doc_id, text, train) as a table of blocks, bucketed by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, trains, words, sizes, held = [], [], [], [], 0

        def emit() -> pa.RecordBatch:
            vocabulary, number = np.unique(np.concatenate(words), return_inverse=True)
            key = int.from_bytes(uuid.uuid4().bytes[:8], "little", signed=True)
            doc_ids = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                    pa.array([pack(np.concatenate(trains).astype(np.uint8))], pa.binary()),
                    pa.array([pack(np.array(sizes, np.uint32))], pa.binary()),
                    pa.array([pack(number.astype(np.uint32))], pa.binary()),
                    pa.array([pack_sorted(vocabulary)], pa.binary()),
                ],
                names=["block", "doc_ids", "train", "sizes", "words", "vocabulary"],
            )

        for batch in batches:
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for row, hashes, bounds in word_hashes(batch.column(1)):
                n = len(bounds) - 1
                ids.append(batch.column(0).slice(row, n))
                trains.append(train[row : row + n])
                words.append(np.insert(hashes, bounds[1:], END))
                sizes.extend((np.diff(bounds) + 1).tolist())
                held += len(hashes) + n
                if held >= BLOCK_TOKENS:
                    yield emit()
                    ids, trains, words, sizes, held = [], [], [], [], 0
                    release_memory()
        if ids:
            yield emit()

    schema = "block long, doc_ids array<long>, train binary, sizes binary, words binary, vocabulary binary"
    name = f"katz_blocks_{uuid.uuid4().hex[:12]}"
    # the table lies in the shared folder; the catalog's entry is needed only until the plan is resolved
    spark = docs.sparkSession
    docs.mapInArrow(releasing(run), schema).write.option("path", scratch_path(spark, "katz_blocks")).option("compression", "zstd").bucketBy(buckets, "block").saveAsTable(name)
    blocks = spark.table(name)
    blocks.schema  # noqa: B018  resolves the plan
    spark.sql(f"DROP TABLE {name}")
    return blocks


@dataclass
class Block:
    """A block's tokens by local word number; the start context has the number after the last word."""

    doc_ids: pa.Array
    train: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    vocabulary: np.ndarray

    @classmethod
    def read(cls, rows: pa.Table) -> "Block":
        r = {c: rows.column(c)[0] for c in ("doc_ids", "train", "sizes", "words", "vocabulary")}
        return cls(
            r["doc_ids"].values, unpack(r["train"].as_py(), np.uint8).astype(bool), unpack(r["sizes"].as_py(), np.uint32).astype(np.int64),
            unpack(r["words"].as_py(), np.uint32).view(np.int32), unpack_sorted(r["vocabulary"].as_py(), np.uint64),
        )

    def token_train(self) -> np.ndarray:
        return np.repeat(self.train, self.sizes)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) pairs as context * (V + 1) + word, the pair of each token, training counts."""
        keys = np.empty(len(self.words), np.int64)
        keys[1:] = self.words[:-1]
        keys[np.cumsum(self.sizes) - self.sizes] = len(self.vocabulary)
        keys *= len(self.vocabulary) + 1
        keys += self.words
        pairs, which = np.unique(keys, return_inverse=True)
        which = which.astype(np.int32)
        return pairs, which, np.bincount(which[self.token_train()], minlength=len(pairs)).astype(np.uint32)


# ---------------------------------------------------------------- unigrams


def word_questions(blocks: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = pa.Table.from_batches([batch.slice(r, 1)])
                b = Block.read(one)
                counts = np.bincount(b.words[b.token_train()], minlength=len(b.vocabulary)).astype(np.uint32)
                cuts = np.searchsorted(range_of(b.vocabulary, parts), np.arange(parts + 1))
                rows = [(p, s, e) for p, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if e > s]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p, _, _ in rows], pa.int32()),
                        pa.array([one.column("block")[0].as_py()] * len(rows), pa.int64()),
                        pa.array([pack_sorted(b.vocabulary[s:e]) for _, s, e in rows], pa.binary()),
                        pa.array([pack(counts[s:e]) for _, s, e in rows], pa.binary()),
                    ],
                    names=["p", "block", "hashes", "counts"],
                )

    return blocks.mapInArrow(releasing(run), "p int, block long, hashes binary, counts binary")


def count_words(rows: pa.Table) -> pa.Table:
    """Answers (block, p, 2 * count + whether no other block holds the word) of one partition, and a
    last row without block: tokens, types, types by count."""
    hashes = [unpack_sorted(h.as_py(), np.uint64) for h in rows.column("hashes")]
    counts = np.concatenate([unpack(c.as_py(), np.uint32) for c in rows.column("counts")])
    _, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(which, counts).astype(np.uint32)
    sole = np.bincount(which) == 1  # one block holds the word
    answer = np.split(((total.astype(np.uint64) << np.uint64(1)) | sole.astype(np.uint64))[which], np.cumsum([len(h) for h in hashes])[:-1])
    by_count = np.bincount(np.minimum(total, TURING + 2), minlength=TURING + 3)
    summary = [int(total.sum(dtype=np.int64)), int((total > 0).sum()), *by_count[1 : TURING + 2].tolist()]
    n, p = rows.num_rows, rows.column("p")[0].as_py()
    return pa.table(
        {
            "block": pa.array([*rows.column("block").to_pylist(), None], pa.int64()),
            "p": pa.array([p] * (n + 1), pa.int32()), "kind": pa.array([0] * (n + 1), pa.int32()),
            "counts": pa.array([pack(a) for a in answer] + [None], pa.binary()), "stats": pa.array([None] * (n + 1), pa.binary()),
            "summary": pa.array([None] * n + [summary], pa.list_(pa.int64())),
        }
    )


ANSWER = "block long, p int, kind int, counts binary, stats binary, summary array<long>"


@dataclass
class Discounts:
    """Good-Turing: d[c] for counts up to TURING (index 0 unused), 1 beyond."""

    d: np.ndarray

    @classmethod
    def turing(cls, types: list[int]) -> "Discounts":
        """``types``: number of types with counts 1 .. TURING + 1."""
        n = np.array([0, *types], dtype=float)
        d = np.ones(TURING + 1)
        d[0] = 0.0
        common = (TURING + 1) * n[TURING + 1] / n[1] if n[1] else 1.0
        for c in range(1, TURING + 1):
            ratio = (c + 1) * n[c + 1] / (c * n[c]) if n[c] else 1.0
            value = (ratio - common) / (1 - common) if common < 1 else 0.0
            # where the counts of counts are too few for Good-Turing, an absolute discount
            d[c] = value if 0 < value < 1 else (c - 0.5) / c
        return cls(d)

    def mass(self, counts: np.ndarray) -> np.ndarray:
        small = np.minimum(counts, TURING).astype(np.int64)
        return np.where(counts > TURING, 1.0, self.d[small]) * counts


@dataclass
class Unigrams:
    tokens: int = 0
    types: int = 0
    discounts: Discounts = field(default_factory=lambda: Discounts(np.ones(TURING + 1)))
    unknown: float = 1.0

    @classmethod
    def of(cls, tokens: int, types: int, by_count: list[int]) -> "Unigrams":
        if not tokens:
            return cls()
        discounts = Discounts.turing(by_count)
        lost = sum(n * c * (1 - discounts.d[c]) for c, n in enumerate(by_count[:TURING], 1)) / tokens
        if lost <= 0:  # no small counts: one more type seen once
            return cls(tokens + 1, types, discounts, 1.0 / (tokens + 1))
        return cls(tokens, types, discounts, float(lost))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.mass(counts) / max(1, self.tokens), self.unknown)


# ---------------------------------------------------------------- bigrams


@dataclass
class Asked:
    """What a block asks about bigrams: selections of its distinct pairs by (kind, partition)."""

    rows: list[tuple[int, int, np.ndarray]]
    alone: np.ndarray  # pairs whose context no other block holds; their counts here are all there are
    context: np.ndarray  # local context of each pair
    word: np.ndarray


def ask(block: Block, pairs: np.ndarray, counts: np.ndarray, sole: np.ndarray, tokens: int, parts: int) -> Asked:
    """Deal the pairs out: whole contexts by their hash (kind 0), split contexts by the pair's hash (kind 1)."""
    width = len(block.vocabulary) + 1
    context, word = (pairs // width).astype(np.int32), (pairs % width).astype(np.int32)
    end = int(np.searchsorted(block.vocabulary, END))
    times = np.append(counts, counts[end])  # the start context occurs once a text
    hashes = np.append(block.vocabulary, START)
    split = times * SPLIT > tokens
    own = range_of(mix(hashes), parts)
    # groups: partitions of whole contexts, then those of split contexts, then those of this block alone, then untrained ones
    home = np.where(np.append(sole, False), 2 * parts, own)
    group = np.where(times > 0, home, 2 * parts + 1).astype(np.int32)[context]
    spread = np.flatnonzero(split[context] & (group < 2 * parts))
    group[spread] = parts + range_of(mix(hashes[context[spread]] ^ mix(block.vocabulary[word[spread]])), parts)
    order = np.argsort(group, kind="stable")
    ends = np.searchsorted(group[order], np.arange(2 * parts + 1), side="right")
    starts = np.r_[0, ends[:-1]]
    *rows, (_, _, alone) = [(g // parts, g % parts, order[s:e]) for g, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)) if e > s or g == 2 * parts]
    return Asked(rows, alone, context, word)


def context_stats(own: np.ndarray, total: np.ndarray, lower: np.ndarray, n: int) -> np.ndarray:
    """The ``STATS`` of ``n`` contexts from their distinct bigrams: context, training count, P of the word."""
    stats = np.zeros((n, STATS))
    for c in range(2, TURING + 1):
        stats[:, c - 2] = np.bincount(own[total == c], minlength=n)
    large = total > TURING
    stats[:, -2] = np.bincount(own[large], total[large], minlength=n)
    seen = total > 0
    stats[:, -1] = np.bincount(own[seen], lower[seen], minlength=n)
    return stats


def types_by_count(total: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(total, TURING + 2), minlength=TURING + 3)[1 : TURING + 2].tolist()


def assemble(block: Block, answers: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of the block's words out of the partitions' answers, and which words no other block holds."""
    mine = answers.filter(pc.is_null(answers.column("stats")))
    order = np.argsort(mine.column("p").to_numpy())
    data = mine.column("counts")
    both = np.concatenate([unpack(data[int(i)].as_py(), np.int64) for i in order]) if len(order) else np.zeros(0, np.int64)
    return both >> 1, (both & 1).astype(bool)


def bigram_questions(unigrams: Unigrams, tokens: int, parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release_memory()
        try:
            return work(left, right)
        finally:
            release_memory()

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.read(left)
        counts, sole = assemble(block, right, parts)
        pairs, _, seen = block.bigrams()
        asked = ask(block, pairs, counts, sole, tokens, parts)
        out = {k: [] for k in ("p", "kind", "contexts", "runs", "words", "word_counts", "counts")}
        hashes = np.append(block.vocabulary, START)
        for kind, p, rows in asked.rows:
            h = hashes[asked.context[rows]]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            out["p"].append(p)
            out["kind"].append(kind)
            out["contexts"].append(pack_sorted(h[first]))
            out["runs"].append(pack(np.diff(np.r_[first, len(h)]).astype(np.uint32)))
            short = block.vocabulary[asked.word[rows]] >> np.uint64(16)
            out["words"].append(np.ascontiguousarray(short.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes())
            out["word_counts"].append(pack(counts[asked.word[rows]].astype(np.uint32)))
            out["counts"].append(pack(seen[rows].astype(np.uint32)))
        key = left.column("block")[0].as_py()
        if len(asked.alone):  # a row without question: types by count of the contexts of this block alone
            rest = {"p": key % parts, "kind": 3, "counts": np.array(types_by_count(seen[asked.alone]), np.int64).tobytes()}
            for k, v in out.items():
                v.append(rest.get(k))
        kinds = {"p": pa.int32(), "kind": pa.int32()}
        n = len(out["p"])
        return pa.table({"block": pa.array([key] * n, pa.int64()), **{k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()}})

    return run


def count_bigrams(unigrams: Unigrams):
    """Answers of one partition: counts per asked pair, sums per asked context; a last row with
    types by count; split contexts' partial sums in rows of their own (kind 2, p the index).
    Rows of kind 3 bring types by count that only have to be added up."""

    def run(rows: pa.Table) -> pa.Table:
        try:
            return work(rows)
        finally:
            release_memory()

    def work(rows: pa.Table) -> pa.Table:
        kind, p = rows.column("kind")[0].as_py(), rows.column("p")[0].as_py()
        names = ["block", "p", "kind", "counts", "stats", "summary"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        if kind == 3:
            out = [(None, p, kind, None, None, sum(np.frombuffer(c.as_py(), np.int64) for c in rows.column("counts")).tolist())]
            return pa.table({c: pa.array([o[k] for o in out], t) for k, (c, t) in enumerate(zip(names, kinds, strict=True))})
        contexts, runs, words, word_counts, counts = [], [], [], [], []
        for i in range(rows.num_rows):
            contexts.append(unpack_sorted(rows.column("contexts")[i].as_py(), np.uint64))
            runs.append(unpack(rows.column("runs")[i].as_py(), np.uint32).astype(np.int64))
            six = np.frombuffer(rows.column("words")[i].as_py(), np.uint8).reshape(6, -1).T
            wide = np.zeros((len(six), 8), np.uint8)
            wide[:, :6] = six
            words.append(wide.view(np.uint64).ravel())
            word_counts.append(unpack(rows.column("word_counts")[i].as_py(), np.uint32))
            counts.append(unpack(rows.column("counts")[i].as_py(), np.uint32))
        sizes, context_sizes = [len(w) for w in words], [len(c) for c in contexts]
        unique, context = np.unique(np.concatenate(contexts), return_inverse=True)
        per_pair = np.repeat(context.astype(np.int32), np.concatenate(runs))
        word, word_count = np.concatenate(words), np.concatenate(word_counts)
        del words, word_counts, runs
        order = np.lexsort((word, per_pair))
        new = np.r_[True, (per_pair[order][1:] != per_pair[order][:-1]) | (word[order][1:] != word[order][:-1])]
        group = np.cumsum(new) - 1
        total = np.bincount(group, np.concatenate(counts)[order]).astype(np.int64)
        pair_total = np.empty(len(order), np.int64)
        pair_total[order] = total[group]
        heads = order[np.flatnonzero(new)]
        stats = context_stats(per_pair[heads], total, unigrams.probability(word_count[heads].astype(np.int64)), len(unique))
        by_count = types_by_count(total)
        pair_answers = np.split(pair_total.astype(np.uint32), np.cumsum(sizes)[:-1])
        context_answers = np.split(context, np.cumsum(context_sizes)[:-1])
        blocks = rows.column("block").to_pylist()
        out = [(b, p, kind, pack(a), b"" if kind else pack(stats[c].ravel()), None) for b, a, c in zip(blocks, pair_answers, context_answers, strict=True)]
        out.append((None, p, kind, None, None, by_count))
        if kind:
            out.append((None, p, 2, unique.tobytes(), stats.tobytes(), None))
        return pa.table({c: pa.array([o[k] for o in out], t) for k, (c, t) in enumerate(zip(names, kinds, strict=True))})

    return run


def backoff(stats: np.ndarray, context_count: np.ndarray, discounts: Discounts) -> tuple[np.ndarray, np.ndarray]:
    """alpha(h) and the divisor of the counts after h, from the sums of its bigrams.

    Without bigrams alpha is 1. Where no count is discounted (all large) nothing would be
    left for other words; the divisor is then one more than c(h).
    """
    small = stats[:, : STATS - 2] * np.arange(2, TURING + 1)
    once = context_count - small.sum(axis=1) - stats[:, -2]
    mass = once * discounts.d[1] + small @ discounts.d[2:] + stats[:, -2]
    divisor = np.maximum(np.where(mass > context_count - 1e-9, context_count + 1, context_count), 1)
    alpha = (1 - mass / divisor) / np.maximum(1 - stats[:, -1], 1e-300)
    return np.where(stats[:, -1] > 0, alpha, 1.0), divisor


def scores(unigrams: Unigrams, tokens: int, types: int, discounts: Discounts, split: dict[int, np.ndarray], parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release_memory()
        try:
            return work(left, right)
        finally:
            release_memory()

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.read(left)
        answers = {(k, p): i for i, (k, p) in enumerate(zip(right.column("kind").to_pylist(), right.column("p").to_pylist(), strict=True)) if right.column("stats")[i].is_valid}
        counts, sole = assemble(block, right, parts)
        pairs, which, seen = block.bigrams()
        asked = ask(block, pairs, counts, sole, tokens, parts)
        end = int(np.searchsorted(block.vocabulary, END))
        context_counts = np.append(counts, counts[end]).astype(np.float64)
        hashes = np.append(block.vocabulary, START)
        alpha, divisor = np.ones(len(hashes)), np.ones(len(hashes))
        pair_count = np.zeros(len(pairs), np.int64)
        for kind, p, rows in asked.rows:
            i = answers[kind, p]
            pair_count[rows] = unpack(right.column("counts")[i].as_py(), np.uint32)
            own = asked.context[rows]
            own = own[np.flatnonzero(np.r_[True, own[1:] != own[:-1]])]
            if kind == 0:
                stats = unpack(right.column("stats")[i].as_py(), np.float64).reshape(-1, STATS)
            else:
                stats = np.stack([split[int(h)] for h in hashes[own]])
            alpha[own], divisor[own] = backoff(stats, context_counts[own], discounts)
        probability = unigrams.probability(counts)
        lower = np.log10(probability)
        context = asked.context
        if len(asked.alone):
            pair_count[asked.alone] = seen[asked.alone]
            own, which_own = np.unique(context[asked.alone], return_inverse=True)
            stats = context_stats(which_own, pair_count[asked.alone], probability[asked.word[asked.alone]], len(own))
            alpha[own], divisor[own] = backoff(stats, context_counts[own], discounts)
        direct = discounts.mass(pair_count) / divisor[context]
        logs = np.where(pair_count > 0, np.log10(np.where(pair_count > 0, direct, 1.0)), np.log10(alpha)[context] + lower[asked.word])
        starts = np.cumsum(block.sizes) - block.sizes
        base = np.log10((counts + 1) / (tokens + 1 * (types + 1)))
        n = len(block.sizes)
        add = lambda v: np.add.reduceat(v, starts)  # noqa: E731  every text has its end token
        return pa.table(
            {
                "doc_id": block.doc_ids.cast(pa.int64()), "train": pa.array(block.train), "n_tokens": pa.array(block.sizes), "n_known": pa.array(add((counts > 0)[block.words].astype(np.int64))),
                "train_tokens": pa.array(np.full(n, tokens, np.int64)), "base_score": pa.array(add(base[block.words])), "score": pa.array(add(logs[which])),
            }
        )

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_col: str = "train") -> DataFrame:
    """Train on the rows where ``train_col`` holds and score every row (log10): doc_id, train,
    n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(train_col), F.lit(False)).alias("train"))
    blocks = blocks_of(slim, parts)
    words = durable(word_questions(blocks, parts).groupBy("p").applyInArrow(count_words, ANSWER), "katz_words", "zstd")
    give_back(spark)

    def totals(answers: DataFrame) -> list[int]:
        sums = answers.where("summary is not null").select(F.posexplode("summary").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).orderBy("i")
        return [r["n"] for r in sums.collect()]

    tokens, types, *by_count = totals(words) or [0, 0]
    unigrams = Unigrams.of(tokens, types, by_count)
    replies = words.where("block is not null").drop("summary")
    asked = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        bigram_questions(unigrams, tokens, parts), "block long, p int, kind int, contexts binary, runs binary, words binary, word_counts binary, counts binary"
    )
    bigrams = durable(asked.groupBy("kind", "p").applyInArrow(count_bigrams(unigrams), ANSWER), "katz_bigrams", "zstd")
    give_back(spark)  # the questions, before the answers are shuffled
    bigram_types = totals(bigrams) or [0] * (TURING + 1)
    discounts = Discounts.turing(bigram_types)
    split: dict[int, np.ndarray] = {}
    for r in bigrams.where("kind = 2").select("counts", "stats").toLocalIterator():
        for h, s in zip(np.frombuffer(r["counts"], np.uint64).tolist(), np.frombuffer(r["stats"]).reshape(-1, STATS), strict=True):
            split[h] = split.get(h, 0) + s
    all_replies = replies.unionByName(bigrams.where("block is not null").drop("summary"))
    schema = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(all_replies.groupBy("block")).applyInArrow(scores(unigrams, tokens, types, discounts, split, parts), schema)


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 7) != 2).alias("train"))
    return score(docs).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
