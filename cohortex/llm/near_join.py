"""Set similarity join of documents: Jaccard over word shingles, multiple global orders.

A document's set is its distinct five-word shingles (64-bit hashes, see ``words``). Two
documents link when 100 * |A and B| >= 75 * |A or B|; the classes are the connected parts.

1. Documents with equal sets form one node (grouped by a 128-bit digest of the set).
2. Nodes that share the least shingle under one of ``STAR_ORDERS`` hash orders form a group;
   its centre is the node whose least shingles are the most common ones. Nodes that agree
   with a centre in ``STAR_AGREE`` orders are compared with it, a linear number of pairs, in
   ``STAR_ROUNDS`` rounds with other centres for what is left. Verified links merge most
   near copies, so that later no step writes out all pairs of a group.
3. Prefix filter under the first global order: frequent shingles last, others by hash.
   Frequent are shingles that many parts of step 2 share (counted over one document of each
   part, so that copies do not count; the ``FREQUENT`` most frequent are broadcast, 8 bytes
   each).
   Linked sets share a shingle among their first |A| - ceil(0.75 |A|) + 1. Prefix shingles
   are shuffled and sorted by shingle; only pairs from different parts of step 2 with
   compatible sizes are counted, and a candidate must share as many prefix shingles as the
   least possible intersection of a link leaves in both prefixes (see ``least_shared``).
   Unlike one shared shingle, that is not met by a passage two documents share. A posting list longer than ``BLOCK`` (counted
   over a sample of the nodes' postings) is dealt into blocks, and each pair of blocks is a
   task of its own. In a list only nodes outside its largest part meet the others. A node that
   meets a part of at least ``LARGE_PART`` nodes is written down once with the part, not with
   each of its members: any link to one of them settles the matter.
4. Candidates must share as many prefix shingles under the second and the third order too;
   pairs that pass all filters are verified exactly on the whole sets. For a node and a large
   part that happens in tasks that hold some of the part's members (``MEMBER_SHINGLES``) and
   stream the nodes past them; only the link found is written.
5. Connected parts by least-label propagation with pointer jumping.

No link is lost: every filter is a necessary condition, nothing is capped. Links inside a
part of step 2 add nothing to the classes and are not written out.

Defined results: a text without words (or null) has an empty set and links with nothing. A
text of one to four words is one shingle, so it links only with the same words. Repeated
rows and ids are ordinary documents (rows are told apart by set, not by id). The component
id is the least non-null doc_id of the part, null if it has none. An empty table gives an
empty result. ``membership`` reads id and text only; ``deduplicate`` keeps every column, whatever
its name, and exactly one row of each group, one with the least id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.llm.common import durable, give_back, positional, releasing, table
from cohortex.llm.words import mix, shingle_sets

WIDTH = 5
THRESHOLD = 75  # per cent
STAR_ORDERS = 8
STAR_AGREE = 3
STAR_ROUNDS = 6
FREQUENT = 1 << 17
LOCAL_COUNT = 3
GLOBAL_COUNT = 8
BLOCK = 50_000
LIST_SAMPLE = 1_000  # sampled members of a list of ``BLOCK`` nodes
LARGE_PART = 64  # parts of step 2 with at least this many nodes are met as a whole
MEMBER_SHINGLES = 250_000  # shingles of a large part's members that one task holds
SMALL_ROWS = 1_000_000  # a slim table of at most this many rows (about 32 MB) may be broadcast

#: how a node names the document that stands for it
NODE = ["doc", "h", "d1", "d2", "twice"]

_ORDERS = np.arange(1, 129, 2, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
#: odd factors: each puts the hashes, which are random already, into another order
_STARS = _ORDERS[3:] | np.uint64(1)


def order_key(tokens: np.ndarray, order: int) -> np.ndarray:
    """The place of a shingle in a global order; order 0 is the hash itself."""
    return tokens if order == 0 else mix(tokens ^ _ORDERS[order])


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    return n - -(-threshold * n // 100) + 1


def prefix(tokens: np.ndarray, frequent: np.ndarray, order: int, threshold: int = THRESHOLD) -> np.ndarray:
    """The first shingles of a set under a global order that puts frequent shingles last."""
    p = prefix_length(len(tokens), threshold)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        late = frequent[at] == tokens
    else:
        late = np.zeros(len(tokens), dtype=bool)
    key = order_key(tokens, order)
    if p >= len(tokens):
        return tokens
    return tokens[np.lexsort((key, late))[:p]]


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def signatures(docs: DataFrame, width: int, star_orders: int) -> DataFrame:
    """One row per document: doc_id, h (hash of the text), n, digest (d1, d2), least shingle under each star order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d1, d2, firsts = [], [], [], []
            for _, tokens in shingle_sets(batch.column(1), width):
                n.append(len(tokens))
                one, two = digest(tokens)
                d1.append(one)
                d2.append(two)
                firsts.append((tokens * _STARS[:star_orders, None]).min(axis=1).view(np.int64) if len(tokens) else tokens.view(np.int64))
            if n:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n, pa.int64()), _longs(np.array(d1, np.uint64)), _longs(np.array(d2, np.uint64)), _lists(firsts, pa.int64())],
                    names=["doc_id", "h", "n", "d1", "d2", "firsts"],
                )

    return docs.mapInArrow(releasing(run), "doc_id long, h long, n long, d1 long, d2 long, firsts array<long>")


def frequent_shingles(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(token, n): the shingles that most of ``nodes`` hold, at most ``FREQUENT`` rows.

    A batch reports what at least ``LOCAL_COUNT`` of its documents share; n counts those.
    """

    def make(rows) -> Iterator[pa.RecordBatch]:
        sets = [tokens for _, tokens, d1, d2, _ in rows if _stands(tokens, d1, d2)]
        if sets:
            tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= LOCAL_COUNT
            yield pa.RecordBatch.from_arrays([_longs(tokens[often]), pa.array(counts[often].astype(np.int64))], names=["token", "n"])

    counted = _with_sets(docs, nodes, width, "token long, n long", make).groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= GLOBAL_COUNT)
    return durable(counted.orderBy(F.col("n").desc(), "token").limit(FREQUENT), "near_frequent")


def _small(df: DataFrame) -> DataFrame:
    """The slim table with a broadcast hint if it is proven small, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _with_sets(docs: DataFrame, nodes: DataFrame, width: int, schema: str, make: Callable) -> DataFrame:
    """Run ``make(node row, shingle set) -> list of rows`` for the documents that stand for ``nodes``.

    ``nodes``: ``NODE`` and further columns. A document stands for a node by its id and the
    hash of its text (ids may be null or repeat with different texts); of rows that repeat
    both (``twice``) one is taken.
    """
    other = nodes.withColumnRenamed("h", "_h")
    joined = docs.join(_small(other), F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("h") == F.col("_h")))
    extra = [c for c in nodes.columns if c not in NODE]
    if not nodes.where("twice").isEmpty():
        joined = joined.where("not twice").unionByName(joined.where("twice").dropDuplicates(["d1", "d2"]))
    joined = joined.select("text", "d1", "d2", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = (batch.column(k).to_numpy().view(np.uint64) for k in (1, 2))
            columns = [batch.column(3 + k).to_numpy() for k in range(len(extra))]
            yield from make(((i, t, d1[i], d2[i], columns) for i, t in shingle_sets(batch.column(0), width)))

    return joined.mapInArrow(releasing(run), schema)


def digest(tokens: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two 64-bit sums over a set of random hashes: of the hashes (and their number) and of their squares."""
    return tokens.sum(dtype=np.uint64) + np.uint64(len(tokens) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF), (tokens * tokens).sum(dtype=np.uint64)


def _stands(tokens: np.ndarray, d1: np.uint64, d2: np.uint64) -> bool:
    return digest(tokens) == (d1, d2)


def _compatible(a: Column, b: Column, threshold: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def least_shared(a: Column, b: Column, threshold: int) -> Column:
    """Shingles that two linked sets of sizes a and b share among their prefixes, under any order.

    Linked sets share o >= t / (1 + t) * (a + b) shingles. A prefix leaves out ceil(t * size) - 1
    shingles of its set, so it holds all but as many of the shared ones, the first ones in the
    order; the smaller of the two beginnings lies in both prefixes.
    """
    shared = (a + b) * threshold + F.lit(99 + threshold)
    largest = F.greatest(a, b) * threshold + F.lit(99)
    return F.floor(shared / F.lit(100 + threshold)).cast("long") - F.floor(largest / F.lit(100)).cast("long") + 1


def node_sets(docs: DataFrame, nodes: DataFrame, ends: DataFrame, frequent: np.ndarray, width: int, threshold: int, name: str) -> DataFrame:
    """node, prefixes under orders 1 and 2, shingles of the nodes in ``ends``."""
    wanted = durable(nodes.join(ends, "node", "left_semi").select(*NODE, "node"), f"near_{name}_nodes")

    def make(rows) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), _lists([o[1] for o in out], pa.int64()), _lists([o[2] for o in out], pa.int64()), _lists([o[3] for o in out], pa.int64())],
                names=["node", "p1", "p2", "tokens"],
            )
            out.clear()
            return batch

        held = 0
        for i, tokens, d1, d2, (node,) in rows:
            if _stands(tokens, d1, d2):
                p1, p2 = (prefix(tokens, frequent, k, threshold).view(np.int64) for k in (1, 2))
                out.append((int(node[i]), p1, p2, tokens.view(np.int64)))
                held += len(tokens)
                if held > 1_000_000:
                    yield flush()
                    held = 0
        if out:
            yield flush()

    return durable(_with_sets(docs, wanted, width, "node long, p1 array<long>, p2 array<long>, tokens array<long>", make), f"near_{name}_sets")


def verified_links(sets: DataFrame, pairs: DataFrame, threshold: int, name: str) -> DataFrame:
    """The pairs (a, b, need) that share ``need`` prefix shingles under orders 1 and 2 and whose sets are similar enough."""

    def side(end: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])

    filtered = (
        pairs.join(side("a", "p1", "p2"), "a").join(side("b", "p1", "p2"), "b")
        .where((F.size(F.array_intersect("p1_a", "p1_b")) >= F.col("need")) & (F.size(F.array_intersect("p2_a", "p2_b")) >= F.col("need")))
        .select("a", "b")
    )
    both = filtered.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - common
    return durable(both.where(common * 100 >= union * threshold).select("a", "b").distinct(), f"near_{name}_links")


def part_links(sets: DataFrame, keyed: DataFrame, large: DataFrame, met: DataFrame, threshold: int) -> DataFrame:
    """(a, b): for every node and large part in ``met`` (a, part), a linked member of each block of the part, if there is one.

    A part's members are dealt into blocks; a task holds a block and streams the nodes past it.
    Shared prefix shingles under orders 1 and 2 are counted first, what is left is verified.
    """
    blocks = large.select("part", F.ceil(F.col("shingles") / MEMBER_SHINGLES).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node", F.lit("member")), F.col("blocks")).cast("int")
    members = keyed.select("node", "part").join(met.select("part").distinct(), "part", "left_semi").join(blocks, "part")
    held = members.join(sets, "node").select("part", own.alias("block"), F.lit(0).alias("kind"), "node", "p1", "p2", "tokens")
    asked = met.join(blocks, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = asked.join(sets, F.col("a") == F.col("node")).select("part", "block", F.lit(1).alias("kind"), "node", "p1", "p2", "tokens")
    dealt = held.unionByName(asked).repartition("part", "block").sortWithinPartitions("part", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, block = None, [], None
        for batch in batches:
            a, b = [], []
            where = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            lists = [[np.asarray(x.values) if x.is_valid else np.zeros(0, np.int64) for x in batch.column(k)] for k in (4, 5, 6)]
            for i, (part, number, kind, node) in enumerate(where):
                if (part, number) != now:
                    now, inside, block = (part, number), [], None
                if kind == 0:
                    inside.append((node, *(column[i].copy() for column in lists)))
                    continue
                block = block or _Members(inside)
                hit = block.linked(*(column[i] for column in lists), threshold)
                if hit is not None:
                    a.append(node)
                    b.append(hit)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return durable(dealt.mapInArrow(releasing(run), "a long, b long"), "near_part_links")


class _Members:
    """Some members of a part: their prefixes by shingle, their sets."""

    def __init__(self, rows: list[tuple]):
        self.nodes, self.sets = [r[0] for r in rows], [np.sort(r[3]) for r in rows]
        self.n = np.array([len(s) for s in self.sets], np.int64)
        self.prefixes = []
        for k in (1, 2):
            flat = np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, np.int64)
            order = np.argsort(flat, kind="stable")
            self.prefixes.append((flat[order], np.repeat(np.arange(len(rows)), [len(r[k]) for r in rows])[order]))

    def shared(self, k: int, prefix: np.ndarray) -> np.ndarray:
        """How many shingles of ``prefix`` each member has in its own prefix."""
        flat, owner = self.prefixes[k]
        low, high = np.searchsorted(flat, prefix, "left"), np.searchsorted(flat, prefix, "right")
        size = high - low
        at = np.repeat(low, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.bincount(owner[at], minlength=len(self.nodes))

    def linked(self, p1: np.ndarray, p2: np.ndarray, tokens: np.ndarray, threshold: int) -> int | None:
        """A member whose set is similar enough."""
        if not self.nodes:
            return None
        n = len(tokens)
        least, most = np.minimum(self.n, n), np.maximum(self.n, n)
        need = ((self.n + n) * threshold + 99 + threshold) // (100 + threshold) - (most * threshold + 99) // 100 + 1
        left = (least * 100 >= most * threshold) & (self.shared(0, p1) >= need)
        if left.any():
            left &= self.shared(1, p2) >= need
        own = np.sort(tokens)
        for i in np.flatnonzero(left):
            common = len(np.intersect1d(own, self.sets[i], assume_unique=True))
            if common * 100 >= (n + int(self.n[i]) - common) * threshold:
                return self.nodes[i]
        return None


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def merge(parts: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``parts`` (node, part, ...) after the links' parts have become one."""
    of = parts.select("node", "part")
    across = (
        links.join(of.select(F.col("node").alias("a"), F.col("part").alias("pa")), "a")
        .join(of.select(F.col("node").alias("b"), F.col("part").alias("pb")), "b")
        .where("pa <> pb")
        .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        .distinct()
    )
    whole = connected_parts(across, name).select(F.col("node").alias("part"), F.col("part").alias("_whole"))
    return durable(parts.join(whole, "part", "left").withColumn("part", F.coalesce("_whole", "part")).select(*parts.columns), f"near_{name}_parts")


def connected_parts(links: DataFrame, name: str) -> DataFrame:
    """(node, part) of every node that has a link; part is the least node of its connected part."""
    edges = durable(links.select("a", "b").union(links.select("b", "a")).distinct(), f"near_{name}_edges")
    labels = durable(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("part")).withColumnRenamed("a", "node"), f"near_{name}_labels0")
    step = 0
    while True:
        step += 1
        known = labels.select(F.col("node").alias("b"), "part")
        least = edges.join(known, "b").groupBy("a").agg(F.min("part").alias("near")).withColumnRenamed("a", "node")
        nearer = labels.join(least, "node").select("node", F.col("part").alias("old"), F.least("part", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("part").alias("far"))
        labels = durable(nearer.join(jump, "next").select("node", "old", F.least("next", "far").alias("part")), f"near_{name}_labels{step}")
        if labels.where("old <> part").isEmpty():
            return labels.select("node", "part")
        labels = labels.select("node", "part")


def star_keys(nodes: DataFrame) -> DataFrame:
    """(k, first, node, n, weight) of nodes that share a least shingle with others.

    weight: how common a node's least shingles are; the copy nearest to the others has the most common ones.
    """
    keys = nodes.select("node", "n", F.posexplode("firsts").alias("k", "first"))
    sizes = keys.groupBy("k", "first").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = keys.join(sizes, ["k", "first"])
    return durable(shared.drop("size").join(shared.groupBy("node").agg(F.sum("size").alias("weight")), "node"), "near_star_keys")


def star_pairs(keys: DataFrame, threshold: int) -> DataFrame:
    """Nodes with the heaviest node of each of their groups, where enough orders agree and the parts differ."""
    centres = keys.groupBy("k", "first").agg(F.max(F.struct("weight", "node", "n", "part")).alias("c"))
    pairs = keys.join(centres, ["k", "first"]).where((F.col("part") != F.col("c.part")) & _compatible(F.col("n"), F.col("c.n"), threshold))
    agreeing = pairs.groupBy(F.col("c.node").alias("a"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("c.n").alias("na")).count()
    return agreeing.where(F.col("count") >= STAR_AGREE).select("a", "b", least_shared(F.col("na"), F.col("nb"), threshold).alias("need"))


def star_parts(docs: DataFrame, nodes: DataFrame, width: int, threshold: int) -> DataFrame:
    """(node, part) of all nodes after ``STAR_ROUNDS`` rounds of comparisons with group centres.

    The first round takes the most typical node of a group, the others another typical one, so
    a node that missed the centre meets another copy that has most in common with the group. Rounds are linear in the
    nodes and end when nothing is left to compare.
    """
    keys = star_keys(nodes)
    parts = nodes.select("node", F.col("node").alias("part"))
    sets = None
    for r in range(STAR_ROUNDS):
        # later rounds: another of the most typical nodes of the group, by chance
        chance = F.pmod(F.xxhash64("node", F.lit(r)), F.lit(1 << 20)) / float(1 << 20)
        weight = F.col("weight") * (1.0 if r == 0 else 1 - 0.3 * chance)
        pairs = durable(star_pairs(keys.join(parts, "node").withColumn("weight", weight), threshold), f"near_star{r}_pairs")
        if pairs.isEmpty():
            break
        if sets is None:
            sets = node_sets(docs, nodes, ends_of(pairs), np.zeros(0, np.uint64), width, threshold, "star")
            keys = durable(keys.join(sets.select("node").distinct(), "node", "left_semi"), "near_star_left")
        links = verified_links(sets, pairs, threshold, f"star{r}")
        if not links.isEmpty():
            parts = merge(parts, links, f"star{r}")
        give_back(docs.sparkSession)  # a round's plans, broadcasts and shuffles
    return parts


def postings(docs: DataFrame, nodes: DataFrame, frequent: np.ndarray, width: int, threshold: int) -> DataFrame:
    """(token, node, n, part, big) for every prefix shingle under order 0."""

    def make(rows) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            sizes = [len(o[0]) for o in out]
            arrays = [_longs(np.concatenate([o[0] for o in out]))] + [pa.array(np.repeat(np.array([o[k] for o in out], np.int64), sizes)) for k in (1, 2, 3, 4)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["token", "node", "n", "part", "big"])

        for i, tokens, d1, d2, (node, part, big) in rows:
            if _stands(tokens, d1, d2):
                p = prefix(tokens, frequent, 0, threshold)
                out.append((p, int(node[i]), len(tokens), int(part[i]), int(big[i])))
                held += len(p)
                if held > 200_000:
                    yield flush()
                    held = 0
        if out:
            yield flush()

    return _with_sets(docs, nodes, width, "token long, node long, n long, part long, big long", make)


def _cross_pairs(node: np.ndarray, n: np.ndarray, part: np.ndarray, side: np.ndarray, threshold: int) -> Iterator[tuple]:
    """Pairs (a < b, their sizes) from different parts with compatible sizes; of two blocks only pairs across them.

    Only nodes outside the largest part are compared with the others.
    """
    names, which = np.unique(part, return_inverse=True)
    outside = which != np.bincount(which, minlength=len(names)).argmax()
    order = np.argsort(~outside, kind="stable")
    node, n, part, side, outside = node[order], n[order], part[order], side[order], outside[order]
    two = side.any() and not side.all()
    for i in range(int(outside.sum())):
        others = slice(i + 1, None)  # earlier ones have met this node
        ok = (part[others] != part[i]) & (np.minimum(n[others], n[i]) * 100 >= np.maximum(n[others], n[i]) * threshold)
        if two:
            ok &= side[others] != side[i]
        if ok.any():
            far, size = node[others][ok], n[others][ok]
            first = far < node[i]
            yield np.minimum(far, node[i]), np.maximum(far, node[i]), np.where(first, size, n[i]), np.where(first, n[i], size)


def _with_parts(node: np.ndarray, n: np.ndarray, part: np.ndarray, big: np.ndarray, threshold: int) -> Iterator[tuple]:
    """(node, large part, size, -1) of the nodes of a list that meet a member of another, large part.

    Of two large parts the one with fewer nodes in the list gives the nodes.
    """
    names, counts = np.unique(part[big], return_counts=True)
    own = np.zeros(len(node), np.int64)  # nodes of one's own large part in the list
    own[big] = counts[np.searchsorted(names, part[big])]
    for name, count in zip(names, counts, strict=True):
        members = n[big & (part == name)]
        near = (members.min() * threshold <= n * 100) & (n * threshold <= members.max() * 100)
        gives = (part != name) & near & ((own < count) | ((own == count) & (part < name)))
        if gives.any():
            yield node[gives], np.full(int(gives.sum()), name), n[gives], np.full(int(gives.sum()), -1)


def long_lists(rows: DataFrame, sample: int) -> DataFrame:
    """(token, n): the length of each posting list, estimated from the postings of one in ``sample`` nodes."""
    return rows.groupBy("token").agg((F.count(F.lit(1)) * sample).alias("n"))


def candidate_pairs(rows: DataFrame, often: DataFrame, threshold: int, block: int = BLOCK) -> DataFrame:
    """(a, b, na, nb, times, need): nodes of different parts that share enough prefix shingles.

    ``often`` (token, n) holds the lists that may be long. Where nb is -1, b is a large part of
    which some member shares a prefix shingle with a.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def pairs(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, node, n, part, big, side = columns
            big = big.astype(bool)
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            ends = np.r_[starts[1:], len(key)]
            mixed = np.flatnonzero((np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts))) if len(key) else []
            found: list[tuple] = []
            size = 0
            for r in mixed:
                s = slice(starts[r], ends[r])
                few = np.flatnonzero(~big[s]) + starts[r]
                each = [_cross_pairs(node[few], n[few], part[few], side[few], threshold)] if len(few) else []
                if len(few) < ends[r] - starts[r]:
                    each.append(_with_parts(node[s], n[s], part[s], big[s], threshold))
                for pair in chain(*each):
                    found.append(pair)
                    size += len(pair[0])
                    if size > 200_000:
                        yield emit(found)
                        found, size = [], 0
            if found:
                yield emit(found)

        def emit(found: list) -> pa.RecordBatch:
            a, b, na, nb = (np.concatenate([f[k] for f in found]) for k in range(4))
            order = np.lexsort((b, a))
            a, b, na, nb = a[order], b[order], na[order], nb[order]
            starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            times = np.diff(np.r_[starts, len(a)])
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[starts], b[starts], na[starts], nb[starts], times)], names=["a", "b", "na", "nb", "times"])

        for batch in batches:
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            if held is not None:
                now = [np.concatenate([h, c]) for h, c in zip(held, now, strict=True)]
            key = now[0]
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))  # the last run may go on in the next batch
            yield from pairs([c[:last] for c in now])
            held = [c[last:] for c in now]
        if held is not None:
            yield from pairs(held)

    plain = rows.select(F.col("token").alias("key"), "node", "n", "part", "big", F.lit(False).alias("side"))
    # long posting lists: deal the nodes into blocks; each pair of blocks meets under a key of its own
    spread_lists = often.where(F.col("n") > block).select(F.col("token").alias("long"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    if not spread_lists.isEmpty():
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        spread = rows.join(spread_lists, F.col("token") == F.col("long")).withColumn("own", own)
        keyed = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other"), F.lit("block")).alias("key"),
            "node",
            "n",
            "part",
            "big",
            (F.col("own") > F.col("other")).alias("side"),
        )
        plain = plain.join(spread_lists, F.col("key") == F.col("long"), "left_anti").unionByName(keyed)
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = plain.repartition(parts, "key").sortWithinPartitions("key")
    met = dealt.mapInArrow(releasing(run), "a long, b long, na long, nb long, times long").groupBy("a", "b", "na", "nb").agg(F.sum("times").alias("times"))
    return met.withColumn("need", least_shared(F.col("na"), F.col("nb"), threshold)).where("nb < 0 or times >= need")


def _members(df: DataFrame, id_col: str, text_col: str, width: int = WIDTH, threshold: int = THRESHOLD, star_orders: int = STAR_ORDERS) -> DataFrame:
    """One row per input row: doc_id, h (hash of the text), n, part (null: no words), component_id."""
    text = F.col(text_col).cast("string")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    rows = durable(signatures(docs, width, star_orders), "near_signatures")
    texts = rows.where("n > 0").groupBy("d1", "d2", "doc_id", "h").agg(F.count(F.lit(1)).alias("times"), F.first("n").alias("n"), F.first("firsts").alias("firsts"))
    nodes = durable(
        texts.groupBy("d1", "d2")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "times")).alias("least"), F.first("n").alias("n"), F.first("firsts").alias("firsts"))
        .select("d1", "d2", F.col("least.doc_id").alias("doc"), F.col("least.h").alias("h"), (F.col("least.times") > 1).alias("twice"), "n", "firsts")
        .withColumn("node", F.monotonically_increasing_id()),
        "near_nodes",
    )
    give_back(df.sparkSession)
    parts = durable(nodes.drop("firsts").join(star_parts(docs, nodes, width, threshold), "node"), "near_parts")
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    large = durable(sizes.where(F.col("members") >= LARGE_PART), "near_large_parts")
    flagged = parts.select(*NODE, "node", "part").join(large.select("part", F.lit(1).cast("long").alias("big")), "part", "left")
    keyed = durable(flagged.select(*NODE, "node", "part", F.coalesce("big", F.lit(0).cast("long")).alias("big")), "near_keyed")
    often = frequent_shingles(docs, keyed.where("node = part").select(*NODE), width)
    frequent = np.sort(np.array([r["token"] for r in often.select("token").collect()], dtype=np.int64).view(np.uint64))
    # a list can only be long among many nodes; its length is that of the sampled nodes' lists
    sample = max(1, BLOCK // LIST_SAMPLE)
    few = keyed.where(F.pmod(F.xxhash64("node", F.lit("list")), F.lit(sample)) == 0) if parts.count() > BLOCK else keyed.limit(0)
    lists = durable(long_lists(postings(docs, few, frequent, width, threshold), sample).where(F.col("n") > BLOCK), "near_long_lists")
    found = candidate_pairs(postings(docs, keyed, frequent, width, threshold), lists, threshold)
    found = durable(found.select("a", "b", "need", (F.col("nb") < 0).alias("whole")), "near_rest_pairs")
    give_back(df.sparkSession)  # the postings
    if found.isEmpty():
        whole = parts
    else:
        pairs, met = found.where("not whole").drop("whole"), found.where("whole").select("a", F.col("b").alias("part"))
        members = keyed.join(met.select("part").distinct(), "part", "left_semi").select("node")
        ends = ends_of(pairs).union(met.select("a")).union(members).distinct()
        sets = node_sets(docs, nodes, ends, frequent, width, threshold, "rest")
        links = verified_links(sets, pairs, threshold, "rest")
        if not met.isEmpty():
            links = links.unionByName(part_links(sets, keyed, large, met, threshold))
        give_back(df.sparkSession)
        whole = merge(parts, links, "rest")
    least = whole.groupBy("part").agg(F.min("doc").alias("component_id"))
    classes = whole.join(least, "part").select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "part", "component_id")
    linked = rows.where("n > 0").join(classes, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))).select("doc_id", "h", "n", "part", "component_id")
    alone = rows.where("n = 0").select("doc_id", "h", "n", F.lit(None).cast("long").alias("part"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def membership(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: int = THRESHOLD, star_orders: int = STAR_ORDERS) -> DataFrame:
    """One row per input row: id, n_shingles, component_id."""
    rows = _members(df, id_col, text_col, width, threshold, star_orders)
    return rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay: of each group one row, and every text without words.

    The row has the least id of the group, not null if the group has one; rows that share it
    are told apart by the hash of their text, and of rows that repeat both any one stays.
    """
    own, name = positional(df)
    rows = durable(_members(df, id_col, text_col, **options), "near_members")
    give_back(df.sparkSession)
    counted = rows.where("part is not null").groupBy("part", "doc_id", "h").agg(F.count(F.lit(1)).alias("times"))
    least = counted.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "times")).alias("least"))
    one = least.select(F.col("least.doc_id").alias("_k_id"), F.col("least.h").alias("_k_h"), (F.col("least.times") > 1).alias("_k_twice"))
    empty = rows.where("part is null").select(F.col("doc_id").alias("_k_id"), F.col("h").alias("_k_h"), F.lit(False).alias("_k_twice")).distinct()
    stay = durable(one.unionByName(empty), "near_stay")
    same = F.col(name[id_col]).cast("long").eqNullSafe(F.col("_k_id")) & (F.xxhash64(F.col(name[text_col]).cast("string")) == F.col("_k_h"))
    kept = own.join(stay.where("not _k_twice"), same, "left_semi")
    repeated = stay.where("_k_twice")
    if not repeated.isEmpty():
        kept = kept.unionByName(own.join(repeated, same).dropDuplicates(["_k_id", "_k_h"]).select(*own.columns))
    return kept.toDF(*df.columns)


def op7_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership(table(spark, sf_dir, "documents"))

SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
),
shingles AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS g
  FROM d WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
"""
