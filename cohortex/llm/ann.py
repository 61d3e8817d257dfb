"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard.

Rows whose vectors have the same direction form one class with its ``k + 1`` least ids (no
query needs more of them, and ties go to the smaller id), so a direction that a third of all
rows share is one point. Directions are vectors over their largest component in double
precision, a rounded quotient that is the same for exact multiples. Classes are dealt at random into shards of about ``SHARD`` points. In each shard a
directed graph is built: points are inserted in batches; a greedy beam search from the
medoid proposes neighbours, and relaxed distance pruning (a candidate is dropped if a chosen
neighbour is ``ALPHA`` times closer to it than the point is) keeps at most ``DEGREE`` diverse
edges; reverse edges are added and pruned alike. The graphs are a written table.

Queries, the small side, are dealt into blocks. A task reads a shard's graph once, holds it and
streams the blocks past it (a stated query set against all rows, in blocks); graphs are shuffled
once, whatever the number of queries. All points a beam search ends with are ranked in double
precision, and the shards' answers are merged per query.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, neither as queries nor as candidates. Vectors are compared with vectors of the
same length only. Rows that repeat id and direction are one candidate; a query never meets rows of its
own id; a repeated id with another vector is a query of its own. Ties go to the smaller id. A
query without candidates gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortex.llm.common import durable, table

K = 5
SHARD = 4096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 256
ALPHA = 1.2
BATCH = 256
QUERY_BLOCK = 512
MOST_TASKS = 10_000
QUERY_EVERY = 50


def valid_vector(column: Column) -> Column:
    finite = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return column.isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda v: v != 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def direction(column: Column) -> Column:
    """The vector over its largest absolute component, in double precision."""
    largest = F.array(F.array_max(F.transform(column, lambda v: F.abs(v.cast("double")))))
    # the outer function binds the largest component once a row
    return F.transform(largest, lambda top: F.transform(column, lambda v: v.cast("double") / top))[0]


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``beam`` nearest points met, nearest first (ids, -1 for none; squared distances)."""
    q, n = len(queries), len(x)
    ids = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), dtype=bool)
    seen = np.zeros((q, n + 1), dtype=bool)  # the last column stands for "no neighbour"
    seen[:, n] = True
    ids[:, 0], done[:, 0] = start, False
    dist[:, 0] = 2 - 2 * queries @ x[start]
    seen[:, start] = True
    active = np.arange(q)
    while len(active):
        open_dist = np.where(done[active], np.inf, dist[active])
        best = open_dist.argmin(axis=1)
        going = np.isfinite(open_dist[np.arange(len(active)), best])
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        near = graph[ids[active, best]]
        near = np.where(near < 0, n, near)
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        near = np.where(fresh, near, 0)
        d = 2 - 2 * np.einsum("qrd,qd->qr", x[near], queries[active])
        d = np.where(fresh, d, np.inf)
        all_d = np.concatenate([dist[active], d], axis=1)
        top = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        rows = np.arange(len(active))[:, None]
        dist[active] = all_d[rows, top]
        ids[active] = np.concatenate([ids[active], near], axis=1)[rows, top]
        done[active] = np.concatenate([done[active], ~fresh], axis=1)[rows, top]
    order = np.argsort(dist, axis=1, kind="stable")
    rows = np.arange(q)[:, None]
    dist = dist[rows, order]
    return np.where(np.isfinite(dist), ids[rows, order], -1), dist


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each point out of its candidates (-1: none)."""
    rows = np.arange(len(points))
    c = np.sort(np.where(candidates == points[:, None], -1, candidates), axis=1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    d = np.where(c < 0, np.inf, 2 - 2 * np.einsum("pcd,pd->pc", x[c], x[points]))
    order = np.argsort(d, axis=1, kind="stable")
    c, d = c[rows[:, None], order], d[rows[:, None], order]
    alive = np.isfinite(d)
    vectors = x[c]
    out = np.full((len(points), degree), -1, np.int64)
    count = np.zeros(len(points), np.int64)
    limit = alpha * alpha
    for j in range(c.shape[1]):
        take = np.flatnonzero(alive[:, j] & (count < degree))
        if not len(take):
            continue
        out[take, count[take]] = c[take, j]
        count[take] += 1
        if j + 1 < c.shape[1]:
            between = 2 - 2 * np.einsum("pcd,pd->pc", vectors[take, j + 1 :], vectors[take, j])
            alive[take, j + 1 :] &= limit * np.maximum(between, 0) > d[take, j + 1 :]
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, int]:
    """Neighbour lists (-1 padded) and the medoid of unit vectors ``x`` (float32)."""
    n = len(x)
    start = int((x @ x.mean(axis=0)).argmax())
    graph = np.full((n, degree), -1, np.int64)
    r = np.random.default_rng(seed)
    if n > 1:  # a sparse random start keeps every point reachable while the graph grows
        first = r.integers(0, n, (n, min(degree // 2, n - 1)))
        graph[:, : first.shape[1]] = np.where(first == np.arange(n)[:, None], -1, first)
    order = r.permutation(n)
    for at in range(0, n, BATCH):
        points = order[at : at + BATCH]
        met, _ = beam_search(x, graph, start, x[points], min(beam, n))
        graph[points] = robust_prune(x, points, np.concatenate([met, graph[points]], axis=1), degree, alpha)
        # reverse edges: free places first, points without one are pruned again
        target = graph[points].ravel()
        source = np.repeat(points, degree)[target >= 0]
        target = target[target >= 0]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        width = int(np.diff(np.r_[heads, len(target)]).max()) if len(target) else 0
        if width:
            owners = target[heads]
            extra = np.full((len(owners), width), -1, np.int64)
            row = np.repeat(np.arange(len(owners)), np.diff(np.r_[heads, len(target)]))
            extra[row, np.arange(len(target)) - heads[row]] = source
            for b in range(0, len(owners), BATCH):
                own = owners[b : b + BATCH]
                graph[own] = robust_prune(x, own, np.concatenate([graph[own], extra[b : b + BATCH]], axis=1), degree, alpha)
    return graph, start


def index(vectors: DataFrame, shard_rows: int = SHARD, k: int = K) -> DataFrame:
    """Graphs, one row per shard: dim, shard, ids (k + 1 per point, -1 padded), vectors, edges, start. A written table."""
    rows = vectors.withColumn("embedding", direction(F.col("embedding"))).groupBy("embedding", "vec_id").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    within = Window.partitionBy("embedding").orderBy("vec_id")
    least = rows.withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") <= k + 1)
    classes = durable(least.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann_classes")
    shards = max(1, -(-classes.count() // shard_rows))
    dealt = classes.withColumns({"dim": F.size("embedding"), "shard": F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int")})

    def build(part: pa.Table) -> pa.Table:
        dim, shard = part.column("dim")[0].as_py(), part.column("shard")[0].as_py()
        lists = part.column("ids").to_pylist()
        order = sorted(range(len(lists)), key=lambda i: lists[i])
        original = part.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)[order]
        ids = np.full((len(lists), k + 1), -1, np.int64)
        held = np.zeros(len(lists), np.int64)
        for row, i in enumerate(order):
            ids[row, : len(lists[i])], held[row] = lists[i], len(lists[i])
        graph, start = build_graph(unit(original).astype(np.float32))
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                "held": pa.array([held.tobytes()], pa.binary()), "vectors": pa.array([original.tobytes()], pa.binary()),
                "edges": pa.array([graph.astype(np.int32).tobytes()], pa.binary()), "start": pa.array([start], pa.int32()),
            }
        )

    schema = "dim int, shard int, ids binary, held binary, vectors binary, edges binary, start int"
    return durable(dealt.groupBy("dim", "shard").applyInArrow(build, schema), "ann_graphs")


def search(graphs: DataFrame, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM, block_rows: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all shards for each query."""
    stored = durable(queries.select("vec_id", "embedding").distinct().withColumn("row", F.monotonically_increasing_id()), "ann_queries")
    blocks = max(1, -(-stored.count() // block_rows))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    packed = stored.groupBy(F.size("embedding").alias("dim"), block.alias("block")).agg(F.collect_list(F.struct("row", "vec_id", "embedding")).alias("queries"))
    # a shard's row and the blocks of its dimension meet in one task, the row first
    last = graphs.groupBy("dim").agg(F.max("shard").alias("last"))
    asked = packed.join(last, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("last"))))
    missing = {"ids": "binary", "held": "binary", "vectors": "binary", "edges": "binary", "start": "int"}
    asked = asked.select("dim", "shard", F.lit(1).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in missing.items()], "queries")
    held = graphs.select("dim", "shard", F.lit(0).alias("kind"), *missing, F.lit(None).cast(asked.schema["queries"].dataType).alias("queries"))
    tasks = max(1, min(graphs.count(), MOST_TASKS))
    dealt = held.unionByName(asked).repartition(tasks, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: Shard | None = None
        for batch in batches:
            for r in range(batch.num_rows):
                fields = [batch.column(c)[r] for c in range(9)]
                if fields[2].as_py() == 0:
                    shard = Shard.read(*fields)
                elif shard is not None and shard.name == (fields[0].as_py(), fields[1].as_py()):
                    yield shard.answer(fields[8].values, k, beam)

    answers = dealt.mapInArrow(run, "row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@dataclass
class Shard:
    """One shard's graph and vectors, held while the query blocks stream past."""

    name: tuple[int, int]
    members: np.ndarray
    sizes: np.ndarray
    exact: np.ndarray
    single: np.ndarray
    graph: np.ndarray
    start: int

    @classmethod
    def read(cls, dim, shard, kind, ids, held, vectors, edges, start, queries) -> Shard:
        original = np.frombuffer(vectors.as_py(), np.float64).reshape(-1, dim.as_py())
        exact = unit(original)
        graph = np.frombuffer(edges.as_py(), np.int32).reshape(len(exact), -1).astype(np.int64)
        members = np.frombuffer(ids.as_py(), np.int64).reshape(len(exact), -1)
        return cls((dim.as_py(), shard.as_py()), members, np.frombuffer(held.as_py(), np.int64), exact, exact.astype(np.float32), graph, start.as_py())

    def answer(self, asked: pa.StructArray, k: int, beam: int) -> pa.RecordBatch:
        """The k best of this shard for each query: single precision walks the graph, double precision ranks all that is met."""
        row = asked.field("row").to_numpy()
        own = asked.field("vec_id").to_numpy(zero_copy_only=False)
        q = unit(asked.field("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(row), -1))
        found, _ = beam_search(self.single, self.graph, self.start, q.astype(np.float32), min(beam, len(self.exact)))
        out = [[], [], [], []]
        for i in range(len(q)):
            points = found[i][found[i] >= 0]
            scores = self.exact[points] @ q[i]
            if len(points) > k + 1:  # the query's own class may be one of them; ties stay
                near = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                points, scores = points[near], scores[near]
            hits = sorted((-s, int(v)) for p, s in zip(points, scores.tolist(), strict=True) for v in self.members[p][: self.sizes[p]] if v != own[i])[:k]
            for s, v in hits:
                for column, value in zip(out, (int(row[i]), int(own[i]), v, -s), strict=True):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.float64())], names=["row", "query_id", "vec_id", "score"])


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & valid_vector(F.col("embedding")))
    return search(index(rows), rows.where(F.col("vec_id") % QUERY_EVERY == 0))
