"""Hard-negative mining: segment summaries bound inner products, refined before exact scoring.

Vectors are scaled and floored to integers; a score is an integer inner product. For every
anchor (a stated query set: ids divisible by ``anchor_every``) the best rows of its label are
its positives; for each positive the best rows of other labels whose score lies between ``low``
and ``high`` per cent of the positive's are its negatives.

1. Rows are written once with their vectors and, for 1, 4 and 16 segments, each segment's mean
   and deviation, and are dealt at random into shards of about ``SHARD_BYTES`` of vectors.
2. One task reads a shard once and holds it; the anchors, the small side, stream past it in
   slices (a shard's rows sort before its anchors).
3. With means m, deviations s and length l of a segment, a score is sum(l*mx*my) plus or minus
   sum(l*sx*sy), by Cauchy-Schwarz. Rows whose upper bound is below the k-th best lower bound,
   or whose bounds miss the window, go; the rest meet the next finer segments; what is left is
   scored exactly.
4. A shard answers with its best k per anchor (or anchor and positive); ranking over shards
   keeps the best k of all, after a limit on the map side.

The bounds only discard rows that cannot be among the first k, so results are exact.

Defined results: rows with a null label, a null vector, or a null or non-finite component take
no part. Rows that repeat id, label and vector are one row; a repeated id with another label
or vector is a row of its own, also as an anchor. Vectors of different lengths do not meet. A
null id is no anchor and comes last among ties; equal ids are told apart by row number. Zero
and empty vectors take part (score 0). Scaled components count up to 2^44 in size, scores up to
2^59. An anchor without positives, or a positive without negatives, gives no row. Columns
besides id, vector and label are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortex.llm.common import durable, table

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score
SCALE = 256
ANCHOR_EVERY = 100
SEGMENTS = (1, 4, 16)
SHARD_BYTES = 4 << 20
SLICE = 64  # anchors that meet a shard at once
_LARGEST_PART = float(2**44)
_LARGEST_SCORE = 2**59
_NO_LIMIT = 2**62
_EXACT = float(2**52)  # sums of doubles below this are exact integers

_ROW = "row long, id long, label string, vec array<double>, summary array<double>"
_FOUND = "anchor long, place int, row long, id long, score long"


def integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    """The scaled, floored components, as doubles that hold integers."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * scale), -_LARGEST_PART, _LARGEST_PART)


def summaries(x: np.ndarray, segments: tuple = SEGMENTS) -> np.ndarray:
    """For each number of segments: sqrt(length) * mean and sqrt(length) * deviation of each segment."""
    out = []
    for count in segments:
        edges = np.linspace(0, x.shape[1], count + 1).astype(int)
        for part in (0, 1):
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    out.append(np.zeros(len(x)))
                    continue
                mean = x[:, a:b].mean(axis=1)
                value = mean if part == 0 else np.sqrt(((x[:, a:b] - mean[:, None]) ** 2).mean(axis=1))
                out.append(np.sqrt(b - a) * value)
    return np.stack(out, axis=1)


class Shard:
    """Rows of one vector length, or a slice of anchors: integers, summaries and names."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, null: np.ndarray, labels: np.ndarray, x: np.ndarray, summary: np.ndarray):
        self.rows, self.ids, self.null, self.labels, self.x, self.summary = rows, ids, null, labels, x, summary
        self.largest = np.abs(x).max(axis=1, initial=0.0)
        self.length = np.sqrt((x * x).sum(axis=1))

    def bounds(self, other: Shard, columns: np.ndarray, level: int, segments: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the scores of my rows with the other's ``columns``."""
        start = 2 * sum(segments[:level])
        n = segments[level]
        mine, theirs = self.summary[:, start : start + 2 * n], other.summary[columns, start : start + 2 * n]
        centre, spread = mine[:, :n] @ theirs[:, :n].T, mine[:, n:] @ theirs[:, n:].T
        spread += 1e-9 * self.length[:, None] * other.length[columns] + 0.5  # rounding
        return centre - spread, centre + spread

    def scores(self, other: Shard, columns: np.ndarray) -> np.ndarray:
        """Exact scores with the other's ``columns``, as longs."""
        x, y = self.x, other.x[columns]
        out = x @ y.T
        large = np.argwhere(self.largest[:, None] * other.largest[columns] * max(1, x.shape[1]) >= _EXACT)
        out = np.where(np.abs(out) < _EXACT, out, 0).astype(np.int64)
        for i, j in large:  # components so large that doubles round: whole numbers of any size
            exact = sum(int(a) * int(b) for a, b in zip(x[i], y[j], strict=True))
            out[i, j] = max(-_LARGEST_SCORE, min(_LARGEST_SCORE, exact))
        return out


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def best_of(anchors: Shard, rows: Shard, goals: list[tuple], k: int, segments: tuple) -> Iterator[tuple]:
    """(anchor index, goal index, row indices, scores): the first k rows of each anchor and goal.

    A goal is (allowed rows, least score, greatest score), each per anchor; bounds discard first.
    """
    columns = np.arange(len(rows.rows))
    alive = [allowed.copy() for allowed, _, _ in goals]
    for level in range(len(segments)):
        if not len(columns):
            return
        lower, upper = anchors.bounds(rows, columns, level, segments)
        for g, (_, least, greatest) in enumerate(goals):
            inside = alive[g] & (lower >= least[:, None]) & (upper <= greatest[:, None])
            floor = np.maximum(least, kth_largest(np.where(inside, lower, -np.inf), k))
            alive[g] &= (upper >= floor[:, None]) & (lower <= greatest[:, None])
        wanted = np.logical_or.reduce([a.any(axis=0) for a in alive])
        columns = columns[wanted]
        alive = [a[:, wanted] for a in alive]
    if not len(columns):
        return
    scores = anchors.scores(rows, columns)
    for g, (_, least, greatest) in enumerate(goals):
        hit = alive[g] & (scores >= least[:, None]) & (scores <= greatest[:, None])
        for i in np.flatnonzero(hit.any(axis=1)):
            at = np.flatnonzero(hit[i])
            if len(at) > k:  # keep all that tie with the k-th
                at = at[scores[i, at] >= np.partition(scores[i, at], len(at) - k)[len(at) - k]]
            which = columns[at]
            order = np.lexsort((rows.rows[which], rows.ids[which], rows.null[which], -scores[i, at]))[:k]
            yield int(i), g, which[order], scores[i, at][order]


def _shards(batch: pa.RecordBatch) -> dict[int, Shard]:
    """The rows of a batch by vector length."""
    vectors, summary = batch.column("vec"), batch.column("summary")
    sizes = np.diff(np.asarray(vectors.offsets))
    flat, wide = vectors.flatten().to_numpy(), summary.flatten().to_numpy().reshape(len(batch), -1)
    starts = np.cumsum(sizes) - sizes
    ids = batch.column("id")
    columns = (batch.column("row").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column("label").to_numpy(zero_copy_only=False))
    out = {}
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        out[int(dim)] = Shard(*[c[at] for c in columns], flat[starts[at][:, None] + np.arange(dim)], wide[at])
    return out


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def stream(rows: DataFrame, anchors: DataFrame, shards: int, k: int, goals_of, segments: tuple) -> DataFrame:
    """(anchor, place, row, id, score): each shard's first k rows for every anchor and goal.

    ``anchors``: the columns of ``rows`` and what ``goals_of(anchors, batch indices, rows)`` reads.
    """
    extra = [c for c in anchors.columns if c not in rows.columns]
    kinds = {f.name: f.dataType for f in anchors.schema.fields}
    left = rows.withColumn("kind", F.lit(0)).withColumns({c: F.lit(None).cast(kinds[c]) for c in extra})
    every = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("kind", F.lit(1))
    dealt = left.unionByName(every).repartition("shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held = -1, [], {}
        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.r_[True, (np.diff(shard) != 0) | (np.diff(kind) != 0), True]) if len(batch) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if shard[a] != now:
                    now, parts, held = shard[a], [], {}
                if kind[a] == 0:
                    parts.append(batch.slice(a, b - a))
                    continue
                if parts:
                    held, parts = _shards(_joined(parts)), []
                for s in range(a, b, SLICE):
                    yield answer(batch.slice(s, min(SLICE, b - s)), held)

    def answer(batch: pa.RecordBatch, held: dict) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        batch = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.columns], schema=batch.schema)
        place_of = {r: i for i, r in enumerate(batch.column("row").to_pylist())}
        for dim, anchors in _shards(batch).items():
            rows = held.get(dim)
            if rows is None:
                continue
            at = [place_of[r] for r in anchors.rows.tolist()]
            goals = goals_of(anchors, batch, at, rows)
            for i, g, which, scores in best_of(anchors, rows, goals, k, segments):
                n = len(which)
                ids = [None if null else v for v, null in zip(rows.ids[which].tolist(), rows.null[which].tolist(), strict=True)]
                for column, values in zip(out, ([int(anchors.rows[i])] * n, [g] * n, rows.rows[which].tolist(), ids, scores.tolist()), strict=True):
                    column.extend(values)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["anchor", "place", "row", "id", "score"])

    found = dealt.mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _prepared(df: DataFrame, id_col: str, vec_col: str, label_col: str, scale: float, segments: tuple) -> DataFrame:
    """row, id, label, integer vec, summary of the rows that take part, written once."""
    vec = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), vec.alias("vec"))
    own = own.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & finite).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, summary = [None] * len(batch), [None] * len(batch)
            sizes = np.diff(np.asarray(batch.column(3).offsets))
            flat = batch.column(3).flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = integers(flat[starts[at][:, None] + np.arange(dim)], scale)
                for i, v, s in zip(at, x, summaries(x, segments), strict=True):
                    vec[i], summary[i] = v, s
            lists = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(vec, lists), pa.array(summary, lists)], names=["row", "id", "label", "vec", "summary"])

    numbered = own.select(F.monotonically_increasing_id().alias("row"), "id", "label", "vec")
    return durable(numbered.mapInArrow(run, _ROW), "negatives_rows")


def _positive_goals(anchors: Shard, batch: pa.RecordBatch, at: list, rows: Shard) -> list[tuple]:
    """One goal: rows of the anchor's label but itself, of any score."""
    allowed = (anchors.labels[:, None] == rows.labels) & (anchors.rows[:, None] != rows.rows)
    return [(allowed, np.full(len(anchors.rows), -_NO_LIMIT), np.full(len(anchors.rows), _NO_LIMIT))]


def _negative_goals(low: int, high: int):
    """A goal for each positive: rows of other labels with low <= 100 * score / positive's score <= high."""

    def goals(anchors: Shard, batch: pa.RecordBatch, at: list, rows: Shard) -> list[tuple]:
        scores = batch.column("scores").to_pylist()
        other = anchors.labels[:, None] != rows.labels
        out = []
        for g in range(max(len(scores[i]) for i in at)):
            least, greatest = np.full(len(at), _NO_LIMIT), np.full(len(at), -_NO_LIMIT)
            for j, i in enumerate(at):
                if g < len(scores[i]):
                    least[j], greatest[j] = -(-low * scores[i][g] // 100), high * scores[i][g] // 100
            out.append((other & (least <= greatest)[:, None], least, greatest))
        return out

    return goals


def mine(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
    anchor_every: int = ANCHOR_EVERY,
    segments: tuple = SEGMENTS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = _prepared(df, id_col, vec_col, label_col, scale, segments)
    size = rows.agg(F.sum(F.size("vec") + 1)).first()[0] or 0
    shards = max(1, -(-size * 8 // SHARD_BYTES))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards)).cast("int"))
    anchors = rows.where(F.col("id") % anchor_every == 0)
    first = durable(stream(dealt, anchors, shards, positives, _positive_goals, segments), "negatives_positives")
    scores = first.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    asked = durable(anchors.join(scores.withColumnRenamed("anchor", "row"), "row"), "negatives_asked")
    last = stream(dealt, asked, shards, negatives, _negative_goals(low, high), segments)
    known = first.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        last.join(known, ["anchor", "place"]).join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", noisy))


SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM (SELECT * FROM r WHERE vec_id % 100 = 0) a JOIN r b ON a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id))::INTEGER AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id
WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10
"""
