"""Language ID by hierarchical discrimination: language family first, then the language within it.

Features of a text: its whole lower-cased text as UTF-8 bytes, byte 1- to 4-grams hashed
into ``BUCKETS`` counters, square root of the shares (so every vector has length 1). Both
levels are one-versus-one linear support vector machines (squared hinge, accelerated
gradient descent) with a logistic curve over the margin; a class's probability is the
normalised product of its pairwise ones. score = P(family) * P(language | family).

Training reads the labelled rows given to ``fit``. The classifier is fitted on a bounded
sample: about ``SAMPLE_ROWS`` rows over all languages, the same number of each, and never more
than twice ``SAMPLE_ROWS``: the first ones in the order of a hash of id, language and text, so
the order and layout of the input do not matter; rows equal in all three count once. One task on
an executor fits it from their vectors (``SAMPLE_ROWS`` * ``BUCKETS`` float32, 64 MB); only the
fitted weights reach the driver. At most ``LANGUAGES`` languages, the most frequent ones, are
learned. Prediction runs over every row and whole texts.

Defined results: a null text or one without a letter is ``und`` with score 0. Without any
labelled row every text is ``und``; with one label every text with a letter gets it. A label
without an entry in ``FAMILIES`` is a family of its own. Null ids and repeated rows are
predicted like any others. All other columns pass through ``predict`` untouched.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohortex.llm.common import fold, release_memory, table

BUCKETS = 4096
SAMPLE_ROWS = 4000
LANGUAGES = 256
ORDERS = (1, 2, 3, 4)
CHUNK = 128
UNDETERMINED = "und"

# ISO 639-1 codes by family
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi ur bn pa mr gu ne si",
    "sinitic": "zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.split("-")[0].split("_")[0].lower(), lang)


def features(texts: list[str]) -> np.ndarray:
    """One row per text: square root of the share of each hashed byte n-gram."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for i, text in enumerate(texts):
        b = np.frombuffer(b" " + " ".join(text.lower().split()).encode("utf-8", "replace") + b" ", dtype=np.uint8).astype(np.uint32)
        codes, grams = np.zeros(len(b), np.uint32), []
        for n in range(1, max(ORDERS) + 1):
            if n > len(b):
                break
            codes = (codes[: len(b) - n + 1] << np.uint32(8)) | b[n - 1 :]
            if n in ORDERS:
                grams.append(((codes + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(20))
        counts = np.bincount(np.concatenate(grams), minlength=BUCKETS)
        out[i] = np.sqrt(counts / counts.sum())
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Pair:
    """A fitted one-versus-one machine: positive margins speak for ``first``."""

    first: str
    second: str
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (x @ self.weights + self.bias) + self.shift, -30, 30)
        return 1 / (1 + np.exp(-z))


def fit_pair(first: str, second: str, x: np.ndarray, y: np.ndarray, c: float = 30.0, steps: int = 150) -> Pair:
    """Squared-hinge linear SVM on ``y`` in {-1, 1}, both classes with the same total weight; ``x`` is used up."""
    mean = x.mean(axis=0)
    x -= mean
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * c
    v = np.random.default_rng(0).standard_normal(x.shape[1]).astype(np.float32)
    for _ in range(20):  # largest curvature, by power iteration
        v = x.T @ (cost * (x @ v)).astype(np.float32)
        v /= max(np.linalg.norm(v), 1e-30)
    bound = 1 + 2.2 * float(np.linalg.norm(x.T @ (cost * (x @ v)).astype(np.float32))) + 2 * c
    w = ahead = np.zeros(x.shape[1] + 1)
    t = 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead[:-1].astype(np.float32) + ahead[-1]))
        pull = (-2 * cost * y * slack).astype(np.float32)
        grad = np.append(ahead[:-1] + x.T @ pull, pull.sum())
        new, t_new = ahead - grad / bound, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    weights, bias = w[:-1].astype(np.float32), float(w[-1] - mean @ w[:-1])
    margin = x @ weights + (float(mean @ weights) + bias)
    target = np.where(y > 0, 1 - 1e-3, 1e-3)
    a, b = 1.0, 0.0
    for _ in range(50):  # logistic curve over the margin, damped Newton steps
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).mean() + 1e-3 * a, (p - target).mean()])
        r = np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(r * margin**2).mean() + 1e-3, (r * margin).mean()], [(r * margin).mean(), r.mean() + 1e-3]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
    return Pair(first, second, weights, bias, float(max(a, 0.1)), float(b))


def fit_classes(x: np.ndarray, labels: np.ndarray) -> tuple[list[str], list[Pair]]:
    names = sorted(set(labels))
    pairs = []
    for first, second in combinations(names, 2):
        rows = (labels == first) | (labels == second)
        pairs.append(fit_pair(first, second, x[rows], np.where(labels[rows] == first, 1.0, -1.0)))
    return names, pairs


def class_probabilities(x: np.ndarray, names: list[str], pairs: list[Pair]) -> np.ndarray:
    log_p = np.zeros((len(x), len(names)))
    at = {n: i for i, n in enumerate(names)}
    for pair in pairs:
        p = np.clip(pair.probability(x), 1e-12, 1 - 1e-12)
        log_p[:, at[pair.first]] += np.log(p)
        log_p[:, at[pair.second]] += np.log1p(-p)
    if len(names) > 2:  # every class took part in len(names) - 1 duels
        log_p *= 2 / len(names)
    p = np.exp(log_p - log_p.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    family_pairs: list[Pair] = field(default_factory=list)
    members: dict[str, tuple[list[str], list[Pair]]] = field(default_factory=dict)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if self.families and has_letter(t)]
        for at in range(0, len(known), CHUNK):
            rows = known[at : at + CHUNK]
            x = features([texts[i] for i in rows])
            p_family = class_probabilities(x, self.families, self.family_pairs)
            best = p_family.argmax(axis=1)
            for k, family in enumerate(self.families):
                own = np.flatnonzero(best == k)
                if not len(own):
                    continue
                names, pairs = self.members[family]
                p = class_probabilities(x[own], names, pairs)
                top = p.argmax(axis=1)
                for j, o in enumerate(own):
                    langs[rows[o]] = names[top[j]]
                    scores[rows[o]] = p_family[o, k] * p[j, top[j]]
        return langs, np.clip(scores, 0.0, 1.0)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` of the labelled rows (see the module docstring)."""
    usable = labelled.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    often = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGUAGES)
    counts = {r["lang"]: r["n"] for r in often.collect()}
    if not counts:
        return Model()
    each = max(1, sample_rows // len(counts))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, each / n))])
    place = F.xxhash64(F.coalesce("id", F.lit("")), "lang", "text", F.lit(17))
    draw = F.pmod(place, F.lit(1 << 20)) / float(1 << 20)
    sample = usable.where(draw < share[F.col("lang")]).select("lang", "text", place.alias("place"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs, texts, places = (part.column(k).to_pylist() for k in range(3))
            rows = [i for i, t in enumerate(texts) if has_letter(t)]
            x = features([texts[i] for i in rows])
            columns = [pa.array([langs[i] for i in rows], pa.string()), pa.array([places[i] for i in rows], pa.int64()), pa.array([v.tobytes() for v in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "place", "x"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, x, n = [], np.zeros((2 * sample_rows, BUCKETS), np.float32), 0
        for part in slices(batches):
            langs += part.column(0).to_pylist()
            for v in part.column(2):
                x[n] = np.frombuffer(v.as_buffer(), dtype=np.float32)
                n += 1
        if langs:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_model(x[:n], np.array(langs)))])], names=["model"])

    coded = sample.mapInArrow(vectors, "lang string, place long, x binary").dropDuplicates(["lang", "place"])
    # a hash draw can exceed its mean a little; twice the mean is a hard bound
    first = coded.orderBy("place", "lang", "x").limit(2 * sample_rows)
    found = first.mapInArrow(fitted, "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else Model()


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``CHUNK`` rows; freed memory goes back to the system at the end of the task."""
    try:
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                yield batch.slice(at, CHUNK)
    finally:
        release_memory()


def fit_model(x: np.ndarray, langs: np.ndarray) -> Model:
    """Both levels of machines on the rows of ``x``."""
    families = np.array([family_of(lang) for lang in langs])
    names, pairs = fit_classes(x, families)
    return Model(names, pairs, {f: fit_classes(x[families == f], langs[families == f]) for f in names})


def predict(df: DataFrame, model: Model, text_col: str = "text", pred_col: str = "_lang_pred", score_col: str = "_lang_score") -> DataFrame:
    """``df`` with all its columns, plus the predicted language and its score (``pred_col`` and ``score_col`` must be new names)."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs, scores = model.predict(part.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, pred_col, score_col]
            )

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(pred_col, StringType()), StructField(score_col, DoubleType())]))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    model = fit(docs.where(~F.col("held_out")))
    return predict(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score")
    )
