"""Toxicity by a weighted finite-state pattern grammar over clauses.

A clause is the text between sentence marks. Its words become symbols: insult, threat,
target, negation, report, other. Three transducers are composed into one machine:

* ``target_machine``: an insult or threat near a target word (before or after) is directed;
* ``negation_machine``: within ``NEGATION_SPAN`` words after a negation it is negated;
* ``report_machine``: after a word of saying, to the end of the clause, it is reported.

The composed machine reads a clause once and writes a kind for every matched insult or
threat (directed or not, negated or not, reported or not). The weight of a kind is learned:
a logistic curve over the kinds' summed hit weights, pulled towards prior weights that make
directed matches heavier and negated or reported ones lighter. A text's score is that curve
over all its matched clauses; words by themselves have no score.

Lexicon: fixed insult and threat words, plus the stems that the labelled rows show: prefixes
of words that toxic rows hold far more often than others, each extended as far as its toxic
support holds and weighted by its odds; the longest entry that a word begins with counts. A
stem must explain toxic rows that better stems leave unexplained. Fixed words that the labelled rows show mostly in clean texts are dropped.

Training reads the labelled rows given to ``fit``, on a bounded sample: about
``TOXIC_SAMPLE`` rows with label 1 and ``CLEAN_SAMPLE`` with label 0, chosen by a hash of
the id; at most ``LEXICON`` entries. Scoring reads every row and whole texts.

Defined results: a null or empty text has no clause and gets the score of no match. Without
labelled rows the prior weights hold. Null labels are not learned from; several labels of
one id count as toxic if any is. Null ids and repeated rows are scored like any others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortex.llm.common import durable, fold, fresh, releasing, table

TOXIC_SAMPLE = 4000
CLEAN_SAMPLE = 12000
LEXICON = 2000
LEAST_PREFIX = 4
LONGEST_PREFIX = 16
LEAST_SUPPORT = 4
LEFT_EVIDENCE = 12.0  # of the rows that better stems leave unexplained
LEAST_EVIDENCE = 50.0  # log-likelihood ratio against "toxic rows hold it as often as others"
LEAST_ODDS = 6.0
NEGATION_SPAN = 3
TARGET_SPAN = 4

# Word lists of the grammar (lower case; English, German, French, Spanish)
INSULTS = """idiot moron imbecile loser scum trash clown worthless pathetic stupid disgusting dumbass retard bastard bitch
asshole vermin filth degenerate halfwit trottel vollidiot arschloch dummkopf hurensohn abschaum miststück connard salaud
ordure imbécile abruti enculé gilipollas imbécil cabrón basura pendejo escoria""".split()
THREATS = """kill murder strangle slaughter stab shoot behead lynch hurt destroy umbringen töten erschießen verprügeln tuer
assassiner égorger frapper matar asesinar degollar apuñalar""".split()
TARGETS = """you your yours yourself u ur they them their he she him her these those du dich dir dein deine ihr euch ihn sie tu
toi te vous votre vos ton ta lui eux ti vosotros usted ustedes él ella ellos ellas""".split()
NEGATIONS = "not no never none nobody isn't aren't wasn't don't doesn't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split()
REPORTS = """said says say told tells wrote writes claims claimed called calls shouted quoted quote according sagte sagt schrieb
behauptete rief laut disait dit écrit crié selon dijo dice escribió gritó según""".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
CHUNK = 512  # rows scored at once
CLAUSE_END = re.compile(r"[.!?;\n]")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


@dataclass(frozen=True)
class Transducer:
    """Deterministic machine: arcs[state][symbol] = (output, next state); state 0 is the start."""

    arcs: tuple[dict, ...]

    def run(self, symbols: list) -> list:
        state, out = 0, []
        for s in symbols:
            y, state = self.arcs[state][s]
            out.append(y)
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds the first one's outputs to the second, with the reachable state pairs only."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], []
    for a, b in todo:
        row = {}
        for symbol, (middle, a2) in first.arcs[a].items():
            out, b2 = second.arcs[b][middle]
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            row[symbol] = (out, number[a2, b2])
        arcs.append(row)
    return Transducer(tuple(arcs))


def countdown(opens: int, span: int, inputs: list, mark) -> Transducer:
    """Hits within ``span`` words after the symbol ``opens`` are marked; span 0: up to the clause's end.

    ``inputs`` are (symbol, flags) pairs; the flags of a hit grow by ``mark``.
    """
    arcs = []
    for left in range(max(span, 1) + 1):
        row = {}
        for symbol, flags in inputs:
            after = max(span, 1) if symbol == opens else (left if span == 0 else max(0, left - 1))
            hit = symbol in (INSULT, THREAT) and left > 0
            row[symbol, flags] = ((symbol, flags | {mark} if hit else flags), after)
        arcs.append(row)
    return Transducer(tuple(arcs))


def grammar() -> Transducer:
    """target o negation o report, over (symbol, flags)."""
    plain = [(s, frozenset()) for s in range(6)]
    target = countdown(TARGET, TARGET_SPAN, plain, "directed")
    after_target = plain + [(s, frozenset({"directed"})) for s in (INSULT, THREAT)]
    negation = countdown(NEGATION, NEGATION_SPAN, after_target, "negated")
    after_negation = after_target + [(s, f | {"negated"}) for s, f in after_target if s in (INSULT, THREAT)]
    return compose(compose(target, negation), countdown(REPORT, 0, after_negation, "reported"))


KINDS = [
    (symbol, directed, negated, reported) for symbol in (INSULT, THREAT) for directed in (0, 1) for negated in (0, 1) for reported in (0, 1)
]
PRIOR_WEIGHTS = np.array([(2.0 + d) * (0.3 if n else 1.0) * (0.4 if r else 1.0) for s, d, n, r in KINDS])
PRIOR_BIAS = -2.5


@dataclass
class Model:
    entries: dict[str, tuple[int, float]] = field(default_factory=dict)  # prefix -> (symbol, weight)
    weights: np.ndarray = field(default_factory=lambda: PRIOR_WEIGHTS.copy())
    bias: float = PRIOR_BIAS

    def prepare(self) -> "Scanner":
        return Scanner(self)


class Scanner:
    """A model ready to read texts: the lexicon as an automaton, the grammar composed."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.automaton = ahocorasick.Automaton()
        for prefix in model.entries:
            self.automaton.add_word(prefix, len(prefix))
        if model.entries:
            self.automaton.make_automaton()
        self.symbols = {w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS}
        self.machine = grammar()
        self.kind = {
            (s, frozenset(m for m, on in (("directed", d), ("negated", n), ("reported", r)) if on)): i for i, (s, d, n, r) in enumerate(KINDS)
        }

    def symbol(self, word: str) -> tuple[int, float]:
        if word in self.symbols:
            return self.symbols[word], 0.0
        for n in range(min(len(word), LONGEST_PREFIX), 0, -1):
            if word[:n] in self.model.entries:
                return self.model.entries[word[:n]]
        return OTHER, 0.0

    def clauses(self, text: str) -> Iterator[str]:
        """The clauses that hold a lexicon word, each once."""
        if not self.model.entries:
            return
        done = 0
        for end, length in self.automaton.iter(text):
            start = end - length + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            opens = max(text.rfind(mark, done, start) for mark in ".!?;\n") + 1
            closes = CLAUSE_END.search(text, end)
            stop = closes.start() if closes else len(text)
            yield text[max(opens, done) : stop]
            done = stop

    def features(self, text: str | None) -> np.ndarray:
        """Summed hit weights by kind, damped by a logarithm."""
        x = np.zeros(len(KINDS))
        for clause in self.clauses((text or "").lower()):
            read = [self.symbol(w) for w in WORD.findall(clause)]
            # a target may follow its insult: read the clause from both ends and join what is directed
            forward = self.machine.run([(s, frozenset()) for s, _ in read])
            backward = self.machine.run([(s, frozenset()) for s, _ in reversed(read)])[::-1]
            for (s, weight), (_, flags), (_, back) in zip(read, forward, backward, strict=True):
                if s in (INSULT, THREAT):
                    x[self.kind[s, flags | (back & {"directed"})]] += weight
        return np.log1p(x)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.stack([self.features(t) for t in texts]) if texts else np.zeros((0, len(KINDS)))
        return 1 / (1 + np.exp(-np.clip(x @ self.model.weights + self.model.bias, -30, 30)))


def draw_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """About TOXIC_SAMPLE ids with label 1 and CLEAN_SAMPLE with label 0 (never over twice as many): id, toxic."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) == 1).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(29)), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, min(1.0, TOXIC_SAMPLE / max(1, n.get(1, 0)))).otherwise(min(1.0, CLEAN_SAMPLE / max(1, n.get(0, 0))))
    place = F.xxhash64(F.col("id").cast("string"), F.lit(31))
    return rows.where(draw < share).orderBy(place, "id").limit(2 * (TOXIC_SAMPLE + CLEAN_SAMPLE))


def prefix_counts(sample: DataFrame) -> DataFrame:
    """prefix, toxic, clean: in how many sampled rows a word begins with the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for first in range(0, len(batch), CHUNK):
                part = batch.slice(first, CHUNK)
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    seen = set()
                    for w in set(WORD.findall(text.lower())):
                        seen.update(w[:n] for n in range(LEAST_PREFIX, min(len(w), LONGEST_PREFIX) + 1))
                    counts[toxic].update(seen)
                if sum(map(len, counts)) > 200_000:
                    yield emit(counts)
                    counts = (Counter(), Counter())
        yield emit(counts)

    def emit(counts) -> pa.RecordBatch:
        clean, toxic = counts
        names = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[k] for k in names], pa.int64()), pa.array([clean[k] for k in names], pa.int64())],
            names=["prefix", "toxic", "clean"],
        )

    partial = sample.mapInArrow(releasing(run), "prefix string, toxic long, clean long")
    return partial.groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def evidence(t: int, c: int, toxic_rows: int, clean_rows: int) -> float:
    """Log-likelihood ratio of t toxic and c clean rows against the rows' own shares."""
    if not t or not clean_rows or t * clean_rows <= c * toxic_rows:
        return 0.0
    n, base = t + c, toxic_rows / (toxic_rows + clean_rows)
    return 2 * (t * np.log(t / (n * base)) + (c * np.log(c / (n * (1 - base))) if c else 0.0))


def explaining(entries: dict, clean: dict[str, int], held: list[list[str]], toxic_rows: int, clean_rows: int) -> dict:
    """The entries that explain toxic rows not yet explained, best first, and longer forms of those.

    ``held``: the entries that each toxic row holds. Words that only share rows with a real
    insult (near copies of one toxic text) have no rows left once the insult is taken.
    """
    rows_of: dict[str, list[int]] = {}
    for i, names in enumerate(held):
        for e in names:
            rows_of.setdefault(e, []).append(i)
    left = {e: len(r) for e, r in rows_of.items()}
    open_rows, taken = set(range(len(held))), []
    while left:
        best = max(left, key=lambda e: (evidence(left[e], clean.get(e, 0), toxic_rows, clean_rows), -len(e), e))
        if evidence(left[best], clean.get(best, 0), toxic_rows, clean_rows) < LEFT_EVIDENCE:
            break
        taken.append(best)
        for i in rows_of[best]:
            if i in open_rows:
                open_rows.remove(i)
                for e in held[i]:
                    if e in left:
                        left[e] -= 1
        del left[best]
    return {e: w for e, w in entries.items() if any(e.startswith(t) for t in taken)}


def learned_entries(rows: list[tuple[str, int, int]], toxic_rows: int, clean_rows: int) -> dict[str, tuple[int, float]]:
    """Stems from (prefix, toxic, clean), each as long as its toxic support holds; longer ones only if clearly purer."""
    support = {p: t for p, t, _ in rows}
    odds = {p: (t + 0.5) / (toxic_rows + 1) / ((c + 0.5) / (clean_rows + 1)) for p, t, c in rows}
    longer: dict[str, list[str]] = {}
    for p in support:
        longer.setdefault(p[:-1], []).append(p)
    strong = {p for p, t, c in rows if evidence(t, c, toxic_rows, clean_rows) >= LEAST_EVIDENCE}
    entries: dict[str, tuple[int, float]] = {}
    for p in sorted(support, key=lambda p: (len(p), p)):
        shorter = next((p[:n] for n in range(len(p), LEAST_PREFIX - 1, -1) if p[:n] in entries), None)
        if shorter is not None and odds[p] < 1.5 * odds[shorter]:
            continue
        if p not in strong or odds[p] < LEAST_ODDS or support[p] < LEAST_SUPPORT:
            continue
        while True:
            best = max(longer.get(p, []), key=lambda q: (support[q], q), default=None)
            if best is None or support[best] < 0.95 * support[p]:
                break
            p = best
        entries[p] = (INSULT, float(min(1.0, np.log(odds[p]) / 6)))
    return entries


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn stems and weights from the labelled rows (see the module docstring).

    The drawn labels are a bounded table, so they are broadcast and the texts are filtered
    where they are read. The sampled texts are a written table.
    """
    drawn = draw_labels(labels, id_col, label_col)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    # copies of a text are one witness
    sample = durable(texts.join(F.broadcast(drawn), "id").select("text", "toxic").distinct(), "toxicity_sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic_rows, clean_rows = sizes.get(1, 0), sizes.get(0, 0)
    counted = prefix_counts(sample)
    pure = (F.col("toxic") + 0.5) / float(toxic_rows + 1) / ((F.col("clean") + 0.5) / float(clean_rows + 1)) >= LEAST_ODDS
    stems = counted.where((F.col("toxic") >= LEAST_SUPPORT) & pure).orderBy(F.col("toxic").desc(), "prefix").limit(20 * LEXICON)
    fixed = counted.where(F.col("prefix").isin([w[:LONGEST_PREFIX] for w in INSULTS + THREATS]))
    entries = {w: (INSULT, 0.8) for w in INSULTS} | {w: (THREAT, 0.8) for w in THREATS}
    for r in fixed.collect():
        if r["clean"] / (clean_rows + 1) > 0.2 * (r["toxic"] + 1) / (toxic_rows + 1):
            entries.pop(r["prefix"], None)
    stem_rows = stems.collect()
    learned = learned_entries([(r["prefix"], r["toxic"], r["clean"]) for r in stem_rows], toxic_rows, clean_rows)
    learned = dict(sorted(learned.items(), key=lambda e: (-e[1][1], e[0]))[:LEXICON])

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                words = set(WORD.findall(text.lower()))
                out.append(sorted({w[:n] for w in words for n in range(LEAST_PREFIX, min(len(w), LONGEST_PREFIX) + 1)} & learned.keys()))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], names=["entries"])

    held = sample.where("toxic = 1").select("text").mapInArrow(releasing(holding), "entries array<string>")
    entries |= explaining(learned, {r["prefix"]: r["clean"] for r in stem_rows}, [list(r["entries"]) for r in held.collect()], toxic_rows, clean_rows)
    model = Model(entries)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model.prepare()
        for batch in batches:
            x = [scanner.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([v.tolist() for v in x], pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = sample.mapInArrow(releasing(vectors), "toxic int, x array<double>").groupBy("toxic", "x").agg(F.count(F.lit(1)).alias("n")).collect()
    if toxic_rows and clean_rows:
        fit_weights(model, np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows]), np.array([r["n"] for r in rows], dtype=float))
    return model


def fit_weights(model: Model, x: np.ndarray, y: np.ndarray, n: np.ndarray, pull: float = 1.0, steps: int = 60) -> None:
    """Logistic regression by Newton steps, pulled towards the prior weights; both classes weigh the same."""
    n = np.where(y == 1, n / n[y == 1].sum(), n / n[y == 0].sum()) * 1000.0
    a = np.c_[x, np.ones(len(x))]
    prior = np.append(PRIOR_WEIGHTS, PRIOR_BIAS)
    w, hold = prior.copy(), np.append(np.full(len(KINDS), pull), 0.01)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (n * (p - y)) + hold * (w - prior)
        hess = (a * (n * p * (1 - p))[:, None]).T @ a + np.diag(hold)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    model.weights, model.bias = np.maximum(w[:-1], 0.0), float(w[-1])


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "_toxicity") -> DataFrame:
    """``df`` with all its columns, plus the toxicity score under ``score_col`` or, if the input has such a column, that name after underscores."""
    at, score_col = df.columns.index(text_col), fresh(df, score_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model.prepare()
        for batch in batches:
            for first in range(0, len(batch), CHUNK):
                part = batch.slice(first, CHUNK)
                scores = scanner.scores(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, score_col])

    return df.mapInArrow(releasing(run), StructType([*df.schema.fields, StructField(score_col, DoubleType())]))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold("doc_id", 5) != 0)
    model = fit(docs.where(~F.col("held_out")), labels)
    scored = score(docs, model)
    return scored.select("doc_id", "held_out", F.col("_toxicity").alias("score"), (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"))
