"""Conversation structure repair: least-cost edits by a grammar-compressed min-plus DP.

A conversation is legal when its role initials read ``(s?(ua)+)?``. Its rows may be kept (0),
reroled to user or assistant (3) or deleted (4); empty user or assistant rows may be inserted
anywhere (3). Blank and duplicate rows must be deleted; a truncated row that stays costs 3 more.

1. Rows are range-partitioned and sorted by conversation, turn, role and text and written with
   their global position, so a conversation of any size lies in order over many files.
   Duplicates are found by grouping and joining on conversation, role and text hash.
2. A row is one of nine symbols (role initial and fault). At most ``SEGMENT`` neighbouring rows
   of a conversation form a segment, a string of symbols; equal strings are kept once.
3. Re-Pair over all distinct strings, weighted by their counts: every round counts adjacent
   pairs in a Spark job and makes rules of the ``RULES_PER_ROUND`` most frequent ones.
4. Each rule has a transfer matrix: for every state before and after, the least cost and the
   ASCII-least edits of that cost, as a rope that shares its parts. A rule's matrix is the
   min-plus product of its parts' matrices, so rules are evaluated once, bottom-up, for all
   conversations; a distinct string is the product of the few symbols it is compressed to.
5. A conversation's segments (one small row per ``SEGMENT`` messages) are combined in order, and
   each segment gets its part of the cheapest edits.
6. Rows and edits are streamed in order per conversation, in bounded memory but for the audit
   text itself. SHA-256 of a whole conversation cannot be split, so this step reads one
   conversation in one task.

Least edits by cost, then ASCII, may be chosen part by part: of two edit strings over the same
rows with equal cost none is the beginning of the other (what is left could only be insertions,
which cost).

Defined results: a null role or text counts as one space. A null conversation is one
conversation. Null turns come first; rows of one turn are ordered by role, text hash and, if
equal in all, by input order. A conversation without rows has zeros, an empty audit and the hash
of the empty text. Repeated rows are duplicates. An empty table gives an empty result. Only the
four named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortex.llm.common import durable, table

SEGMENT = 1024
ROUNDS = 8
RULES_PER_ROUND = 16
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: states: nothing yet, after s, after u, after a; what a kept initial does to each
_START, _S, _U, _A = range(4)
_KEEP = {"s": {_START: _S}, "u": {_START: _U, _S: _U, _A: _U}, "a": {_U: _A}}
_NEXT = {_START: _U, _S: _U, _U: _A, _A: _U}
_ACCEPTED = (_START, _A)
_ROLE = {_U: "user", _A: "assistant"}
_DELETED = "d"  # the symbol of blank and duplicate rows; others are the initial, upper case if truncated
_FIRST_RULE = 0x100
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """An immutable text made of shared parts; compared without being written out."""

    __slots__ = ("text", "parts", "size", "code")

    def __init__(self, text: str = "", parts: tuple | None = None):
        self.text, self.parts = text, parts
        if parts is None:
            self.size, self.code = len(text), 0
            for c in text:
                self.code = (self.code * _BASE + ord(c)) % _PRIME
        else:
            left, right = parts
            self.size = left.size + right.size
            self.code = (left.code * pow(_BASE, right.size, _PRIME) + right.code) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        return Rope(parts=(self, other)) if other.size else self

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.parts is None:
                out.append(rope.text)
            else:
                todo += (rope.parts[1], rope.parts[0])
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or (a.size == b.size and a.code == b.code):
                continue
            if a.parts is None and b.parts is None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                if a.size > n:
                    mine.append(Rope(a.text[n:]))
                if b.size > n:
                    theirs.append(Rope(b.text[n:]))
            elif a.parts is not None and (b.parts is None or a.size >= b.size):
                mine += (a.parts[1], a.parts[0])
                theirs.append(b)
            else:
                theirs += (b.parts[1], b.parts[0])
                mine.append(a)
        return bool(theirs) and not mine


#: (state before, state after) -> (least cost, ASCII-least edits)
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def product(left: Matrix, right: Matrix) -> Matrix:
    """The min-plus product, ties to the ASCII-least edits."""
    after: dict[int, list] = {}
    for (k, j), entry in right.items():
        after.setdefault(k, []).append((j, entry))
    out: Matrix = {}
    for (i, k), (cost, edits) in left.items():
        for j, (more, rest) in after.get(k, ()):
            now, total = out.get((i, j)), cost + more
            if now is None or total < now[0]:
                out[i, j] = total, edits + rest
            elif total == now[0] and (both := edits + rest) < now[1]:
                out[i, j] = total, both
    return out


def insertions() -> Matrix:
    """No insertion, or as many as reach another state."""
    out: Matrix = {}
    for i in range(4):
        state, cost, edits = i, 0, Rope()
        while (i, state) not in out:
            out[i, state] = cost, edits
            state, cost, edits = _NEXT[state], cost + INSERT, edits + Rope("I")
    return out


def terminal(symbol: str) -> Matrix:
    """Insertions, then what may be done to one row."""
    step: Matrix = {(i, i): (DELETE, Rope("D")) for i in range(4)}
    if symbol != _DELETED:
        more = TRUNCATED if symbol.isupper() else 0
        for i in range(4):
            kept = _KEEP.get(symbol.lower(), {}).get(i)
            if _NEXT[i] != kept:
                step[i, _NEXT[i]] = REROLE + more, Rope("R")
            if kept is not None:
                step[i, kept] = more, Rope("K")
    return product(insertions(), step)


class Grammar:
    """Re-Pair rules: rule k replaces the pair ``rules[k]`` by the character 0x100 + k."""

    def __init__(self, rules: Iterable[str] = ()):
        self.rules = list(rules)
        self._matrices: dict[str, Matrix] = {}

    def compress(self, text: str) -> str:
        for k, pair in enumerate(self.rules):
            text = text.replace(pair, chr(_FIRST_RULE + k))
        return text

    def matrix(self, symbol: str) -> Matrix:
        """A symbol's matrix; rules from the matrices of their parts, each made once."""
        if symbol not in self._matrices:
            k = ord(symbol) - _FIRST_RULE
            self._matrices[symbol] = terminal(symbol) if k < 0 else product(self.matrix(self.rules[k][0]), self.matrix(self.rules[k][1]))
        return self._matrices[symbol]

    def transfer(self, text: str) -> Matrix:
        """The matrix of a whole string, from its compressed form, halves first."""
        level = [self.matrix(c) for c in self.compress(text)]
        while len(level) > 1:
            level = [product(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0]


def learn_grammar(sequences: DataFrame, rounds: int = ROUNDS, per_round: int = RULES_PER_ROUND) -> Grammar:
    """Re-Pair over ``sequences`` (seq, n): each round adds rules for the most frequent adjacent pairs."""
    rules: list[str] = []
    for _ in range(rounds):
        known = Grammar(rules)

        def pairs(batches: Iterator[pa.RecordBatch], known: Grammar = known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counted: Counter = Counter()
                for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    short = known.compress(text)
                    for a, b in zip(short, short[1:], strict=False):
                        counted[a + b] += n
                yield pa.RecordBatch.from_arrays([pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], names=["pair", "n"])

        counts = sequences.mapInArrow(pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        found = counts.where("n > 1").orderBy(F.col("n").desc(), "pair").limit(per_round).collect()
        if not found:
            break
        rules += [r["pair"] for r in found]
    return Grammar(rules)


def _key(conv: str) -> Column:
    """The conversation as text, a null one as the empty text."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def ordered_rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """c, turn, role, text, digest, pos: all rows with their place in the order, written once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    rows = df.select(
        _key(conv_col).alias("c"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("input"),
    )
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("input")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("input")
    return durable(placed.withColumn("pos", F.monotonically_increasing_id()), "repair_rows")


def symbols(rows: DataFrame) -> DataFrame:
    """(c, pos, sym): each row's initial and first fault."""
    blank = ~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    ended = F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    slim = rows.select("c", "pos", "role", "digest", blank.alias("blank"), F.when(ended, known).otherwise(F.upper(known)).alias("sym"))
    firsts = slim.groupBy("c", "role", "digest").agg(F.min("pos").alias("first"))
    return slim.join(firsts, ["c", "role", "digest"]).select(
        "c", "pos", F.when(F.col("blank") | (F.col("pos") > F.col("first")), _DELETED).otherwise(F.col("sym")).alias("sym")
    )


def segments(symbols: DataFrame, segment: int) -> DataFrame:
    """(c, pos, seq): strings of the symbols of at most ``segment`` neighbouring rows; pos is the first row's."""
    grouped = symbols.groupBy("c", F.expr(f"pos div {int(segment)}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "sym"))).alias("own"))
    return durable(
        grouped.select("c", F.col("own")[0]["pos"].alias("pos"), F.array_join(F.transform("own", lambda x: x["sym"]), "").alias("seq")),
        "repair_segments",
    )


def transfers(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """(seq, costs, edits): the matrix of every distinct string; null where no edits lead from state to state."""
    states = [(i, j) for i in range(4) for j in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Grammar(grammar.rules)
        for batch in batches:
            costs, edits = [], []
            for text in batch.column(0).to_pylist():
                matrix = known.transfer(text)
                entries = [matrix.get(s) for s in states]
                costs.append([None if e is None else e[0] for e in entries])
                edits.append([None if e is None else str(e[1]) for e in entries])
            columns = [batch.column(0), pa.array(costs, pa.list_(pa.int64())), pa.array(edits, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["seq", "costs", "edits"])

    return durable(sequences.select("seq").mapInArrow(run, "seq string, costs array<long>, edits array<string>"), "repair_transfers")


def _best_path(matrices: list[Matrix]) -> list[Rope]:
    """Each segment's part of the cheapest edits of a conversation, the last one's with the insertions at the end."""
    now: dict[int, tuple[int, Rope, tuple | None]] = {_START: (0, Rope(), None)}
    for matrix in [*matrices, {k: v for k, v in insertions().items() if k[1] in _ACCEPTED}]:
        after: dict[int, tuple[int, Rope, tuple | None]] = {}
        for (i, j), (cost, edits) in matrix.items():
            if i in now:
                total, whole = now[i][0] + cost, now[i][1] + edits
                if j not in after or (total, whole) < after[j][:2]:
                    after[j] = total, whole, (now[i][2], edits)
        now = after
    _, _, path = min(now.values(), key=lambda x: x[:2])
    parts = []
    while path is not None:
        path, edits = path
        parts.append(edits)
    parts.reverse()
    return [*parts[:-2], parts[-2] + parts[-1]]


def edits_of(segments: DataFrame, matrices: DataFrame) -> DataFrame:
    """(c, pos, seq, edits): the segments with their part of their conversation's cheapest edits."""
    dealt = segments.join(matrices, "seq").repartition("c").sortWithinPartitions("c", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            parts = _best_path([r["matrix"] for r in held])
            columns = [[r[k] for r in held] for k in ("c", "pos", "seq")]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array([str(p) for p in parts], pa.string())], names=["c", "pos", "seq", "edits"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["c"] != row["c"]:
                    yield flush()
                    held = []
                entries = zip(row.pop("costs"), row.pop("edits"), strict=True)
                row["matrix"] = {(k // 4, k % 4): (cost, Rope(text)) for k, (cost, text) in enumerate(entries) if cost is not None}
                held.append(row)
        if held:
            yield flush()

    return durable(dealt.select("c", "pos", "seq", "costs", "edits").mapInArrow(run, "c string, pos long, seq string, edits string"), "repair_edits")


class _Conversation:
    """The running result of one conversation's rows."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.low = self.high = self.turn = self.initial = None
        self.audit: list[str] = []
        self.state, self.lines, self.sha = _START, 0, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def row(self, turn: int | None, role: str, text: str, symbol: str, edits: str) -> None:
        """One row and its edits: insertions before it, its own letter, insertions after the last row."""
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if symbol == _DELETED:
            if _SOLID.search(text):
                self.duplicate += 1
            else:
                self.blank += 1
        elif symbol.isupper():
            self.truncated += 1
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.high = turn
            self.turns += turn != self.turn
            self.turn = turn
        self.audit.append(edits)
        for edit in edits:
            if edit == "D":
                self.cost += DELETE
                continue
            if edit == "K":
                self.state = _KEEP[initial][self.state]
                self._line(role, text)
            else:
                self.state = _NEXT[self.state]
                self._line(_ROLE[self.state], "" if edit == "I" else text)
            self.cost += {"K": 0, "R": REROLE, "I": INSERT}[edit] + (TRUNCATED if edit != "I" and symbol.isupper() else 0)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_EDITS = re.compile(r"I*[KRD](?:I+$)?")


def results(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """One row per conversation, from its rows and edits in order."""
    plain = rows.select("c", "pos", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("string").alias("seq"), F.lit(None).cast("string").alias("edits"))
    none = F.lit(None).cast("string")
    marks = edits.select("c", "pos", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("text"), "seq", "edits")
    dealt = plain.unionByName(marks).repartition("c").sortWithinPartitions("c", "pos", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, seq, steps, at = None, _Conversation(), "", [], 0
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kinds = [pa.string(), *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*done, strict=True), kinds, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["c", *_COUNTS, "audit", "repaired_sha256"])

        for batch in batches:
            for c, kind, turn, role, text, own, edits in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5, 6, 7)), strict=True):
                if c != now:
                    if now is not None:
                        done.append((now, *state.result()))
                    now, state = c, _Conversation()
                if kind == 0:
                    seq, steps, at = own, _EDITS.findall(edits), 0
                else:
                    state.row(turn, role, text, seq[at], steps[at])
                    at += 1
            if done:
                yield flush()
        if now is not None:
            done.append((now, *state.result()))
            yield flush()

    schema = "c string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return dealt.mapInArrow(run, schema)


def repair(
    df: DataFrame,
    conversations: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment: int = SEGMENT,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per conversation of ``conversations`` (by default of ``df``): faults, cost, audit, hash of the repaired text."""
    rows = ordered_rows(df, conv_col, turn_col, role_col, text_col)
    parts = segments(symbols(rows), segment)
    sequences = durable(parts.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "repair_sequences")
    matrices = transfers(sequences, learn_grammar(sequences, rounds))
    found = results(rows, edits_of(parts, matrices))
    every = (df if conversations is None else conversations).select(F.col(conv_col).alias("id")).distinct().withColumn("c", _key("id"))
    return every.join(found, "c", "left").select(
        F.col("id").alias(conv_col),
        *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults: rows dropped, emptied, cut, repeated or reroled by crc32 of their names."""
    space = F.lit(" ")
    fault = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    rows = df.select("conv_id", "turn", F.coalesce(F.col("role"), space).alias("role"), text.alias("text"), fault.alias("fault")).where("fault <> 0")
    rows = rows.withColumns(
        {
            "text": F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text")),
            "role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role")),
            "times": F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        }
    )
    return rows.select("conv_id", "turn", "role", "text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair(damage(rows), rows)


SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce('=' || conv_id::VARCHAR, '') AS c, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
),
bytes AS (
  SELECT *, list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i::INTEGER, 1))::BIGINT) AS b FROM named
),
crc AS (
  SELECT c, turn, role, body, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda r, x:
           list_reduce(list_prepend(xor(r, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, k:
             CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 20 AS fault
  FROM bytes
),
damaged AS (
  SELECT c, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body
  FROM crc, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS copies
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(body)) AS i FROM damaged
),
judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(body, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY c, role, body ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(body, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
  FROM placed
),
insertions(s, t, n, lines) AS (
  VALUES (0, 0, 0, NULL), (0, 2, 1, 'user:'), (0, 3, 2, 'user:' || chr(10) || 'assistant:'),
         (1, 1, 0, NULL), (1, 2, 1, 'user:'), (1, 3, 2, 'user:' || chr(10) || 'assistant:'),
         (2, 2, 0, NULL), (2, 3, 1, 'assistant:'), (3, 3, 0, NULL), (3, 2, 1, 'user:')
),
edits(s, t, letter, initial, price, role) AS (
  VALUES (0, 1, 'K', 's', 0, NULL), (0, 2, 'K', 'u', 0, NULL), (1, 2, 'K', 'u', 0, NULL), (3, 2, 'K', 'u', 0, NULL), (2, 3, 'K', 'a', 0, NULL),
         (0, 2, 'R', NULL, 3, 'user'), (1, 2, 'R', NULL, 3, 'user'), (3, 2, 'R', NULL, 3, 'user'), (2, 3, 'R', NULL, 3, 'assistant'),
         (0, 0, 'D', NULL, 4, NULL), (1, 1, 'D', NULL, 4, NULL), (2, 2, 'D', NULL, 4, NULL), (3, 3, 'D', NULL, 4, NULL)
),
paths AS (
  SELECT DISTINCT c, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, NULL::VARCHAR AS repaired FROM judged
  UNION ALL
  SELECT c, i, state, cost, audit, repaired FROM (
    SELECT p.c, r.i, e.t AS state,
           p.cost + 3 * n.n + e.price + CASE WHEN r.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
           p.audit || repeat('I', n.n) || e.letter AS audit,
           nullif(concat_ws(chr(10), p.repaired, n.lines, CASE WHEN e.letter <> 'D' THEN coalesce(e.role, r.role) || ':' || r.body END), '') AS repaired
    FROM paths p
    JOIN judged r ON r.c = p.c AND r.i = p.i + 1
    JOIN insertions n ON n.s = p.state
    JOIN edits e ON e.s = n.t AND (e.initial IS NULL OR e.initial = r.initial)
                AND (e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  ) QUALIFY row_number() OVER (PARTITION BY c, state ORDER BY cost, audit) = 1
),
facts AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY c
),
best AS (
  SELECT f.*, p.cost + 3 * n.n AS cost, p.audit || repeat('I', n.n) AS audit, concat_ws(chr(10), p.repaired, n.lines) AS repaired
  FROM facts f JOIN paths p ON p.c = f.c AND p.i = f.n JOIN insertions n ON n.s = p.state AND n.t IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY f.c ORDER BY p.cost + 3 * n.n, p.audit || repeat('I', n.n)) = 1
)
SELECT DISTINCT d.conv_id, coalesce(b.gaps, 0)::BIGINT AS gaps, coalesce(b.blank, 0)::BIGINT AS blank,
       coalesce(b.duplicate, 0)::BIGINT AS duplicate, coalesce(b.truncated, 0)::BIGINT AS truncated,
       coalesce(b.illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit,
       sha256(coalesce(b.repaired, '')) AS repaired_sha256
FROM named d LEFT JOIN best b ON b.c = d.c
"""
