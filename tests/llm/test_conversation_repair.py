"""Conversation repair against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cohortex.llm import conversation_repair as cr

from .conftest import SF, same_rows

LEGAL = re.compile(r"(s?(ua)+)?")
SOLID = re.compile(r"[^\x20\x09-\x0D]")
ROWS = "conv_id long, turn long, role string, text string"


def exhaustive(symbols):
    """(cost, audit) of the cheapest edits of a string of symbols, by trying all with up to two insertions in a place."""
    best = None
    choices = [[("D", "", 4)] if s == "d" else [("K", s.lower(), 3 * s.isupper()), ("R", "u", 3 + 3 * s.isupper()), ("R", "a", 3 + 3 * s.isupper()), ("D", "", 4)] for s in symbols]
    gaps = [("", "", 0)] + [("I", r, 3) for r in "ua"] + [("II", r, 6) for r in ("uu", "ua", "au", "aa")]
    places = [x for c in choices for x in (gaps, c)] + [gaps]
    for way in itertools.product(*places):
        if LEGAL.fullmatch("".join(w[1] for w in way)):
            found = sum(w[2] for w in way), "".join(w[0] for w in way)
            best = min(best or found, found)
    return best


def forward(symbols):
    """(cost, audit, roles) by a plain row-by-row DP over whole strings."""
    now = {0: (0, "", ())}

    def insert(states):
        todo = list(states)
        while todo:
            i = todo.pop()
            j = cr._NEXT[i]
            cost, audit, roles = states[i]
            new = (cost + 3, audit + "I", (*roles, (cr._ROLE[j], None)))
            if j not in states or new[:2] < states[j][:2]:
                states[j] = new
                todo.append(j)
        return states

    for at, s in enumerate(symbols):
        after = {}
        for i, (cost, audit, roles) in insert(dict(now)).items():
            ways = [(i, 4, "D", ())]
            if s != "d":
                more = 3 * s.isupper()
                ways.append((cr._NEXT[i], 3 + more, "R", ((cr._ROLE[cr._NEXT[i]], at),)))
                if i in cr._KEEP.get(s.lower(), {}):
                    ways.append((cr._KEEP[s.lower()][i], more, "K", ((None, at),)))
            for j, c, letter, role in ways:
                new = (cost + c, audit + letter, roles + role)
                if j not in after or new[:2] < after[j][:2]:
                    after[j] = new
        now = after
    return min((v for i, v in insert(now).items() if i in (0, 3)), key=lambda v: v[:2])


def brute(rows, every):
    """The result row of every conversation of ``every``; rows are (conv, turn, role, text) after damage."""
    out = []
    for conv in every:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, symbols, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        cost, audit, roles = forward(symbols)
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        text = "\n".join(f"{role or own[at][1]}:{'' if at is None else own[at][2]}" for role, at in roles)
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(repr, out))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (conv, turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
        out += [row] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def got(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(repr(tuple(r)) for r in df.collect())


def test_matrices_are_exhaustive_search():
    rng = random.Random(5)
    texts = [""] + [c for c in "suaxSUAXd"] + ["".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(2, 3))) for _ in range(60)]
    for text in texts:
        grammar = cr.Grammar([text[:2]] if len(text) > 2 else [])
        ropes = cr._best_path([grammar.transfer(text)]) if text else [cr.Rope()]
        assert (str(ropes[0]) == forward(text)[1]) and forward(text)[:2] == exhaustive(text)


def test_grammar_changes_nothing_and_is_shared(spark):
    rng = random.Random(1)
    texts = ["s" + "ua" * rng.randint(1, 30) + rng.choice(["", "d", "U", "xA"]) + "ua" * rng.randint(0, 9) for _ in range(80)]
    texts += ["".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    frame = spark.createDataFrame([(t, 1 + i % 3) for i, t in enumerate(sorted(set(texts)))], "seq string, n long")
    grammar = cr.learn_grammar(frame)
    assert grammar.rules[0] == "ua" and len(grammar.rules) > 20
    assert sum(map(len, map(grammar.compress, texts))) < 0.6 * sum(map(len, texts))
    plain = cr.Grammar()
    for t in texts:
        one, two = grammar.transfer(t), plain.transfer(t)
        assert {k: (c, str(r)) for k, (c, r) in one.items()} == {k: (c, str(r)) for k, (c, r) in two.items()}
        assert str(cr._best_path([one])[0]) == forward(t)[1]


def test_ropes_compare_as_text():
    rng = random.Random(2)

    def rope(text):
        if len(text) < 3 or rng.random() < 0.2:
            return cr.Rope(text)
        cut = rng.randint(1, len(text) - 1)
        return rope(text[:cut]) + rope(text[cut:])

    for _ in range(500):
        a = "".join(rng.choice("DK") for _ in range(rng.randint(0, 12)))
        b = a[: rng.randint(0, len(a))] + "".join(rng.choice("DK") for _ in range(rng.randint(0, 4)))
        assert (rope(a) < rope(b)) == (a < b) and str(rope(a)) == a


@pytest.mark.parametrize("segment", [1024, 4, 1])
def test_is_brute_force(spark, segment):
    rng = random.Random(segment)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(0, 14)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "sys", "tool", "", None, "unknown"])
            text = rng.choice(["Yes.", "No", "Why?  ", "", " \t", "a.b", "ok!\n", "é…", "One. ", "Two"]) + str(turn) * rng.randint(0, 1) if rng.random() < 0.9 else None
            rows.append((conv, rng.choice([turn, turn, turn, None, 3 * turn]), role, text))
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    own = df.withColumns({n: F.lit("mine") for n in ("c", "pos", "seq", "kind", "edits", "id", "digest", "sym", "input")})
    order = [tuple(r) for r in df.collect()]
    assert got(cr.repair(own, segment=segment)) == brute(order, {r[0] for r in rows})


def test_one_huge_conversation(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant"]), rng.choice([f"Text {t}.", f"cut {t}", "same.", ""])) for t in range(5000)]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    assert got(cr.repair(df, segment=256)) == brute(rows, [7])


def test_query_is_brute_force(spark):
    from cohortex.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.001")) == brute(damaged(rows), {r[0] for r in rows})


def test_is_the_sql(spark):
    same_rows(cr.op11_conversation_repair(spark, SF), cr.SQL)


def test_conversations_without_rows_and_odd_damage(spark):
    rows = [(c, t, r, x) for c in (1, 2, 3, None, 55) for t, r, x in ((None, None, None), (0, "user", "Hi there."), (1, "assistant", "Yes! ok"), (1, "assistant", "Yes! ok"))]
    rows += [(c, 0, "user", "One.") for c in range(100, 160)]
    df = spark.createDataFrame(rows, ROWS)
    assert got(cr.repair(cr.damage(df), df)) == brute(damaged(rows), {r[0] for r in rows})
    empty = [r for r in cr.repair(cr.damage(df), df).collect() if r.audit == ""]
    assert empty and all(r.cost == 0 and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in empty)
    assert got(cr.repair(df.limit(0))) == []
