"""Conversation repair: alignments against an exhaustive search over the grammar's
automaton, and odd tables."""

from __future__ import annotations

import hashlib
import itertools
import random
from functools import lru_cache

import pytest

from candlewick.llm import conversations as C
from candlewick.llm.queries import damaged, op13

SCHEMA = "conv_id long, turn long, role string, text string"


def _search(codes: bytes) -> tuple[int, str]:
    """Every edit at every turn and state, at most four inserts in a row."""
    @lru_cache(None)
    def go(i, state, inserts):
        options = [(0, "")] if i == len(codes) and state in (0, 3) else []
        to = 3 if state == 2 else 2
        if i < len(codes):
            cls, fault = codes[i] & 3, codes[i] >> 2
            cost, rest = go(i + 1, state, 0)
            options.append((cost + 4, "D" + rest))
            if fault not in (1, 2):
                worse = 3 if fault == 3 else 0
                if cls == to or (cls == 1 and state == 0):
                    cost, rest = go(i + 1, cls, 0)
                    options.append((cost + worse, "K" + rest))
                if cls != to:
                    cost, rest = go(i + 1, to, 0)
                    options.append((cost + worse + 3, "R" + rest))
        if inserts < 4:
            cost, rest = go(i, to, inserts + 1)
            options.append((cost + 3, "I" + rest))
        return min(options) if options else (1 << 30, "")

    return go(0, 0, 0)


def test_every_short_conversation():
    for n in range(4):
        for codes in itertools.product(range(16), repeat=n):
            assert C.repair_codes(bytes(codes)) == _search(bytes(codes))


@pytest.mark.parametrize("turns", [16, 1, 2, 3, 5])
def test_pieces_of_any_length_give_the_same(monkeypatch, turns):
    monkeypatch.setattr(C, "PIECE", turns)
    rng = random.Random(turns)
    for _ in range(150):
        codes = bytes(rng.choices(range(16), k=rng.randint(4, 14)))
        assert C.repair_codes(codes) == _search(codes)


def test_the_band_changes_nothing():
    rng = random.Random(3)
    for _ in range(200):
        codes = bytes(rng.choices(range(16), k=rng.randint(0, 8)))
        for target in C.targets(0, rng.randint(0, 9)):
            free = C.align(codes, target, C.NEVER - 1, True)
            if free is not None:
                assert C.align(codes, target, free[0], True) == free
                assert C.align(codes, target, free[0] - 1, True) is None


def _expected(rows):
    """The audit's columns of one conversation's rows, in order."""
    seen, codes, kinds = set(), [], [0, 0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(C.SPACE)
        fault = 1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3
        seen.add((role, text))
        kinds[fault] += 1
        codes.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + 4 * fault)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a, b) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip([r[1][:1] for r in rows], [r[1][:1] for r in rows[1:]]))
    cost, audit = _search(bytes(codes))
    state, at, lines = 0, 0, []
    for letter in audit:
        to = 3 if state == 2 else 2
        if letter != "I":
            _, role, text = rows[at]
            at += 1
        if letter == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            lines.append(f"{role}:{text}")
        elif letter != "D":
            state = to
            lines.append(f"{C.ROLES[to]}:{'' if letter == 'I' else text}")
    return (gaps, *kinds[1:], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest())


def test_op13_odd_rows(spark, tmp_root):
    rng = random.Random(11)
    rows = [
        (None, None, None, None), (None, None, None, None), (None, 3, "user", "Hi."), (1, 0, "user", "Tell me more"),
        (1, 0, "user", "Tell me more"), (1, 5, "assistant", "no end  \n"), (2, None, "tool", "x!"), (2, None, "", "y?"),
        (3, 1, "system", "Été 🎉."), (3, -4, "USER", " "), (4, 2**40, "user", "a:b\nc."), (4, -(2**40), "assistant", "z."),
    ]
    rows += [(5, i, rng.choice(["user", "assistant", "system", "bot"]), rng.choice(["Yes.", "no", " ", "Why?"])) for i in range(12)]
    rows += [(6, i, ("user", "assistant")[i % 2], f"{'long ' * 5000}{i}.") for i in range(8)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS hash", "'q' AS audit", "2 AS at", "3 AS edit", "4 AS blank")
    df.write.parquet(f"{tmp_root}/conversations.parquet")
    out = {r.conv_id: tuple(r)[1:] for r in op13(spark, tmp_root).collect()}
    assert set(out) == {r[0] for r in rows}
    groups = {}
    for r in damaged(df).collect():
        groups.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    for conv, got in out.items():
        assert got == _expected(sorted(groups.get(conv, []), key=_order))


def test_repaired_turns_of_an_intact_conversation_stay(spark):
    rows = [(1, i, r, f"{i}.") for i, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    df = spark.createDataFrame(rows, SCHEMA)
    audits = C.audit(spark, df)
    assert [tuple(r) for r in audits.collect()] == [(1, 0, 0, 0, 0, 0, 0, "KKKKK")]
    got = C.repaired(spark, df, audits).collect()
    assert [(r.conv_id, r.at, r.edit, r.turn, r.role, r.text) for r in got] == [
        (1, i, "K", i, role, text) for i, (_, _, role, text) in enumerate(rows)]


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    audits = C.audit(spark, none)
    assert audits.count() == 0 and C.digests(spark, C.repaired(spark, none, audits)).count() == 0


def test_a_long_conversation(spark):
    """Many more turns than one alignment takes, in a table of one conversation."""
    n = 20_000
    df = spark.range(n).selectExpr(
        "7L AS conv_id", "id AS turn", "CASE WHEN id % 1000 = 999 THEN 'bot' WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role",
        "concat('t', id, '.') AS text")
    row = C.audit(spark, df).first()
    assert row.cost == 3 * (n // 1000) and row.audit.count("R") == n // 1000 and len(row.audit) == n
    one = C.digests(spark, C.repaired(spark, df, C.audit(spark, df))).first()
    want = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:t{i}." for i in range(n))
    assert one.repaired_sha256 == hashlib.sha256(want.encode()).hexdigest()
