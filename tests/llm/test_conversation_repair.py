"""Conversation repair: every alignment of short conversations by brute force, long ones by an automaton, edge cases."""

import hashlib
import random
from functools import cache
from itertools import product

import pytest
from pyspark.sql import Row

from llm import conversation_repair as C
from llm.conversation_repair import CUT_SHORT, FREE, MUST_GO, align, replay


def every_repair(initials, faults):
    """(cost, audit) of all edit sequences to targets of up to 2n + 2 characters, by trying all of them."""
    n = len(initials)
    found = []
    for length in range(2 * n + 3):
        for lead in ("", "s"):
            if (length - len(lead)) % 2 or lead and length < 3:
                continue
            target = lead + "ua" * ((length - len(lead)) // 2)

            @cache
            def ways(i, j, target=target):
                if i == n and j == len(target):
                    return ((0, ""),)
                out = []
                if i < n:
                    out += [(4 + c, "D" + a) for c, a in ways(i + 1, j)]
                if i < n and j < len(target) and faults[i] != MUST_GO:
                    extra = 3 * (faults[i] == CUT_SHORT)
                    if initials[i] == target[j]:
                        out += [(extra + c, "K" + a) for c, a in ways(i + 1, j + 1)]
                    elif target[j] != "s":
                        out += [(extra + 3 + c, "R" + a) for c, a in ways(i + 1, j + 1)]
                if j < len(target) and target[j] != "s":
                    out += [(3 + c, "I" + a) for c, a in ways(i, j + 1)]
                return tuple(sorted(out)[:1])
            found += ways(0, 0)
    return min(found)


def automaton(initials, faults):
    """The same by a plain shortest path over (row, state), audits compared from the end."""
    after = {"b": "u", "s": "u", "u": "a", "a": "u"}
    best = {s: (0, "") if s in "ba" else (3, "I") if s == "u" else (6, "II") for s in "bsua"}
    for c, f in zip(reversed(initials), reversed(faults)):
        now = {}
        for s in "bsua":
            ways = [(4 + best[s][0], "D" + best[s][1])]
            if f != MUST_GO:
                extra = 3 * (f == CUT_SHORT)
                t = after[s]
                ways.append((extra + 3 * (c != t) + best[t][0], ("K" if c == t else "R") + best[t][1]))
                if s == "b" and c == "s":
                    ways.append((extra + best["s"][0], "K" + best["s"][1]))
            now[s] = min(ways)
        for _ in range(2):
            now = {s: min(now[s], (3 + now[after[s]][0], "I" + now[after[s]][1])) for s in now}
        best = now
    return best["b"]


def test_every_short_conversation():
    for n in range(5):
        for initials in product("suax", repeat=n):
            for faults in product((FREE, MUST_GO, CUT_SHORT), repeat=n) if n < 4 else [(0, 0, 0, 0), (0, 2, 0, 1), (2, 0, 1, 0), (2, 2, 2, 2)]:
                if n:
                    assert align("".join(initials), bytes(faults)) == every_repair("".join(initials), faults), (initials, faults)
    assert align("", b"") == (0, "")


@pytest.mark.parametrize("n", [7, 30, 200, 700])
def test_long_conversations(n):
    rng = random.Random(n)
    for _ in range(200 if n < 100 else 12):
        initials = "".join(rng.choice("suuaaax") if rng.random() < 0.3 else "ua"[i % 2] for i in range(n))
        faults = bytes(rng.choice((0, 0, 0, 0, 1, 2)) for _ in range(n))
        assert align(initials, faults) == automaton(initials, faults)


def test_blocks_are_filled_in_again(monkeypatch):
    monkeypatch.setattr(C, "max", lambda *a: 3 if a[0] == 64 else max(*a), raising=False)
    rng = random.Random(3)
    for _ in range(60):
        initials = "".join(rng.choice("sua") for _ in range(25))
        faults = bytes(rng.choice((0, 0, 1, 2)) for _ in range(25))
        assert align(initials, faults) == automaton(initials, faults)


def expected(rows):
    """By the contract, in plain Python: rows (turn, role, text) of one conversation that are present."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        if fault:
            counts[fault] += 1
        faults.append({"blank": MUST_GO, "duplicate": MUST_GO, "truncated": CUT_SHORT, None: FREE}[fault])
        seen.add((role, text))
    first = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = automaton([c or "x" for c in first], faults)
    text = "\n".join(f"{r}:{x}" for _, r, x in replay(audit, ((r, x) for _, r, x in rows)))
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **counts,
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


SCHEMA = "conv_id long, turn long, role string, text string, conv string, head string, kind int, cost string"


def check(spark, rows, schema=SCHEMA):
    got = C.repair(spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], schema).repartition(3)).collect()
    by = {}
    for conv, *r in rows:
        by.setdefault(conv, []).append(tuple(r))
    assert {r.conv_id for r in got} == set(by) and len(got) == len(by)
    for r in got:
        assert {k: r[k] for k in expected(by[r.conv_id])} == expected(by[r.conv_id]), r.conv_id


def test_edges(spark):
    check(spark, [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."),
        (2, 0, "assistant", "Hello."), (2, 0, "assistant", "Hello."), (2, 9, "user", "x" * 200_000),
        (3, None, "user", None), (3, None, None, "no."), (3, 5, "", "empty role."),
        (None, 1, "user", "null conversation."), (None, 2, "user", "again?"), (None, 2, "user", "again!"),
        (4, 1, "system", "only a system row."), (5, 1, "user", "\t\n "), (6, 1, "tool", "odd role!"), (6, 3, "üser", "odd role!"),
        (7, 2, "user", "a.\n"), (7, 1, "user", "ends without"), (7, 4, "system", "late."), (7, 5, "assistant", "b.")])


def test_empty_table(spark):
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.repaired_turns(spark.createDataFrame([], SCHEMA)).collect() == []


def test_string_ids_and_absent_rows(spark):
    rows = [("a", "1", "user", "Hi.", False), ("a", "2", "assistant", "Ho.", True), ("b", "x", "user", "Hi.", True)]
    got = {r.conv_id: r for r in C.repair(spark.createDataFrame(rows, "conv_id string, turn string, role string, text string, absent boolean")).collect()}
    assert (got["a"].cost, got["a"].audit, got["a"].repaired_sha256) == (3, "KI", hashlib.sha256(b"user:Hi.\nassistant:").hexdigest())
    assert (got["b"].gaps, got["b"].cost, got["b"].audit, got["b"].repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())


def test_one_conversation_of_many_rows(spark):
    rng = random.Random(5)
    check(spark, [(1, t, rng.choice(("user", "assistant", "user", "system")), f"turn {t}{rng.choice('.!x')}") for t in range(3000)])


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "You there?"), (1, 2, "user", " ")]
    got = C.repaired_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("place").collect()
    assert got == [Row(conv_id=1, place=0, role="user", text="Hi.", edit="K"), Row(conv_id=1, place=1, role="assistant", text="You there?", edit="R")]


def test_damage_kinds(spark):
    import zlib
    rows = [(c, t, "assistant", "Well. Yes!") for c in range(40) for t in range(5)]
    got = C.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.absent))
    plain = ("assistant", "Well. Yes!", False)
    want = {0: [("assistant", "Well. Yes!", True)], 1: [("assistant", "", False)], 2: [("assistant", "Well Yes", False)],
            3: [plain] * 2, 4: [("user", "Well. Yes!", False)]}
    for (c, t), found in by.items():
        assert found == want.get(zlib.crc32(f"{c}:{t}".encode()) % 20, [plain])
