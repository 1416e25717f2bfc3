"""Conversation repair: brute force over all rows of edits, long conversations in pieces, edge cases."""

import hashlib
import heapq
import random
import re
import time
import zlib

import pytest
from conftest import SF_SMALL
from pyspark.sql import types as T

from dwkit.llm import conversations as C
from dwkit.llm import queries

FORM = re.compile(r"(s?(ua)+)?")


def cheapest(roles, faults):
    """Rows of edits in order of cost, then ASCII, until one gives the form (states by what was emitted last)."""
    heap, done = [(0, "", 0, "^")], set()
    while heap:
        cost, edits, i, state = heapq.heappop(heap)
        if i == len(roles) and state in "^a":
            return cost, edits
        if (i, state) in done:          # reached before by a row of edits that is cheaper, or as cheap and less
            continue
        done.add((i, state))
        new = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 3, edits + "I", i, new))
        if i < len(roles):
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, state))
            if faults[i] < 2 or faults[i] == 3:
                if faults[i] != 1:
                    more = 3 * (faults[i] == 3)
                    heapq.heappush(heap, (cost + 3 + more, edits + "R", i + 1, new))
                    if state + roles[i] in ("^s", "^u", "su", "ua", "au"):
                        heapq.heappush(heap, (cost + more, edits + "K", i + 1, roles[i]))


def every(roles, faults, most):
    """All rows of edits up to a cost, by plain enumeration; the least of the cheapest."""
    best = None

    def go(i, out, edits, cost):
        nonlocal best
        if cost > most or best is not None and cost > best[0]:
            return
        if i == len(roles) and FORM.fullmatch(out):
            best = min(best or (cost, edits), (cost, edits))
        for role in "ua":
            go(i, out + role, edits + "I", cost + 3)
        if i < len(roles):
            go(i + 1, out, edits + "D", cost + 4)
            if faults[i] in (0, 3):
                more = 3 * (faults[i] == 3)
                go(i + 1, out + (roles[i] or "-"), edits + "K", cost + more)
                for role in "ua":
                    go(i + 1, out + role, edits + "R", cost + 3 + more)
    go(0, "", "", 0)
    return best


def test_search_against_plain_enumeration():
    r = random.Random(1)
    for _ in range(150):
        roles = [r.choice(["s", "u", "u", "a", "a", "t", ""]) for _ in range(r.randint(0, 4))]
        faults = [r.choice([0, 0, 0, 1, 2, 3]) for _ in roles]
        assert C.solve(roles, faults) == every(roles, faults, 18) == cheapest(roles, faults)


@pytest.mark.parametrize("leaf", [1, 3, 8, 64])
def test_leaves_give_the_same_edits(leaf):
    r = random.Random(leaf)
    for _ in range(120):
        roles = [r.choice(["s", "u", "u", "u", "a", "a", "t"]) for _ in range(r.randint(0, 30))]
        faults = [r.choice([0, 0, 0, 0, 1, 2, 3]) for _ in roles]
        assert C.solve(roles, faults, leaf=leaf) == cheapest(roles, faults)


def test_estimate_is_never_too_high():
    r = random.Random(5)
    for _ in range(400):
        roles = [r.choice("suat") for _ in range(r.randint(0, 9))]
        faults = [r.choice([0, 0, 1, 2, 3, 3]) for _ in roles]
        assert C.Search(roles, faults).least(0, "^") <= cheapest(roles, faults)[0]


def test_time_of_long_conversations():
    r = random.Random(2)
    roles, faults = [r.choice("ua") for _ in range(20_000)], [r.choice([0, 0, 0, 0, 0, 1, 2, 3]) for _ in range(20_000)]
    began = time.perf_counter()
    cost, edits = C.solve(roles, faults)
    assert time.perf_counter() - began < 120 and cost > 0 and len(edits.replace("I", "")) == 20_000


SPACES = " \t\n\x0b\x0c\r"
SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("block", T.StringType()), T.StructField("ord", T.StringType()),
                       T.StructField("key", T.LongType()), T.StructField("conv", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "o", 1, "c") for r in rows], SCHEMA)


def expected(rows):
    """The contract in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        here = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha1(t[2].encode()).digest()))
        roles, faults, seen = [t[1][:1] for t in turns], [], set()
        for _, role, text in turns:
            faults.append(1 if not text.strip(SPACES) else 2 if (role, text) in seen else 3 if text.strip(SPACES)[-1] not in ".!?" else 0)
            seen.add((role, text))
        numbers = [t[0] for t in turns if t[0] is not None]
        cost, audit = cheapest(roles, faults)
        fixed, state, at = [], "^", 0
        for e in audit:
            turn = turns[at] if e != "I" else (None, "", "")
            at += e != "I"
            if e != "D":
                state = turn[1][:1] if e == "K" else "a" if state == "u" else "u"
                fixed.append((turn[1] if e == "K" else {"u": "user", "a": "assistant"}[state]) + ":" + turn[2])
        assert FORM.fullmatch("".join(x[:1] for x in fixed))
        out.append((conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count(1), faults.count(2), faults.count(3),
                    sum(x + y not in ("su", "ua", "au") for x, y in zip(roles, roles[1:])), cost, audit,
                    hashlib.sha256("\n".join(fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_on_a_whole_table(spark):
    for sf in (SF_SMALL, SF_SMALL.replace("0.001", "0.01")):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert sorted(map(tuple, queries.op11_conversation_repair(spark, sf).collect()), key=str) == expected(rows)


def some_rows(seed, convs, longest):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randint(1, longest)):
            rows.append((c, r.choice([t, t, t, t, t, None, t // 2]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                         r.choice([f"Text {t}.", f"Text {t}!", "yes.", "cut off", " \t", "", None, "tail. \n", "a ", "?"])))
    return rows


def test_edges(spark, tmp_path):
    rows = [*some_rows(1, 40, 12), (None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (None, None, None, None),
            (900, 2**63 - 1, "user", "x."), (900, -2**63, "user", "x."), (901, 1, "user", "word " * 100_000 + "."), (901, 2, "user", "no end " * 50_000),
            *[(902, 1, "user", "same.")] * 50]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, queries.op11_conversation_repair(spark, str(tmp_path)).collect()), key=str)
    want = [(r[0], min(r[1], 2**63 - 1), *r[2:]) for r in expected(rows)]
    assert got == want
    empty = C.repair(frame(spark, []))
    assert empty.report.count() == 0 and empty.turns.count() == 0


def test_blocks_of_long_conversations(spark):
    """Two conversations hold most turns; blocks of eight turns, leaves of three."""
    rows = [*some_rows(2, 15, 8), *[(50, *r[1:]) for r in some_rows(3, 20, 10)], *[(None, *r[1:]) for r in some_rows(4, 20, 10)]]
    fixed = C.repair(queries.damaged(frame(spark, rows)), leaf=3, block_bits=3)
    got = sorted(((r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in fixed.report.collect()), key=str)
    want = {w[0]: w for w in expected(rows)}
    assert got == sorted((w[:-1] for w in want.values() if w[7] or w[6] or any(w[1:6])), key=str)
    lines = {}
    for r in sorted(fixed.turns.collect(), key=lambda r: (r.block, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == w[-1] for c, w in want.items())
