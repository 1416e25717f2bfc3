"""Repair of conversations whose turns are missing, doubled, blank, cut off or mislabelled.

A repaired conversation's role initials are ``(s?(ua)+)?``.  Turns are read in order and
each is kept (K, free, its role must fit), given the role that fits (R, 3) or deleted
(D, 4; a must for blank and duplicate turns), and turns without text may be inserted
anywhere (I, 3, with the role that fits).  A truncated turn that stays costs 3 more.
The answer is the cheapest row of edits, and of those the least in ASCII order.

``Search`` finds it by iterative-deepening A*: depth-first in the order D, I, K, R below a
bound on the cost, which is raised to the least cost seen above it until a search ends in
an accepting state; the first such path is the answer.  The estimate adds the musts that
are left to the neighbours that do not fit (an edit mends two of them at most).  A
transposition table holds, for every (turn, state) that has failed, the cost that it
needs at least, so a state is searched again only with more than that.

Long conversations are not searched in one piece: of every ``leaf`` turns the search gives
the cheapest edits from each state to each state, and these are joined from left to right
(inserted turns belong to the turn after them, so no row of edits begins another one and
ties are settled by the earliest leaf).  ``block`` turns at most meet in a task; blocks of a
conversation are joined by their 4 x 4 costs, and then each is repaired from the state
chosen for it to the next one.

In Spark: turns are put in order by a range partition on (conversation, turn, role, digest
of the text), which splits any conversation; their texts do not take part.  Duplicates are
found by a grouped minimum.  Texts are joined to the surviving turns by (conversation,
role, digest), which is unique there.

Order: turns without a number come first; turns of the same number follow each other by
role, then by the text's digest.  Null roles and texts count as one space.  Edge cases: a
null conversation id is an id like any other; repeated rows are duplicates; roles are told
by their first character (one that is none of s, u, a, or none at all, never fits); blank
means no character but white space; gaps beyond 2^63 - 1 are given as that; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dwkit.llm.common import staged

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK, DUPLICATE, CUT = 1, 2, 3                   # faults of a turn; 0 is none
LEAF, BLOCK_BITS = 64, 16                         # turns of a search; bits of the turns of a task
STATES = "^sua"                                   # nothing yet, or the last role's initial
ROLE = {"s": "system", "u": "user", "a": "assistant"}
_FITS = {"^s", "^u", "su", "ua", "au"}
_NEXT = {"^": "u", "s": "u", "u": "a", "a": "u"}  # what an inserted or renamed turn becomes
_CLOSE = {"^": "", "s": "II", "u": "I", "a": ""}  # what is missing after the last turn
_FAR = 1 << 60


class Search:
    """The cheapest edits of some turns, from a state to ``goal`` (None: to the end of the conversation)."""

    def __init__(self, roles: list[str], faults: list[int], goal: str | None = None) -> None:
        self.roles, self.faults, self.goal, self.n = roles, faults, goal, len(roles)
        self.failed: dict[tuple[int, str], int] = {}
        # Of the turns from i on: musts, the first that may stay, and halves owed by neighbours after it.
        self.must, self.first, self.owed = [0] * (self.n + 1), [self.n] * (self.n + 1), [0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            gone, after = faults[i] in (BLANK, DUPLICATE), self.first[i + 1]
            self.must[i] = self.must[i + 1] + (DELETE if gone else TRUNCATED if faults[i] == CUT else 0)
            self.first[i] = after if gone else i
            self.owed[i] = self.owed[i + 1] if gone else self._pair(roles[i], after, faults[i]) + self.owed[after]

    def _ends(self, state: str) -> bool:
        return state in "^a" if self.goal is None else state == self.goal

    def _pair(self, left: str, at: int, fault: int = 0) -> int:
        """Half points that the neighbours ``left`` and turn ``at`` owe: an edit costs 3 or more and mends
        two pairs at most, but deleting a truncated turn costs one more than what keeping it does."""
        if at == self.n:
            fits, other = self._ends(left), 0
        else:
            fits, other = left + self.roles[at] in _FITS, self.faults[at]
        return 0 if fits else 1 if CUT in (fault, other) else 3

    def least(self, i: int, state: str) -> int:
        at = self.first[i]
        return self.must[i] + (self._pair(state, at) + self.owed[at] + 1) // 2

    def run(self, entry: str) -> tuple[int, str]:
        """Cost and edits from ``entry``, which must be able to reach the goal."""
        bound = self.failed.get((0, entry), self.least(0, entry))
        while (path := self._deeper(0, entry, bound)) is None:
            bound = self.failed[0, entry]
        return bound, path

    def _deeper(self, i: int, state: str, left: int) -> str | None:
        need = self.failed.get((i, state))
        if need is None:
            need = self.failed[i, state] = self.least(i, state)
        if need > left:
            return None
        if i == self.n and self._ends(state):
            return ""
        least = _FAR
        for edit, cost, at, then in self._edits(i, state):
            if (path := self._deeper(at, then, left - cost)) is not None:
                return edit + path
            least = min(least, cost + self.failed[at, then])
        self.failed[i, state] = max(need, least)
        return None

    def _edits(self, i: int, state: str) -> Iterator[tuple[str, int, int, str]]:
        follows = _NEXT[state]
        if i == self.n:
            if self.goal is None:
                yield "I", INSERT, i, follows
            return
        role, fault = self.roles[i], self.faults[i]
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, follows
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            if state + role in _FITS:
                yield "K", more, i + 1, role
            yield "R", REROLE + more, i + 1, follows


def _reached(roles: list[str], faults: list[int], entry: str) -> str:
    """States that some turns can lead to."""
    stays = any(r == "s" and f not in (BLANK, DUPLICATE) for r, f in zip(roles, faults, strict=True))
    return {"^": "^sua" if stays else "^ua", "s": "sua"}.get(entry, "ua")


def exits(roles: list[str], faults: list[int], entries: str, leaf: int) -> dict[str, dict[str, tuple[int, str]]]:
    """Of each entry state the cheapest ``(cost, edits)`` to each state that the turns can lead to."""
    best: dict[str, dict[str, tuple[int, str]]] = {e: {e: (0, "")} for e in entries}
    for lo in range(0, len(roles), leaf):
        some, faulty = roles[lo:lo + leaf], faults[lo:lo + leaf]
        searches = {x: Search(some, faulty, x) for x in STATES}
        step = {m: {x: searches[x].run(m) for x in _reached(some, faulty, m)} for m in {m for of in best.values() for m in of}}
        for e, of in best.items():
            joined: dict[str, tuple[int, str]] = {}
            for m, (cost, edits) in of.items():
                for x, (more, then) in step[m].items():
                    if x not in joined or (cost + more, edits + then) < joined[x]:
                        joined[x] = (cost + more, edits + then)
            best[e] = joined
    return best


def solve(roles: list[str], faults: list[int], entry: str = "^", goal: str | None = None, leaf: int = LEAF) -> tuple[int, str]:
    """Cost and edits of turns from ``entry`` to ``goal`` (None: to the end of the conversation)."""
    if len(roles) <= leaf:
        return Search(roles, faults, goal).run(entry)
    of = exits(roles, faults, entry, leaf)[entry]
    if goal is not None:
        return of[goal]
    cost, edits, x = min((cost + INSERT * len(_CLOSE[x]), edits, x) for x, (cost, edits) in of.items())
    return cost, edits + _CLOSE[x]


def _groups(it: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Runs of rows with equal first two columns."""
    held: list[tuple] = []
    for batch in it:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:2] != held[0][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _some(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of ``size`` turns or edits, or a little more."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += 1 + len(row.get("out", ()))
        if held >= size:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _between(it: Iterator[pa.RecordBatch], schema: pa.Schema, leaf: int) -> Iterator[pa.RecordBatch]:
    """A block's costs from each state to each state, and the order of its rows of edits from a state."""
    def rows() -> Iterator[dict]:
        for turns in _groups(it):
            of = exits([t[4][:1] for t in turns], [t[6] for t in turns], STATES, leaf)
            order = {e: sorted(of[e], key=lambda x, e=e: of[e][x][1]) for e in STATES}
            yield {"conv": turns[0][0], "block": turns[0][1],
                   "cost": [of[e][x][0] if x in of[e] else _FAR for e in STATES for x in STATES],
                   "rank": [order[e].index(x) if x in of[e] else 4 for e in STATES for x in STATES]}
    return _some(rows(), schema, 1_000)


def _chosen(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states before and after each block of a conversation."""
    pdf = pdf.sort_values("block")
    cost, rank = pdf["cost"].tolist(), pdf["rank"].tolist()
    rest = {x: INSERT * len(_CLOSE[x]) for x in STATES}
    ways = []
    for c, r in zip(reversed(cost), reversed(rank), strict=True):
        best = {e: min((c[4 * j + k] + rest[x], r[4 * j + k], x) for k, x in enumerate(STATES)) for j, e in enumerate(STATES)}
        ways.append({e: b[2] for e, b in best.items()})
        rest = {e: b[0] for e, b in best.items()}
    entry, goal = ["^"], []
    for way in reversed(ways):
        goal.append(way[entry[-1]])
        entry.append(goal[-1])
    return pd.DataFrame({"conv": pdf["conv"], "block": pdf["block"], "entry": entry[:-1], "goal": goal, "last": [False] * (len(goal) - 1) + [True]})


def _repaired(it: Iterator[pa.RecordBatch], schema: pa.Schema, leaf: int) -> Iterator[pa.RecordBatch]:
    """A row per block: its counts, the cost, its edits, and the turns that they leave."""
    def rows() -> Iterator[dict]:
        for turns in _groups(it):
            roles, faults = [t[4][:1] for t in turns], [t[6] for t in turns]
            entry, goal, last = turns[0][7] or "^", turns[0][8], turns[0][9]
            cost, edits = solve(roles, faults, entry, goal, leaf)
            if last:
                cost, edits = cost + INSERT * len(_CLOSE[goal]), edits + _CLOSE[goal]
            out, state, at = [], entry, 0
            for edit in edits:
                _, _, _, turn, role, key, *_ = turns[at] if edit != "I" else (None,) * 6
                at += edit != "I"
                if edit != "D":
                    state = role[:1] if edit == "K" else _NEXT[state]
                    out.append({"turn": turn, "edit": edit, "role": role if edit == "K" else ROLE[state], "was": role, "key": key})
            numbers = [t[3] for t in turns if t[3] is not None]
            yield {"conv": turns[0][0], "block": turns[0][1], "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
                   "truncated": faults.count(CUT), "illegal": sum(x + y not in _FITS for x, y in zip(roles, roles[1:])),
                   "first": roles[0], "last": roles[-1], "low": min(numbers, default=None), "high": max(numbers, default=None),
                   "numbers": len(set(numbers)), "begins": turns[0][3], "ends": turns[-1][3], "cost": cost, "audit": edits, "out": out}
    return _some(rows(), schema, 20_000)


def _matched(a: DataFrame, b: DataFrame, how: str, *keys: str) -> DataFrame:
    """Join by conversation (null is one) and ``keys``, with the left side's columns and the right side's others."""
    names = {k: f"_{k}" for k in ("conv", *keys)}
    on = F.col("conv").eqNullSafe(F.col("_conv"))
    for k in keys:
        on = on & (F.col(k) == F.col(names[k]))
    return a.join(b.withColumnsRenamed(names), on, how).drop(*names.values())


@dataclass
class Repair:
    """``report``: a row per conversation that has turns, with ``gaps, blank, duplicate, truncated, illegal, cost, audit``.
    ``turns``: the repaired turns ``(conv, block, place, turn, edit, role, text)``, ordered by block and place."""
    report: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           leaf: int = LEAF, block_bits: int = BLOCK_BITS) -> Repair:
    """Report and repaired turns of every conversation of ``rows``."""
    blank_as = F.lit(" ")
    text, body = F.coalesce(F.col(text_col).cast("string"), blank_as), F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), blank_as).alias("role"), text.alias("text"))
    key = F.unhex(F.sha1(F.col("text").cast("binary")))
    short = rows.select("conv", "turn", "role", key.alias("key"),
                        F.when(body == "", BLANK).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0).alias("fault"),
                        F.monotonically_increasing_id().alias("any"))       # equal turns may be dealt apart
    order = ["conv", F.asc_nulls_first("turn"), "role", "key", "any"]
    turns = staged(short.repartitionByRange(*order).sortWithinPartitions(*order).drop("any")
                   .withColumn("ord", F.monotonically_increasing_id())
                   .withColumn("block", F.shiftright("ord", block_bits)), "turns")

    again = (turns.where(F.col("fault") != BLANK).groupBy("conv", "role", "key").agg(F.min("ord").alias("earliest"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    judged = (_matched(turns, again, "left", "role", "key")
              .withColumn("fault", F.when((F.col("fault") != BLANK) & (F.col("ord") > F.col("earliest")), DUPLICATE).otherwise(F.col("fault")))
              .select("conv", "block", "ord", "turn", "role", "key", "fault"))

    conv, kind = to_arrow_type(turns.schema["conv"].dataType), turns.schema["conv"].dataType.simpleString()
    head = [("conv", conv), ("block", pa.int64())]
    spans = staged(turns.groupBy("conv").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi").select("conv"), "spans")
    if spans.isEmpty():
        begun = judged.select("*", F.lit(None).cast("string").alias("entry"), F.lit(None).cast("string").alias("goal"), F.lit(False).alias("last"))
    else:
        long = _matched(judged, spans, "left_semi").repartition("conv", "block").sortWithinPartitions("conv", "block", "ord")
        costs = long.mapInArrow(partial(_between, leaf=leaf, schema=pa.schema([*head, ("cost", pa.list_(pa.int64())), ("rank", pa.list_(pa.int64()))])),
                                f"conv {kind}, block long, cost array<long>, rank array<long>")
        chosen = staged(costs.groupBy("conv").applyInPandas(_chosen, f"conv {kind}, block long, entry string, goal string, last boolean"), "states")
        begun = _matched(judged, chosen, "left", "block").withColumn("last", F.coalesce("last", F.lit(False)))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    left = pa.struct([("turn", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("was", pa.string()), ("key", pa.binary())])
    schema = pa.schema([*head, *[(c, pa.int64()) for c in (*counts, "numbers", "low", "high", "begins", "ends")],
                        ("first", pa.string()), ("last", pa.string()), ("audit", pa.string()), ("out", pa.list_(left))])
    blocks = staged(begun.repartition("conv", "block").sortWithinPartitions("conv", "block", "ord").mapInArrow(
        partial(_repaired, leaf=leaf, schema=schema),
        f"conv {kind}, block long, {', '.join(c + ' long' for c in (*counts, 'numbers', 'low', 'high', 'begins', 'ends'))}, first string, last string, "
        "audit string, out array<struct<turn:long,edit:string,role:string,was:string,key:binary>>"), "repaired")

    # A conversation's blocks, in order, and pairs of neighbours among them.
    parts, size = F.array_sort(F.collect_list(F.struct("block", "first", "last", "begins", "ends", "audit"))), F.size("parts")
    beside = F.arrays_zip(F.slice("parts", F.lit(1), size - 1).alias("x"), F.slice("parts", F.lit(2), size - 1).alias("y"))
    wrong = F.size(F.filter("beside", lambda p: ~F.concat(p["x"]["last"], p["y"]["first"]).isin(*_FITS)))
    twice = F.size(F.filter("beside", lambda p: p["x"]["ends"] == p["y"]["begins"]))
    wide = "decimal(21,0)"
    gaps = F.col("high").cast(wide) - F.col("low").cast(wide) + 1 - F.col("numbers") + twice
    report = (blocks.groupBy("conv").agg(*[F.sum(c).alias(c) for c in (*counts, "numbers")], F.min("low").alias("low"), F.max("high").alias("high"),
                                         parts.alias("parts"))
              .withColumn("beside", beside)
              .select("conv", F.least(F.coalesce(gaps, F.lit(0)), F.lit(2 ** 63 - 1).cast(wide)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
                      (F.col("illegal") + wrong).alias("illegal"), "cost", F.array_join("parts.audit", "").alias("audit"))
              .withColumnRenamed("conv", conv_col))
    kept = blocks.select("conv", "block", F.posexplode("out").alias("place", "of")).select("conv", "block", "place", "of.*")
    texts = rows.withColumn("key", key).groupBy("conv", "role", "key").agg(F.any_value("text").alias("text"))
    whole = (_matched(kept, texts.withColumnRenamed("role", "was"), "left", "was", "key")
             .select(F.col("conv").alias(conv_col), "block", "place", "turn", "edit", "role", F.coalesce("text", F.lit("")).alias("text")))
    return Repair(report, whole)
