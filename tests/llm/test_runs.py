"""Periodic runs: brute force over all stretches and periods, planted loops, edge cases."""

import hashlib
import random
import time
import zlib

import pytest
from conftest import SF_SMALL
from corpus_helpers import EDGES, docs
from pyspark.sql import functions as F

from dwkit.llm import queries, runs


def brute(w, min_length=6, repeats=4):
    """Every lag's maximal stretches of matches, kept if no smaller lag holds on the whole stretch."""
    n, out = len(w), []
    for q in range(1, n):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            e = i
            while e < n and w[e] == w[e - q]:
                e += 1
            s = i - q
            if e - s >= max(min_length, repeats * q) and not any(
                    all(w[x] == w[x - p] for x in range(s + p, e)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = e
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(w, found):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + l for s, l, q in found)]


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_every_run_of_random_words(letters):
    r = random.Random(letters)
    some = 0
    for _ in range(400):
        w = []
        while len(w) < r.randint(0, 60):
            part = [r.choice("abcdefgh"[:letters]) for _ in range(r.randint(1, 7))]
            w += part * r.choice([1, 1, 2, 4, 5, 9]) + part[:r.randint(0, len(part))]
        found = runs.runs_of(w)
        assert found == brute(w), w
        assert runs.collapse(w, found) == brute_collapse(w, found)
        some += len(found)
    assert some > 50


@pytest.mark.parametrize("bounds", [(1, 2), (2, 2), (6, 2), (9, 3), (3, 5)])
def test_other_bounds(bounds):
    r = random.Random(3)
    for _ in range(200):
        w = [r.choice("ab") for _ in range(r.randint(0, 40))]
        assert runs.runs_of(w, *bounds) == brute(w, *bounds)


def test_long_texts_take_time_in_proportion():
    for w, want in ([["x"] * 200_000, [(0, 200_000, 1)]],
                    [[f"w{i % 700}" for i in range(200_000)], [(0, 200_000, 700)]],
                    [[f"w{i}" for i in range(200_000)], []],
                    [[f"w{i * i % 40_009 % 500}" for i in range(100_000)], None]):
        began = time.perf_counter()
        found = runs.runs_of(w)
        assert time.perf_counter() - began < 20
        assert want is None or found == want


def words(text):
    return "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ")


def expected(doc_id, text):
    w = [x for x in words(text) if x]
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs.runs_of(w) if len(w) > 3000 else brute(w)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(brute_collapse(w, found))))


def test_query_on_a_whole_table(spark):
    got = queries.op13_periodic_runs(spark, SF_SMALL)
    want = [expected(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[1] for r in want) > 10


def test_edges(spark, tmp_path):
    loop = "to be or not " * 5
    rows = [*EDGES, (20, "ha " * 9), (21, "ha " * 9), (22, loop), (23, loop + loop.upper()), (24, "a b a b a b a b c a b a b a b a b"),
            (None, loop), (25, "aaaaaa"), (26, "x x x x x x x x x x x x")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    found = {r.doc_id: r for r in runs.find(docs(spark, rows)).where("doc_id > 19").collect()}
    assert found[22].collapsed == "to be or not" and [tuple(r) for r in found[22].runs] == [(0, 20, 4)]
    assert runs.find(docs(spark, [(1, None)])).select("n_words", "collapsed", F.size("runs")).first() == (0, None, 0)
    assert runs.find(docs(spark, [])).count() == 0
