import random
import re

import xxhash
from corpus_helpers import EDGES, docs

from dwkit.llm import simhash


def brute_print(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    k = min(k, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), seed=42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bound=3):
    prints = [(i, brute_print(t)) for i, t in rows]
    label = [i for i, _ in prints]
    near = [[j for j, (_, q) in enumerate(prints) if (p ^ q).bit_count() <= bound] for _, p in prints]
    while True:
        new = [min((label[j] for j in js if label[j] is not None), default=None) for js in near]
        if new == label:
            return sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, label)), key=str)
        label = new


def some_rows():
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        words = [r.choice(vocab) for _ in range(r.randint(3, 300))]
        rows.append((i, " ".join(words)))
        for j in range(r.randint(0, 3)):
            other = list(words)
            other[r.randrange(len(other))] = "changed"
            rows.append((100 * (i + 1) + j, " ".join(other if j else words)))
    return rows


def test_brute_force(spark):
    rows = some_rows()
    for limit in (simhash.LIMIT, 1):        # one task per subtree, and subtrees opened by Spark
        got = [tuple(r) for r in simhash.near_duplicates(docs(spark, rows), limit=limit).collect()]
        assert sorted(got, key=str) == brute_components(rows)


def test_edges_and_empty(spark):
    got = [tuple(r) for r in simhash.near_duplicates(docs(spark, EDGES)).collect()]
    assert sorted(got, key=str) == brute_components(EDGES)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_one_per_group(spark):
    rows = EDGES + [(i + 10_000, t) for i, t in some_rows()]
    kept = [(r.doc_id, r.text) for r in simhash.one_per_group(docs(spark, rows)).collect()]
    want = {c for _, _, c in brute_components(rows)}
    assert len(kept) == len(want) and {i for i, _ in kept} == want
    assert simhash.one_per_group(docs(spark, rows)).columns == docs(spark, rows).columns
    assert simhash.one_per_group(docs(spark, [])).count() == 0


def test_walk_in_small_pieces(monkeypatch, spark):
    monkeypatch.setattr(simhash, "_FRONTIER", 3)
    monkeypatch.setattr(simhash, "_LEAF", 1)
    import numpy as np
    r = np.random.default_rng(1)
    codes = np.unique(r.integers(0, 1 << 12, 300).astype(np.uint64))
    one = np.array([0]), np.array([len(codes)]), np.array([0]), np.array([len(codes)]), np.array([0])
    got = simhash.walk(codes, one, 63, 1)
    label = np.arange(len(codes))
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 1
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    assert (got == label).all()
