import random
from collections import Counter

from corpus_helpers import EDGES, docs

from dwkit.llm import decontam as D

VOCAB = [f"w{i}" for i in range(60)]


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def brute(rows, items, k=5, threshold=0.8):
    out = {}
    for d, text in rows:
        ws = D.tokens(text)
        for i, t in items:
            it = D.tokens(t)
            if not it:
                continue
            kk = min(k, len(it))
            want, n = Counter(D.shingles(it, kk)), min(len(it), len(ws))
            for s in range(len(ws) - n + 1):
                sim = D.similarity(Counter(D.shingles(ws[s:s + n], kk)), want)
                if sim >= threshold and sim > out.get((d, i), (0,))[0]:
                    out[d, i] = (sim, s)
    return {(d, i, s, round(sim, 9)) for (d, i), (sim, s) in out.items()}


def corpus(seed=2):
    r = random.Random(seed)
    items = [(i, " ".join(r.choice(VOCAB) for _ in range(r.randint(14, 60)))) for i in range(25)] + [(90, "w1 w2 w3"), (91, None), (92, "")]
    rows = []
    for d in range(80):
        ws = [r.choice(VOCAB) for _ in range(r.randint(0, 150))]
        if d % 2:
            put = r.choice(items[:25])[1].split()
            if d % 4 == 1:
                put[r.choice([0, 1, len(put) - 1])] = "changed"
            if d % 8 == 3:
                put = put[:-1]
            at = r.randint(0, len(ws))
            ws[at:at] = put
        rows.append((d, r.choice([" ", ", ", "\n"]).join(ws).title()))
    return rows, items


def test_brute_force(spark):
    rows, items = corpus()
    for words in (D.PASS_WORDS, 100):       # one pass over the benchmark, and several
        got = D.find(docs(spark, rows), items_frame(spark, items), pass_words=words).collect()
        assert {(r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in got} == brute(rows, items)


def test_tables_return_every_item_within_the_radius():
    import numpy as np
    r = random.Random(1)
    index = D.Index([(i, " ".join(r.choice(VOCAB) for _ in range(30))) for i in range(200)])
    for _ in range(300):
        fp = int(r.choice(index.fps))
        for bit in r.sample(range(64), r.randint(0, 30)):
            fp ^= 1 << bit
        fp = np.uint64(fp)
        assert index.near(fp).tolist() == np.flatnonzero(np.bitwise_count(index.fps ^ fp) <= index.radius).tolist()


def test_edges_and_empty(spark):
    bench = items_frame(spark, [(1, "The quick, brown fox jumps over the lazy dog again!"), (2, None), (None, "one"), (3, ""), (1, "one")])
    got = {(r.doc_id, r.item_id) for r in D.find(docs(spark, EDGES), bench).collect()}
    assert got == {(1, 1), (6, 1), (7, None), (7, 1)}
    kept = D.clean(docs(spark, EDGES), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["2", "3", "4", "None", "5", "8"])
    assert kept.columns == docs(spark, EDGES).columns
    nothing = items_frame(spark, [])
    assert D.find(docs(spark, EDGES), nothing).count() == 0 and D.clean(docs(spark, EDGES), nothing).count() == len(EDGES)
    assert D.find(docs(spark, []), bench).count() == 0
