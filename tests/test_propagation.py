import random

import numpy as np
from pyspark.sql import functions as F

from dwkit.operators import propagation as P


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "a string, b string, late long, own long")
    return P.propagate(df, "a", "b", F.col("late"), F.col("own"), **kw)


def brute(rows, damping=P.DAMPING):
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    names = sorted({r[0] for r in rows} | {r[1] for r in rows})
    at = {x: i for i, x in enumerate(names)}
    w, own = np.zeros((len(names),) * 2), np.zeros(len(names))
    for a, b, late, o in rows:
        w[at[a], at[b]] += late or 0
        own[at[a]] += o or 0
    base = own / own.sum() if own.sum() else np.full(len(names), 1 / len(names))
    share = np.divide(w, w.sum(axis=1, keepdims=True), out=np.zeros_like(w), where=w.sum(axis=1, keepdims=True) > 0)
    # The fixed point, solved directly: lost mass begins again.
    stuck = (w.sum(axis=1) == 0).astype(float)
    m = damping * (share.T + np.outer(base, stuck)) + (1 - damping) * np.outer(base, np.ones(len(names)))
    x = np.full(len(names), 1 / len(names))
    for _ in range(2000):
        x = m @ x
    return {n: x[i] for n, i in at.items()}, {(a, b): damping * x[at[a]] * share[at[a], at[b]] for a in names for b in names if w[at[a], at[b]] > 0}


def test_scores_are_the_fixed_point(spark):
    r = random.Random(4)
    names = [f"n{i}" for i in range(12)]
    rows = [(r.choice(names[:9]), r.choice(names), r.choice([0, 5, 50, None]), r.choice([0, 3, 30, None])) for _ in range(80)]
    rows += [("n0", "hub", 1, 1)] * 60 + [("hub", x, 2, 0) for x in names] + [(None, "n1", 9, 9), ("n1", None, 9, 9)]
    got, (scores, flows) = run(spark, rows, tolerance=1e-12), brute(rows)
    have = {x.node: x.score for x in got.scores.collect()}
    assert got.change <= 1e-12 and 5 < got.rounds < 200
    assert have.keys() == scores.keys() and all(abs(have[k] - scores[k]) < 1e-10 for k in have)
    assert abs(sum(have.values()) - 1) < 1e-9
    have = {(x.origin, x.dest): x.flow for x in got.flows.collect()}
    assert have.keys() == flows.keys() and all(abs(have[k] - flows[k]) < 1e-10 for k in have)


def test_rounds_are_bounded_and_edge_cases(spark):
    rows = [("a", "b", 1, 1), ("b", "a", 1, 0), ("b", "c", 1, 0)]
    assert run(spark, rows, max_rounds=3).rounds == 3
    got = run(spark, [("a", "b", 0, 0), ("c", "c", 0, 0)])                     # no minutes at all: the same everywhere
    assert {x.node: round(x.score, 9) for x in got.scores.collect()} == dict.fromkeys("abc", round(1 / 3, 9)) and got.flows.count() == 0
    empty = run(spark, [])
    assert empty.rounds == 0 and empty.scores.count() == 0 and empty.flows.count() == 0
