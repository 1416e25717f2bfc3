"""Nearest neighbours: brute force, measured recall, copies, edge cases."""

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwkit.llm import neighbours as N
from dwkit.llm import queries

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("point", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("rid", T.LongType()),
                       T.StructField("length", T.IntegerType()), T.StructField("asked", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "p", "s", 1, 2, "a") for i, v in rows], SCHEMA)


def brute(rows, every=100, k=10):
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(np.float32(x) for x in v)
    rows = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows if usable(v)]
    out = []
    for at, (i, v) in enumerate(rows):
        if i is not None and i % every == 0:
            near = sorted(((float(np.sqrt(np.square(v - w).sum())), j is None, j or 0) for b, (j, w) in enumerate(rows) if b != at and len(w) == len(v)))
            out += [(i, r + 1, None if none else j, d) for r, (d, none, j) in enumerate(near[:k])]
    return out


def close(got, want):
    key = lambda r: (r[0], r[1], r[3], str(r[2]))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    return [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def recall(got, want):
    got = {(r[0], r[2]) for r in got}
    return sum((w[0], w[2]) in got for w in want) / len(want)


def test_query_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = queries.op12_nearest_neighbours(spark, SF_SMALL).collect(), brute(rows)
    assert recall(got, want) >= 0.99 and len(got) == len(want)


def near_copies(n, dim, seed=1):
    """A third of the vectors lie about one point, the others anywhere."""
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dim))
    x[::3] = x[0] + 0.05 * r.standard_normal((len(x[::3]), dim))
    return x


@pytest.mark.parametrize("shard_size", [8192, 700])
def test_recall_with_a_dense_third(spark, shard_size):
    rows = list(enumerate(near_copies(3000, 48).tolist()))
    got = N.search(frame(spark, rows), F.col("vec_id") % 20 == 0, shard_size=shard_size, query_block=64).collect()
    want = brute(rows, every=20)
    assert len(got) == len(want) and recall(got, want) >= 0.98
    exact = {(w[0], w[2]): w[3] for w in brute(rows, every=20, k=3000)}
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-12 for r in got)


def test_small_tables_are_exact(spark):
    r = np.random.default_rng(3)
    for n in (1, 2, 7, 30, 90):
        rows = [(i, v.tolist()) for i, v in enumerate(r.integers(-2, 3, (n, 6)))]        # ties, copies, zeros
        for shard_size in (8192, 8):
            assert close(N.search(frame(spark, rows), F.col("vec_id") % 3 == 0, shard_size=shard_size, query_block=4).collect(), brute(rows, every=3))


def test_copies_and_edges(spark):
    v, w, x = [1.0, 0.0, 2.0, 0.5], [0.0, 1.0, -1.0, 3.0], [1.0, 0.5, 2.0, 0.5]
    rows = [*[(i, v) for i in range(-20, 40)], *[(i, x) for i in range(40, 50)], (100, w), (100, w), (None, w), (None, v), (200, None), (300, []),
            (400, [0.0] * 4), (500, [1.0, None, 1.0, 1.0]), (600, [1.0, float("nan"), 1.0, 1.0]), (700, [1.0, float("inf"), 1.0, 1.0]),
            (800, [1.0, 2.0]), (900, [3e38, -3e38, 3e38, 1.0]), (901, [1e-30, 0.0, 0.0, 0.0]), (1000, [-0.0, 1.0, -1.0, 3.0])]
    got = N.search(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert close(got, brute(rows, every=10))
    assert N.search(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert N.search(frame(spark, rows), F.col("vec_id") == 12345).count() == 0
    assert N.search(frame(spark, [(0, v)]), F.col("vec_id") % 10 == 0).count() == 0


def test_every_point_can_be_reached():
    r = np.random.default_rng(8)
    for n, d in ((1, 3), (2, 3), (50, 2), (400, 2), (1500, 8)):
        x = np.concatenate((r.standard_normal((n, d)), 1000 + 0.001 * r.standard_normal((n, d)), -500 + r.standard_normal((n, d))))
        g = N.build(x, degree=4, beam=8)
        reached, front = set(g.starts.tolist()), g.starts.tolist()
        while front:
            front = [q for q in {int(q) for p in front for q in g.edges[p] if q >= 0} if q not in reached]
            reached.update(front)
        assert len(reached) == len(x)


def test_pruning_keeps_diverse_edges():
    x = np.array([[0.0, 0], [1, 0], [1.1, 0], [-1, 0.1], [0, 3]], dtype=np.float32)
    assert N.prune(x, np.array([0]), np.array([[1, 2, 3, 4, 0, 1, -1]]), 4, 1.2).tolist() == [[1, 3, 4, -1]]
    assert N.prune(x, np.array([0]), np.array([[1, 2, 3, 4]]), 2, 1.2).tolist() == [[1, 3]]
