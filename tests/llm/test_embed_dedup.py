import numpy as np
import pytest
from pyspark.sql import types as T

from dwkit.llm import embed_dedup as E
from dwkit.llm.common import hash_sample

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("cls", T.StringType()), T.StructField("n", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, "c", "n") for i, v, l in rows], SCHEMA)


def brute(rows, dim, threshold=0.93):
    def unit(v):
        if v is None or len(v) != dim or any(x is None or not np.isfinite(np.float32(x)) for x in v) or not any(np.float32(x) for x in v):
            return None
        x = np.array(v, dtype=np.float32).astype(np.float64)
        return x / np.linalg.norm(x)
    units = [unit(v) for _, v, _ in rows]
    near = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] is not None
             and rows[i][2] == rows[j][2] and units[i] @ units[j] >= threshold] for i in range(len(rows))]
    label = [r[0] for r in rows]
    while True:
        new = [min((x for x in (label[i], *(label[j] for j in near[i])) if x is not None), default=None) for i in range(len(rows))]
        if new == label:
            return sorted(((r[0], len(n), c, r[0] == c) for r, n, c in zip(rows, near, label)), key=str)
        label = new


def planted(n=600, dim=64, seed=4):
    r = np.random.default_rng(seed)
    base = r.standard_normal((60, dim))
    rows = []
    for i in range(n):
        v = base[r.integers(60)] + r.choice([0, 0.05, 0.12]) * r.standard_normal(dim)
        rows.append((i, (v * r.choice([1, 7.5])).astype(np.float32).tolist(), int(r.integers(3))))
    return rows


def test_recall_against_brute_force(spark):
    rows = planted()
    got = {r.vec_id: r for r in E.link(frame(spark, rows)).collect()}
    want = {w[0]: w for w in brute(rows, 64)}
    found, true = sum(r.n_links for r in got.values()), sum(w[1] for w in want.values())
    assert all(got[i].n_links <= want[i][1] for i in want)          # no link below the threshold
    assert true > 1000 and found / true >= 0.99
    assert sum(got[i].component_id == want[i][2] for i in want) / len(want) >= 0.99


def test_edges_copies_and_empty(spark):
    v, w = [1.0, 0.0, 2.0, 0.5], [0.0, 1.0, -1.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, v, 2), (4, None, 1), (5, [], 1), (6, [0.0] * 4, 1), (7, [1.0, None, 1.0, 1.0], 1),
            (8, [1.0, float("nan"), 1.0, 1.0], 1), (9, [1.0, float("inf"), 1.0, 1.0], 1), (10, v, None), (11, [1.0, 2.0], 1),
            (None, w, 1), (12, w, 1), (1, v, 1), (13, [2.0, 0.0, 4.0, 1.0], 1), (14, [-0.0, 1.0, -1.0, 3.0], 1)]
    got = sorted((tuple(r) for r in E.link(frame(spark, rows)).collect()), key=str)
    assert [(i, n, c) for i, n, c, _ in got] == [(i, n, c) for i, n, c, _ in brute(rows, 4)]
    assert E.link(frame(spark, [])).count() == 0
    assert E.link(frame(spark, [(1, None, 1)])).collect()[0].kept


def test_codes_are_balanced():
    x = E._unit(np.random.default_rng(0).standard_normal((2000, 64)) + 0.5)
    mean, proj = E.fit_rotation(x, 64)
    on = np.unpackbits(E.encode(x, mean, proj).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").mean(axis=0)
    assert 0.4 < on.min() and on.max() < 0.6


def test_few_distinct_vectors_among_many_copies(spark):
    r = np.random.default_rng(1)
    for kinds in (1, 3):                       # the smallest hash of so few may lie above any cut
        base = r.standard_normal((kinds, 8))
        rows = [(i, base[i % kinds].tolist(), 1) for i in range(3000)]
        got = {x.vec_id: x for x in E.link(frame(spark, rows), sample=2).collect()}
        assert all(got[i].n_links == 3000 // kinds - 1 and got[i].component_id == i % kinds for i in got) and len(got) == 3000


def test_sample_has_its_size_whatever_the_copies(spark):
    df = spark.range(3000).selectExpr("id % 3 AS k")
    assert [hash_sample(df, n, "k").count() for n in (1, 10, 2999, 3000)] == [1, 10, 2999, 3000]


def at_cosine(n, dim, share, seed=6):
    """Pairs at cosine 0.93 to 0.97, among vectors with ``share`` of their squared norm in a common mean."""
    r = np.random.default_rng(seed)
    mean = r.standard_normal(dim)
    base = E._unit(np.sqrt(1 - share) * r.standard_normal((n, dim)) / np.sqrt(dim) + np.sqrt(share) * mean / np.linalg.norm(mean))
    away = r.standard_normal((n, dim))
    away = E._unit(away - (away * base).sum(axis=1, keepdims=True) * base)
    c = r.uniform(0.9301, 0.97, (n, 1))
    return np.concatenate((base, c * base + np.sqrt(1 - c * c) * away))


@pytest.mark.parametrize("share", [0, 0.7])
def test_recall_at_the_threshold_with_and_without_a_common_mean(spark, share):
    x = at_cosine(1500, 64, share)
    rows = [(i, v.tolist(), int(i % 1500 % 2)) for i, v in enumerate(x)]
    u = E._unit(np.array([v for _, v, _ in rows], dtype=np.float32).astype(np.float64))
    label = np.array([l for _, _, l in rows])
    near = (u @ u.T >= 0.93) & (label[:, None] == label)
    want = near.sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in E.link(frame(spark, rows)).collect()}
    assert all(got[i] <= want[i] for i in got) and want.sum() >= 3000
    assert sum(got.values()) / want.sum() >= 0.99


def test_few_vectors_and_those_on_both_sides_of_their_mean(spark):
    r = np.random.default_rng(5)
    c = np.sqrt(1 - 0.94 ** 2)
    rows = [(1, [1.0, 0.0], 1), (2, [0.94, c], 1),                                                  # every centred bit differs
            (3, [1.0, 1.0, 1.0], 1), (4, [2.0, 2.0, 2.0], 1), (5, [3.0, 3.0, 3.0], 1),              # nothing but rounding
            (6, [2.0], 1), (7, [5.0], 1), (8, [-1.0], 1), (9, [3.0], 2)]
    rows += [(100 + i, (np.array([5.0] * 16) + r.standard_normal(16) * 0.3).tolist(), 1) for i in range(60)]   # all within the threshold
    got = {x.vec_id: (x.n_links, x.component_id) for x in E.link(frame(spark, rows)).collect()}
    for dim in (1, 2, 3, 16):
        for i, n, c, _ in brute([x for x in rows if len(x[1]) == dim], dim):
            assert got[i] == (n, c)


@pytest.mark.parametrize("dim, share", [(2, 0), (8, 0), (64, 0.9)])
def test_blocks_reach_the_recall_in_any_geometry(dim, share):
    x = at_cosine(400, dim, share)
    fit = E.fit_tables(x, np.arange(len(x)) % 400 % 2, 0.93, 400)
    a, b = fit.bits(x[:400]), fit.bits(x[400:])
    met = (fit.values(a) == fit.values(b)).any(axis=1) & (np.bitwise_count((E.packed(a) ^ E.packed(b)).view("<u8")) <= fit.radius)
    assert met.mean() >= 0.985


def test_width_grows_with_the_label():
    x = E._unit(np.random.default_rng(0).standard_normal((2000, 64)))
    fits = [E.fit_tables(x, np.zeros(2000), 0.93, n) for n in (1_000, 100_000, 10_000_000)]
    assert fits[0].width < fits[1].width < fits[2].width and fits[2].blocks < 20 * fits[0].blocks
    assert all(n / 2 ** f.width < 10 for n, f in zip((1_000, 100_000, 10_000_000), fits, strict=True))


def test_each_length_links_with_itself(spark):
    r = np.random.default_rng(9)
    of = {32: planted(500, 32), 64: planted(500, 64)}
    rows = [(2000 * k + i, v, l) for k, (dim, some) in enumerate(of.items()) for i, v, l in some]
    rows += [(9000 + i, r.standard_normal(3 + i).tolist(), 1) for i in range(20)]       # malformed rows
    got = {x.vec_id: (x.n_links, x.component_id) for x in E.link(frame(spark, rows)).collect()}
    assert len(got) == len(rows) and all(got[i] == (0, i) for i in range(9000, 9020))
    for k, (dim, some) in enumerate(of.items()):
        want = brute(some, dim)
        assert sum(got[2000 * k + i][0] for i, *_ in want) >= 0.99 * sum(n for _, n, *_ in want) > 500
