import random

from pyspark.sql import functions as F

from dwkit.operators.windows import (first_per_key, latest_per_key, parallel_period, share, top_k_per_group,
                                     with_surrogate)


def test_latest_and_first_per_key_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (2, None, "q")],
                               "k int, t int, v string")
    lat = {r.k: (r.t, r.v) for r in latest_per_key(df, "k", "t").collect()}
    fst = {r.k: (r.t, r.v) for r in first_per_key(df, "k", "t").collect()}
    assert lat == {1: (5, "b"), 2: (None, "q")}
    assert fst == {1: (None, "z"), 2: (None, "q")}


def test_surrogate_dense_over_many_partitions(spark):
    vals = list(range(1000))
    random.Random(1).shuffle(vals)
    df = spark.createDataFrame([(v,) for v in vals], "x int").repartition(7)
    out = with_surrogate(df, "sk", ["x"], start=101).collect()
    assert sorted(r.sk for r in out) == list(range(101, 1101))
    assert all(r.sk == r.x + 101 for r in out)


def test_top_k_per_group_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("ab") if i % 3 else "a", rnd.randint(0, 20), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, m int, id int")
    got = sorted((r.g, r.id) for r in top_k_per_group(df, ["g"], 5, [F.col("m").desc(), F.col("id")]).collect())
    want = []
    for g in "ab":
        grp = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))[:5]
        want += [(g, r[2]) for r in grp]
    assert got == sorted(want)


def test_parallel_period_missing_year_is_null(spark):
    df = spark.createDataFrame([(2020, 10), (2021, 15), (2023, 7)], "y int, v int")
    got = {r.y: (r.v_prior, r.v_trend) for r in parallel_period(df, "y", [], "v").collect()}
    assert got == {2020: (None, None), 2021: (10, 5), 2023: (None, None)}


def test_share_global_and_partitioned(spark):
    df = spark.createDataFrame([("x", 1), ("x", 3), ("y", 4)], "p string, m int")
    g = sorted(r.share for r in share(df, "m").collect())
    assert g == [0.125, 0.375, 0.5]
    p = sorted(r.share for r in share(df, "m", ["p"]).collect())
    assert p == [0.25, 0.75, 1.0]


def test_global_rank_equals_window(spark):
    from pyspark.sql import Window
    from dwkit.operators.windows import ranked
    df = spark.createDataFrame([(i, float(i % 7) if i % 11 else None) for i in range(200)], "id int, m double") \
        .repartition(5)
    for ascending in (False, True):
        o = F.col("m").asc_nulls_last() if ascending else F.col("m").desc_nulls_last()
        for dense in (False, True):
            fn = F.dense_rank() if dense else F.rank()
            want = {r.id: r.w for r in df.withColumn("w", fn.over(Window.orderBy(o))).collect()}
            assert {r.id: r["rank"] for r in ranked(df, "m", dense=dense, ascending=ascending).collect()} == want


def test_surrogates_pass_the_32_bit_range(spark):
    out = with_surrogate(spark.range(4), "sk", ["id"], start=2 ** 31 - 2).collect()
    assert sorted(r.sk for r in out) == [2 ** 31 - 2 + i for i in range(4)]
