import math

from pyspark.sql import functions as F

from dwkit.operators.sampling import random_rows, seeded_hash, stratified_sample


def _half_even(x):
    return int(round(x))   # Python round is half-even


def test_stratified_sample_exact_and_matches_brute_force(spark):
    df = spark.range(0, 2345).withColumn("s", (F.col("id") % 7 == 0).cast("int")).repartition(5)
    out = stratified_sample(df, "s", 0.1, ["id"], seed=42)
    counts = {r.s: r["count"] for r in out.groupBy("s").count().collect()}
    n = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert counts == {k: _half_even(v * 0.1) for k, v in n.items()}
    # brute force: the rows with the smallest seeded hashes per stratum
    hashed = df.withColumn("h", seeded_hash(["id"], 42)).collect()
    want = set()
    for s in n:
        rows = sorted((r for r in hashed if r.s == s), key=lambda r: (r.h, r.id))
        want |= {r.id for r in rows[: _half_even(n[s] * 0.1)]}
    assert {r.id for r in out.collect()} == want


def test_random_rows_repeatable(spark):
    df = spark.range(1000)
    a = [r.id for r in random_rows(df, 10, ["id"], 7).collect()]
    b = [r.id for r in random_rows(df.repartition(3), 10, ["id"], 7).collect()]
    assert a == b and len(set(a)) == 10
    assert not math.isclose(sum(a), sum(range(10)))


def test_random_rows_brute_force(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 4)
    got = [r.id for r in random_rows(df, 7, ["id"], 3).collect()]
    hashed = sorted((r.h, r.id) for r in df.select("id", seeded_hash(["id"], 3).alias("h")).collect())
    assert got == [i for _, i in hashed[:7]]


def test_stratified_sample_edge_cases(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("s"),
        (F.col("id") % 7).alias("dup"), F.col("id"))
    n = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    for frac in (0.1, 1.0, 0.0001):
        out = stratified_sample(df, "s", frac, ["dup"], seed=5)          # 7 distinct keys: big hash ties
        got = {r.s: r["count"] for r in out.groupBy("s").count().collect()}
        want = {k: _half_even(v * frac) for k, v in n.items() if _half_even(v * frac) > 0}
        assert got == want, (frac, got, want)
    full = stratified_sample(df, "s", 1.0, ["id"])
    assert full.count() == 3000 and full.select("id").distinct().count() == 3000
