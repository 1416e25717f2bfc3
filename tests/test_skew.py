"""One key holding a third of all rows: results stay exact and whole, and
the per-key operators combine map-side (partial aggregate before the
exchange) instead of sending the hot key's rows to one task."""

from pyspark.sql import functions as F

from dwkit.operators.joins import lookup
from dwkit.operators.windows import first_per_key, latest_per_key, top_k_per_group
from dwkit.plans.fixtures import order_lines


def _skewed(spark, n=30000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id").alias("t"), (F.col("id") * 7 % 101).alias("v")).repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_and_first_per_key_on_hot_key(spark):
    df = _skewed(spark)
    lat = latest_per_key(df, "k", "t")
    fst = first_per_key(df, "k", "t")
    got_l = {r.k: r.t for r in lat.collect()}
    got_f = {r.k: r.t for r in fst.collect()}
    assert got_l[0] == 29997 and got_f[0] == 0 and len(got_l) == 998
    for plan in (_plan(lat), _plan(fst)):
        assert "partial_max" in plan or "partial_min" in plan     # map-side combine


def test_order_lines_combines_map_side(spark):
    li = spark.range(3000).select((F.col("id") % 3 == 0).cast("long").alias("l_orderkey"),
                                  F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
                                  F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity"),
                                  F.lit(1.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
                                  F.lit(0.0).alias("l_tax"), F.lit("A").alias("l_returnflag"),
                                  F.lit("O").alias("l_linestatus"),
                                  F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"))
    out = order_lines(li)
    assert "partial_min" in _plan(out) and "partial_sum" in _plan(out)
    rows = {r.l_orderkey: (r.first_partkey, r.carrier_delay) for r in out.collect()}
    assert rows == {1: (0, 1000), 0: (1, 2000)}


def test_top_k_hot_group_exact(spark):
    df = _skewed(spark)
    out = top_k_per_group(df, ["k"], 3, [F.col("v").desc(), F.col("t")])
    hot = [r.t for r in out.where("k = 0").orderBy(F.col("v").desc(), "t").collect()]
    want = sorted([(-(i * 7 % 101), i) for i in range(0, 30000, 3)])[:3]
    assert hot == [t for _, t in want]
    assert out.count() == 998 * 3
    assert "WindowGroupLimit" in _plan(out) and "Partial" in _plan(out)   # per-task limit before the shuffle


def test_lookup_keeps_every_row_of_hot_key(spark):
    df = _skewed(spark)
    ref = spark.range(0, 500).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    m, u = lookup(df.withColumn("k", F.col("k").cast("int")), ref, "k", ["name"])
    assert m.count() + u.count() == 30000
    assert m.where("k = 0").count() == 10000
