from pyspark.sql import functions as F
import datetime as dt

from dwkit.operators.joins import assign_fk, lookup, lookup_as_of, map_values, orphans


def test_lookup_one_match_per_key_and_split(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, k string")
    ref = spark.createDataFrame([("a", "x2"), ("a", "x1"), ("b", "y")], "k string, v string")
    m, u = lookup(df, ref, "k", ["v"])
    got = sorted((r.id, r.v) for r in m.collect())
    assert got == [(1, "x1"), (2, "y")]                     # duplicate key: no fan-out, smallest wins
    assert sorted(r.id for r in u.collect()) == [3, 4]      # null key never matches
    assert m.count() + u.count() == df.count()


def test_lookup_padded_key_does_not_match(spark):
    df = spark.createDataFrame([(1, "A  ")], "id int, k string")
    ref = spark.createDataFrame([("A", 1)], "k string, v int")
    m, u = lookup(df, ref, "k", ["v"])
    assert m.count() == 0 and u.count() == 1


def test_assign_fk_null_safe(spark):
    df = spark.createDataFrame([(1, "AA", None), (2, "AA", 5)], "op int, c string, n int")
    dim = spark.createDataFrame([(10, "AA", None), (11, "AA", 5)], "fid int, c string, n int")
    got = sorted((r.op, r.fid) for r in assign_fk(df, dim, ["c", "n"], "fid").collect())
    assert got == [(1, 10), (2, 11)]


def test_lookup_as_of(spark):
    dim = spark.createDataFrame([
        ("AA", "Old", dt.datetime(1900, 1, 1), dt.datetime(2024, 6, 1)),
        ("AA", "New", dt.datetime(2024, 6, 1), dt.datetime(9999, 12, 31))],
        "code string, name string, scd_effective_date timestamp_ntz, scd_expiry_date timestamp_ntz")
    ev = spark.createDataFrame([(1, "AA", dt.date(2024, 5, 31)), (2, "AA", dt.date(2024, 6, 1)),
                                (3, "AA", dt.date(2024, 7, 1))], "id int, code string, d date")
    got = sorted((r.id, r.name) for r in lookup_as_of(ev, dim, "code", "d", ["name"]).collect())
    assert got == [(1, "Old"), (2, "New"), (3, "New")]


def test_orphans_and_map_values(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, p int")
    parent = spark.createDataFrame([(10,)], "p int")
    assert [r.id for r in orphans(child, "p", parent).collect()] == [2]
    ref = spark.createDataFrame([(10, "ten")], "k int, v string")
    got = sorted((r.id, r.label) for r in map_values(child, "p", ref, "k", "v", "label").collect())
    assert got == [(1, "ten"), (2, "Unknown"), (3, "Unknown")]


def test_lookup_flagged_one_frame(spark):
    from dwkit.operators.joins import lookup_flagged
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, k string")
    ref = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    got = sorted((r.id, r.v, r.matched) for r in lookup_flagged(df, ref, "k", ["v"]).collect())
    assert got == [(1, 1, True), (2, None, False), (3, None, False)]


def test_broadcast_only_of_a_bounded_side(spark):
    from dwkit.operators.joins import broadcast_if_small, semi
    small = spark.range(10)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(spark.range(5000).join(broadcast_if_small(small, True), "id"))
    assert broadcast_if_small(small) is small and broadcast_if_small(small, False) is small
    hot = spark.range(1000).select((F.col("id") % 2).alias("k"))
    assert "HashAggregate" in plan(semi(spark.range(5).withColumnRenamed("id", "k"), hot, "k"))
