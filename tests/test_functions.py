import datetime as dt

from pyspark.sql import functions as F

from dwkit.functions import band, clean_code, date_key, date_parts, date_names, minutes_between, safe_divide
from dwkit.functions import total_of, any_positive, logical_length


def test_band_edges(spark):
    df = spark.createDataFrame([(499.0,), (500.0,), (1500.0,), (1501.0,), (None,)], "d double")
    got = [r[0] for r in df.select(band("d")).collect()]
    assert got == ["Short", "Medium", "Medium", "Long", None]


def test_clean_code_rules(spark):
    df = spark.createDataFrame([(0, "B"), (1, "A  "), (1, None), (1, " c "), (1, "")], "c int, code string")
    got = [r[0] for r in df.select(clean_code("c", "code")).collect()]
    assert got == ["N/A", "A", "A", "c", "A"]


def test_minutes_between_counts_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:59' a, timestamp_ntz'2024-01-01 00:01:01' b, "
                   "timestamp_ntz'2024-01-01 00:01:00' c")
    r = df.select(minutes_between("a", "b").alias("ab"), minutes_between("b", "a").alias("ba"),
                  minutes_between("b", "c").alias("bc")).first()
    assert (r.ab, r.ba, r.bc) == (1, -1, 0)


def test_date_parts_and_names(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 12, 30),), (dt.date(2024, 12, 29),)],
                               "d date")
    p, n = date_parts("d"), date_names("d")
    rows = df.select(date_key("d").alias("k"), p["week_of_year"].alias("w"), p["day_of_week"].alias("dow"),
                     p["is_weekend"].alias("we"), n["month_year"].alias("my"), n["day_name"].alias("dn"),
                     n["quarter_name"].alias("qn")).collect()
    assert rows[0].k == 20240229 and rows[0].my == "Feb 2024" and rows[0].qn == "Q1"
    assert rows[1].w == 1            # ISO week 1 of 2025 while the calendar year is 2024
    assert rows[2].dow == 1 and rows[2].we and rows[2].dn == "Sunday"   # 1 = Sunday


def test_safe_divide_and_totals(spark):
    df = spark.createDataFrame([(1, 0, None), (3, 2, 5)], "a int, b int, c int")
    r = df.select(safe_divide("a", "b", 0).alias("z"), safe_divide("a", "b").alias("n"),
                  total_of("a", "b", "c").alias("t"), any_positive("b", "c").alias("p")).collect()
    assert r[0].z == 0.0 and r[0].n is None and r[0].t == 1 and r[0].p is False
    assert r[1].z == 1.5 and r[1].t == 10 and r[1].p is True


def test_logical_length_ignores_trailing_blanks(spark):
    df = spark.createDataFrame([("A  ",)], "s string")
    assert df.select(logical_length("s"), F.length("s")).first() == (1, 3)


def test_add_days_and_hours(spark):
    from dwkit.functions import add_days, add_hours
    df = spark.sql("select date'2024-02-28' d, timestamp_ntz'2024-01-01 23:30:00' t")
    r = df.select(add_days("d", 1).alias("a"), add_days("d", 2).alias("b"), add_hours("t", 1.5).alias("c")).first()
    assert (r.a, r.b, r.c) == (dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.datetime(2024, 1, 2, 1, 0))


def test_text_or_null_typed_null_fill_defaults(spark):
    from dwkit.functions import fill_defaults, text_or_null, typed_null
    df = spark.createDataFrame([("nan", None), ("7", 3)], "s string, n int")
    out = fill_defaults(df.select(text_or_null("s").alias("s"), "n", typed_null("int").alias("z")), {"n": 0})
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(None, 0, None), ("7", 3, None)]
    assert dict(out.dtypes)["z"] == "int"


def test_cluster_conf_sizes():
    from dwkit.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1024 ** 3, 8)["spark.sql.shuffle.partitions"] == "24"
