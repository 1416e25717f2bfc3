from pyspark.sql import functions as F

from dwkit.operators.aggregates import component_counts, correlation, rollup_totals, value_counts
from dwkit.operators.quality import (check_padding, check_timeline, count_rule, profile, reconcile, run_checks,
                                     Rule)


def test_profile_edge_columns(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 1, "y"), (None, 1, None)], "a int, b int, c string")
    p = {r.column: r for r in profile(df).collect()}
    assert p["a"].null_count == 3 and p["a"].null_pct == 100.0 and p["a"].unique_values == 0
    assert p["a"].completeness == "0.00%" and p["a"].min is None and p["a"].sample_values == "[]"
    assert p["b"].unique_values == 1 and p["b"].min == "1" and p["b"].sample_values == "[1]"
    assert p["c"].null_pct == 33.33 and p["c"].sample_values == "[x, y]"
    many = spark.createDataFrame([(v,) for v in "gfedcbaabc"], "v string")
    assert profile(many).first().sample_values == "[a, b, c, d, e]"


def test_profile_does_not_expand_wide_rows(spark):
    df = spark.createDataFrame([(1, "x")], "a int, c string")
    plan = profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_run_checks_and_rules(spark):
    df = spark.createDataFrame([(1, 5.0), (0, None), (0, 3.0)], "cancelled int, dep double")
    out = {r.check: (r.value, r.severity) for r in run_checks(df, [
        count_rule("leak", (F.col("cancelled") == 1) & F.col("dep").isNotNull()),
        count_rule("missing", (F.col("cancelled") == 0) & F.col("dep").isNull(), bad="MEDIUM"),
        Rule("max", F.max("dep"), "INFO")]).collect()}
    assert out == {"leak": ("1", "HIGH"), "missing": ("1", "MEDIUM"), "max": ("5.0", "INFO")}


def test_reconcile_balances(spark):
    src = spark.range(10).withColumn("cancelled", (F.col("id") % 3 == 0).cast("int"))
    loaded = src.where("id < 8")
    rej = src.where("id >= 8")
    r = reconcile(src, loaded, rej).first()
    assert r.balanced and r.status_balanced and r.source_rows == 10 and r.rejected_rows == 2


def test_value_counts_null_is_a_value_and_zero_total(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    got = {r.value: (r["count"], r.pct) for r in value_counts(df, "v").collect()}
    assert got == {"a": (2, 66.67), None: (1, 33.33)}
    assert value_counts(df.where("false"), "v").count() == 0


def test_correlation_and_component_counts(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 4.0, 3), (None, 1.0, 0), (3.0, 6.5, 0)],
                               "a double, b double, p int")
    r = correlation(df, "a", "b").first()
    assert r.pairs == 3 and r.correlation > 0.99
    cc = {x.component: (x.non_zero, x.pct) for x in component_counts(df, ["p"]).collect()}
    assert cc == {"p": (1, 25.0)}


def test_timeline_and_padding(spark):
    df = spark.sql("select 1 id, timestamp_ntz'2024-01-02' c, timestamp_ntz'2024-01-01' d, 'A  ' code "
                   "union all select 2, timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-03', 'B'")
    assert [r.id for r in check_timeline(df, "c", "d").collect()] == [1]
    assert [r.id for r in check_padding(df, "code").collect()] == [1]


def test_rollup_total_equals_grand_total(spark):
    df = spark.createDataFrame([(2023, 1, 5), (2023, 2, 7), (2024, 1, 1), (None, 1, 2)], "y int, q int, n int")
    out = rollup_totals(df, ["y", "q"], {"n": F.sum("n")})
    grand = out.where("level = 0").first().n
    assert grand == 15
    assert out.where("level = 1").agg(F.sum("n")).first()[0] == grand
    assert out.where("level = 1 and y is null").count() == 1   # a null member is not a subtotal


def test_check_references_one_scan_per_child(spark):
    from dwkit.operators.quality import check_references
    child = spark.createDataFrame([(1, 10), (2, 99), (None, 10)], "a int, b int")
    pa = spark.createDataFrame([(1,)], "a int")
    pb = spark.createDataFrame([(10,), (10,)], "b int")
    other = spark.createDataFrame([(5,)], "a int")
    out = check_references([("c.a", child, "a", pa, "a"), ("c.b", child, "b", pb, "b"),
                            ("o.a", other, "a", pa, "a")])
    assert [(r.relationship, r.orphans, r.status) for r in out.collect()] == [
        ("c.a", 1, "FAIL"), ("c.b", 1, "FAIL"), ("o.a", 1, "FAIL")]
