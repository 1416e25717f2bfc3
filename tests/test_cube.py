import datetime as dt

from pyspark.sql import functions as F

from dwkit.operators.dims import date_dim
from dwkit.plans.cube import Attribute, CubeModel, Derived, Dimension, Hierarchy, Kpi, Measure, Role, check_dimension


def _cube(spark):
    dates = date_dim(spark, dt.date(2022, 1, 1), dt.date(2024, 12, 31))
    fact = spark.createDataFrame([
        (20220115, 0), (20220210, 1), (20230115, 0), (20230115, 0), (20240601, 1), (20240115, 0)],
        "date_key int, cancelled int")
    dim = Dimension("date", dates, "date_key", (Attribute("year", "year"), Attribute("quarter", "quarter"),
                                                Attribute("month", "month", "month_name")),
                    (Hierarchy("Calendar", ("year", "quarter", "month")),), bounded=True)
    return CubeModel(fact, [Role("date", dim, "date_key")],
                     [Measure("flights", "count"), Measure("cancelled", "sum", "cancelled"),
                      Measure("operated", "count_if", condition=F.col("cancelled") == 0)],
                     [Derived("rate", ("cancelled", "flights"), lambda: F.col("cancelled") / F.col("flights"))],
                     [Kpi("ops", "operated", "flights")])


def test_month_level_keeps_years_apart(spark):
    c = _cube(spark)
    rows = c.query(["date.year", "date.month"], ["flights"]).collect()
    jan = sorted((r.date_year, r.flights) for r in rows if r.date_month_name == "January")
    assert jan == [(2022, 1), (2023, 2), (2024, 1)]


def test_rollup_subtotals_and_ratio_after_aggregation(spark):
    c = _cube(spark)
    out = c.query(["date.year", "date.quarter"], ["flights", "rate"], totals="rollup")
    grand = out.where("grouping_id = 3").first()
    assert grand.flights == 6 and abs(grand.rate - 2 / 6) < 1e-12
    assert out.where("grouping_id = 1").agg(F.sum("flights")).first()[0] == 6


def test_slice_dice_pivot_summary_kpi(spark):
    c = _cube(spark)
    assert c.slice_("date.year", 2023, ["date.month"], ["flights"]).first().flights == 2
    assert c.dice({"date.year": [2022, 2024], "date.quarter": [1]}, ["date.year"], ["flights"]).count() == 2
    p = c.pivot(["date.year"], "date.quarter", "flights", [1, 2]).where("date_year = 2024").first()
    assert (p["1"], p["2"]) == (1, 1)
    assert c.summary(["flights", "rate"]).first().flights == 6
    k = {r.date_year: r for r in c.kpi("ops").collect()}
    assert k[2022].trend is None and k[2023].trend == 1.0 and k[2023].status == 1.0


def test_check_dimension(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (1,)], "k int")
    r = check_dimension(fact, "k", dim, "k").first()
    assert (r.null_keys, r.not_found, r.duplicate_keys) == (1, 1, 1)


def test_months_sort_by_number_not_name(spark):
    c = _cube(spark)
    names = [r.date_month_name for r in c.query(["date.month"], ["flights"], sort=True).collect()]
    assert names == ["January", "February", "June"]


def test_dimension_that_grows_is_joined_after_its_key_is_grouped(spark):
    from dataclasses import replace
    fact = spark.createDataFrame([(i % 5, i % 3, float(i)) for i in range(60)] + [(4, 1, None)], "route_key int, day_key int, delay double")
    routes = spark.createDataFrame([(i, "short" if i < 2 else "long", f"r{i}") for i in range(5)], "route_key int, band string, code string")
    days = spark.createDataFrame([(i, f"d{i}") for i in range(3)], "day_key int, day string")
    route = Dimension("route", routes, "route_key", (Attribute("band", "band"), Attribute("code", "code")), grows=True)
    day = Dimension("day", days, "day_key", (Attribute("day", "day"),), bounded=True)
    measures = [Measure("n", "count"), Measure("sum", "sum", "delay"), Measure("some", "count_nonnull", "delay"),
                Measure("least", "min", "delay"), Measure("most", "max", "delay"), Measure("late", "count_if", condition=F.col("delay") > 30)]
    late = CubeModel(fact, [Role("route", route, "route_key"), Role("day", day, "day_key")], measures)
    first = CubeModel(fact, [Role("route", replace(route, grows=False), "route_key"), Role("day", day, "day_key")], measures)
    names = [m.name for m in measures]
    for rows, totals, filters in ((["route.band", "day.day"], None, None), (["day.day", "route.band"], "cube", None), (["route.code", "route.band"], "rollup", None),
                                  (["route.band"], None, {"day.day": "d1"}), (["route.band"], None, {"route.code": ["r1", "r3"]})):
        a, b = (c.query(rows, names, filters, totals=totals) for c in (late, first))
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    plan = late.query(["route.band"], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate [route_key")
