"""Registered queries: one per operator of the inventory, each with the
DuckDB oracle that recomputes it from the raw tables.

Every query reads the driver's tables (directly, or through the warehouse
that ``plans.warehouse.build`` derives from them) over their whole extent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.plans import catalog_sql as S
from dwkit.plans import reports as R
from dwkit.plans.flight_cube import flight_cube
from dwkit.plans.warehouse import build

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def q(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def cube(spark: SparkSession, sf: str):
    return flight_cube(build(spark, sf))


# ---------------------------------------------------------------------------
# Reports (RPT-*)
# ---------------------------------------------------------------------------

@q("rpt_8_on_time_rate_by_region_quarter", S.with_fact(f"""
SELECT origin_region AS region, CAST(year AS INTEGER) AS year, CAST(quarter AS INTEGER) AS quarter,
       {S.headline_sql()}
FROM fact GROUP BY 1, 2, 3"""))
def rpt_8(spark, sf):
    c = cube(spark, sf)
    f = c.frame(["origin.region", "date.year", "date.quarter"])
    out = f.groupBy(F.col("origin_region").alias("region"), F.col("date_year").cast("int").alias("year"),
                    F.col("date_quarter").cast("int").alias("quarter")).agg(*R.headline())
    return out


@q("rpt_7_total_flights", S.with_fact("SELECT count(*) AS total_flights FROM fact"))
def rpt_7(spark, sf):
    return R.total_flights(build(spark, sf)["fact"])


@q("rpt_9_cancellation_rate_by_carrier", S.with_fact(f"""
SELECT carrier_name, count(*) AS flights, CAST(sum(cancelled) AS BIGINT) AS cancelled,
       {S.rate('sum(cancelled)', 'count(*)')} AS cancellation_rate
FROM fact GROUP BY 1"""))
def rpt_9(spark, sf):
    f = cube(spark, sf).frame(["airline.carrier_name"])
    return f.groupBy(F.col("airline_carrier_name").alias("carrier_name")).agg(
        R.n_flights().alias("flights"), R.n_cancelled().alias("cancelled"),
        R.cancellation_rate().alias("cancellation_rate"))


@q("rpt_10_avg_arrival_delay_by_month", S.with_fact("""
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
       round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay
FROM fact GROUP BY 1, 2"""))
def rpt_10(spark, sf):
    f = cube(spark, sf).frame(["date.year", "date.month"])
    return f.groupBy(F.col("date_year").cast("int").alias("year"), F.col("date_month").cast("int").alias("month")) \
        .agg(R.avg_arrival_delay().alias("avg_arr_delay"))


@q("rpt_1_otp_matrix", S.with_fact(f"""
SELECT origin_region AS region, carrier_name, CAST(quarter AS INTEGER) AS quarter,
       CAST({S.OPERATED} AS BIGINT) AS operated, CAST({S.ON_TIME} AS BIGINT) AS on_time,
       CAST(GROUPING(origin_region, carrier_name, quarter) AS BIGINT) AS grouping_id,
       {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate,
       CASE WHEN {S.rate(S.ON_TIME, S.OPERATED)} < 60 THEN 'red'
            WHEN {S.rate(S.ON_TIME, S.OPERATED)} <= 80 THEN 'amber' ELSE 'green' END AS colour
FROM fact GROUP BY CUBE (origin_region, carrier_name, quarter)"""))
def rpt_1(spark, sf):
    f = cube(spark, sf).frame(["origin.region", "airline.carrier_name", "date.quarter"])
    f = f.select(F.col("origin_region").alias("region"), F.col("airline_carrier_name").alias("carrier_name"),
                 F.col("date_quarter").cast("int").alias("quarter"), "cancelled", "arr_delay")
    out = R.otp_matrix(f, ["region", "carrier_name"], "quarter")
    return out.withColumn("grouping_id", F.col("grouping_id").cast("long"))


@q("rpt_2_cascading_members", S.with_ctes("", """
SELECT DISTINCT state_name FROM (
  SELECT origin AS state_name FROM fact UNION ALL SELECT dest FROM fact) x
WHERE state_name IN (SELECT state_name FROM regions WHERE region = 'ASIA')"""))
def rpt_2(spark, sf):
    c = cube(spark, sf)
    return c.members("origin.state", {"origin.region": "ASIA"}).withColumnRenamed("origin_state", "state_name")


_CAUSES = " UNION ALL ".join(
    f"SELECT '{p}' AS cause, CAST(sum({p}) AS BIGINT) AS minutes FROM fact" for p in S.PARTS)


@q("rpt_3_cause_share", S.with_ctes(f", causes AS ({_CAUSES})", """
SELECT cause, minutes, round(CAST(minutes AS DOUBLE) / (SELECT sum(minutes) FROM causes), 4) AS share
FROM causes"""))
def rpt_3(spark, sf):
    return R.cause_breakdown(build(spark, sf)["fact"])


@q("rpt_5_carrier_scorecard", S.with_fact(f"""
SELECT *, rank() OVER (ORDER BY on_time_rate DESC NULLS LAST) AS rank FROM (
  SELECT carrier_name, {S.headline_sql()} FROM fact GROUP BY 1) t"""))
def rpt_5(spark, sf):
    f = cube(spark, sf).frame(["airline.carrier_name"]).withColumnRenamed("airline_carrier_name", "carrier_name")
    return R.carrier_scorecard(f, "carrier_name").withColumn("rank", F.col("rank").cast("long"))


@q("rpt_6_top_routes_per_carrier", S.with_fact("""
SELECT carrier_name, flight_number, origin, dest, avg_arr_delay, flights, route_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY carrier_name ORDER BY avg_arr_delay DESC NULLS LAST,
         flight_number, origin, dest) AS route_rank
  FROM (SELECT carrier_name, flight_number, origin, dest,
               round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay, count(*) AS flights
        FROM fact GROUP BY 1, 2, 3, 4) a) b
WHERE route_rank <= 10"""))
def rpt_6(spark, sf):
    out = R.top_routes_of_cube(cube(spark, sf), "airline.carrier_name", 10)
    return out.withColumn("route_rank", F.col("route_rank").cast("long"))


@q("rpt_6_gauge_by_carrier", S.with_fact(f"""
SELECT carrier_name, {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate, CAST(85.0 AS DOUBLE) AS target,
       round({S.rate(S.ON_TIME, S.OPERATED)} - 85.0, 4) AS gap
FROM fact GROUP BY 1"""))
def rpt_6_gauge(spark, sf):
    f = cube(spark, sf).frame(["airline.carrier_name"]).withColumnRenamed("airline_carrier_name", "carrier_name")
    return R.gauge(f, 85.0, ["carrier_name"])


_DOM = "greatest(" + ", ".join(f"s_{p}" for p in S.PARTS) + ")"
_PICK = "CASE " + " ".join(f"WHEN s_{p} = {_DOM} THEN '{p}'" for p in S.PARTS) + " END"


@q("rpt_11_dominant_cause_by_region_quarter", S.with_fact(f"""
SELECT region, quarter, {_PICK} AS dominant_cause, {_DOM} AS minutes FROM (
  SELECT origin_region AS region, CAST(quarter AS INTEGER) AS quarter,
         {", ".join(f"CAST(sum({p}) AS BIGINT) AS s_{p}" for p in S.PARTS)}
  FROM fact GROUP BY 1, 2) t"""))
def rpt_11_cause(spark, sf):
    f = cube(spark, sf).frame(["origin.region", "date.quarter"])
    f = f.withColumn("region", F.col("origin_region")).withColumn("quarter", F.col("date_quarter").cast("int"))
    return R.dominant_cause(f, ["region", "quarter"])


@q("rpt_11_cancel_rate_by_region_carrier", S.with_fact(f"""
SELECT origin_region AS region, carrier_name, count(*) AS flights,
       {S.rate('sum(cancelled)', 'count(*)')} AS cancellation_rate
FROM fact GROUP BY 1, 2"""))
def rpt_11_cancel(spark, sf):
    f = cube(spark, sf).frame(["origin.region", "airline.carrier_name"])
    return f.groupBy(F.col("origin_region").alias("region"), F.col("airline_carrier_name").alias("carrier_name")) \
        .agg(R.n_flights().alias("flights"), R.cancellation_rate().alias("cancellation_rate"))


# ---------------------------------------------------------------------------
# OLAP operations over the cube (OLAP-*, AGG-16, AGG-17)
# ---------------------------------------------------------------------------

_QN = "'Q' || CAST(quarter AS VARCHAR)"


@q("olap_4_roll_up_calendar_quarter", S.with_fact(f"""
SELECT year AS date_year, quarter AS date_quarter, max({_QN}) AS date_quarter_name, count(*) AS flights,
       CAST(sum(cancelled) AS BIGINT) AS cancelled, CAST({S.ON_TIME} AS BIGINT) AS on_time,
       CAST({S.OPERATED} AS BIGINT) AS operated, {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate
FROM fact GROUP BY 1, 2"""))
def olap_4(spark, sf):
    return cube(spark, sf).roll_up("date", "Calendar", "quarter", ["flights", "cancelled", "on_time_rate"])


@q("olap_5_drill_down_quarter_to_month", S.with_fact(f"""
SELECT origin_region, year AS date_year, quarter AS date_quarter, max({_QN}) AS date_quarter_name,
       month AS date_month, max(monthname(fl_date)) AS date_month_name, count(*) AS flights,
       CAST({S.ON_TIME} AS BIGINT) AS on_time, CAST({S.OPERATED} AS BIGINT) AS operated,
       {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate
FROM fact WHERE year = 1997 GROUP BY 1, 2, 3, 5"""))
def olap_5(spark, sf):
    return cube(spark, sf).drill_down("date", "Calendar", "quarter", ["flights", "on_time_rate"],
                                      member={"date.year": 1997}, across=["origin.region"])


@q("olap_6_slice_carrier", S.with_fact(f"""
SELECT year AS date_year, count(*) AS flights, CAST(sum(cancelled) AS BIGINT) AS cancelled,
       {S.rate('sum(cancelled)', 'count(*)')} AS cancellation_rate
FROM fact WHERE carrier_code = 'BUILDING' GROUP BY 1"""))
def olap_6(spark, sf):
    return cube(spark, sf).slice_("airline.carrier", "BUILDING", ["date.year"], ["flights", "cancellation_rate"])


@q("olap_7_dice_carrier_quarter_band", S.with_fact(f"""
SELECT carrier_code AS airline_carrier, max(carrier_name) AS airline_carrier_name, quarter AS date_quarter,
       max({_QN}) AS date_quarter_name, distance_band AS route_distance_band, count(*) AS flights,
       CAST({S.ON_TIME} AS BIGINT) AS on_time, CAST({S.OPERATED} AS BIGINT) AS operated,
       {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate
FROM fact WHERE carrier_code IN ('BUILDING', 'MACHINERY') AND quarter IN (1, 2)
  AND distance_band IN ('Short', 'Medium')
GROUP BY 1, 3, 5"""))
def olap_7(spark, sf):
    return cube(spark, sf).dice({"airline.carrier": ["BUILDING", "MACHINERY"], "date.quarter": [1, 2],
                                 "route.distance_band": ["Short", "Medium"]},
                                ["airline.carrier", "date.quarter", "route.distance_band"],
                                ["flights", "on_time_rate"])


@q("olap_8_pivot_carrier_by_quarter", S.with_fact("""
SELECT carrier_name AS airline_carrier_name,
       count(*) FILTER (WHERE quarter = 1) AS "1", count(*) FILTER (WHERE quarter = 2) AS "2",
       count(*) FILTER (WHERE quarter = 3) AS "3", count(*) FILTER (WHERE quarter = 4) AS "4"
FROM fact GROUP BY 1"""))
def olap_8(spark, sf):
    return cube(spark, sf).pivot(["airline.carrier_name"], "date.quarter", "flights", [1, 2, 3, 4])


@q("olap_9_summary", S.with_fact(f"""
SELECT count(*) AS flights, CAST(sum(cancelled) AS BIGINT) AS cancelled, CAST({S.ON_TIME} AS BIGINT) AS on_time,
       CAST({S.OPERATED} AS BIGINT) AS operated, {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate,
       {S.rate('sum(cancelled)', 'count(*)')} AS cancellation_rate,
       sum(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated,
       count(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated_n,
       round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay,
       sum(distance) AS distance, CAST(sum(total_delay_minutes) AS BIGINT) AS total_delay_minutes,
       sum(process_hours) AS txn_process_time_hours, count(complete_time) AS completed,
       round(sum(process_hours) / count(complete_time), 4) AS avg_process_hours
FROM fact"""))
def olap_9(spark, sf):
    return cube(spark, sf).summary(["flights", "cancelled", "on_time_rate", "cancellation_rate", "avg_arr_delay",
                                    "distance", "total_delay_minutes", "avg_process_hours"])


@q("olap_10_kpi_completion", S.with_fact("""
SELECT y.date_year, y.value, y.goal, round(y.value / nullif(y.goal, 0), 4) AS status,
       round(y.value - p.value, 4) AS trend
FROM (SELECT year AS date_year, CAST(sum(1 - cancelled) AS DOUBLE) AS value, CAST(count(*) AS DOUBLE) AS goal
      FROM fact GROUP BY 1) y
LEFT JOIN (SELECT year AS date_year, CAST(sum(1 - cancelled) AS DOUBLE) AS value FROM fact GROUP BY 1) p
  ON p.date_year = y.date_year - 1"""))
def olap_10(spark, sf):
    return cube(spark, sf).kpi("On-Time Performance Rate")


@q("olap_12_month_attribute", S.with_fact("""
SELECT month AS date_month, max(monthname(fl_date)) AS date_month_name, count(*) AS flights
FROM fact GROUP BY 1"""))
def olap_12(spark, sf):
    return cube(spark, sf).query(["date.month"], ["flights"])


@q("olap_13_members_states_in_region", S.with_ctes("", """
SELECT DISTINCT f.origin AS origin_state FROM fact f WHERE f.origin_region = 'EUROPE'
UNION SELECT DISTINCT f.dest FROM fact f WHERE f.dest_region = 'EUROPE'"""))
def olap_13(spark, sf):
    return cube(spark, sf).members("origin.state", {"origin.region": "EUROPE"})


@q("agg_16_rollup_calendar", S.with_fact(f"""
SELECT year AS date_year, quarter AS date_quarter,
       CASE WHEN GROUPING(quarter) = 1 THEN NULL ELSE max({_QN}) END AS date_quarter_name,
       month AS date_month,
       CASE WHEN GROUPING(month) = 1 THEN NULL ELSE max(monthname(fl_date)) END AS date_month_name,
       count(*) AS flights, CAST({S.ON_TIME} AS BIGINT) AS on_time, CAST({S.OPERATED} AS BIGINT) AS operated,
       {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate,
       CAST(GROUPING(year, quarter, month) AS BIGINT) AS grouping_id
FROM fact GROUP BY ROLLUP (year, quarter, month)"""))
def agg_16(spark, sf):
    out = cube(spark, sf).query(["date.year", "date.quarter", "date.month"], ["flights", "on_time_rate"],
                                totals="rollup")
    return out.withColumn("grouping_id", F.col("grouping_id").cast("long"))


@q("agg_17_cube_carrier_band", S.with_fact("""
SELECT carrier_name AS airline_carrier_name, distance_band AS route_distance_band, count(*) AS flights,
       CAST(sum(cancelled) AS BIGINT) AS cancelled,
       CAST(GROUPING(carrier_name, distance_band) AS BIGINT) AS grouping_id
FROM fact GROUP BY CUBE (carrier_name, distance_band)"""))
def agg_17(spark, sf):
    out = cube(spark, sf).query(["airline.carrier_name", "route.distance_band"], ["flights", "cancelled"],
                                totals="cube")
    return out.withColumn("grouping_id", F.col("grouping_id").cast("long"))


# ---------------------------------------------------------------------------
# Aggregations over the flat table and entities (AGG-*, DQ-3)
# ---------------------------------------------------------------------------

from dwkit.operators import aggregates as A  # noqa: E402
from dwkit.operators import windows as W  # noqa: E402
from dwkit.operators import sampling as SM  # noqa: E402
from dwkit.plans import fixtures as FX  # noqa: E402


def flat(spark, sf):
    return build(spark, sf)["flat"]


@q("agg_2_status_counts_by_year", S.with_fact("""
SELECT CAST(year(fl_date) AS SMALLINT) AS year, CAST(sum(1 - cancelled) AS BIGINT) AS operated,
       CAST(sum(cancelled) AS BIGINT) AS cancelled, count(*) AS total
FROM flat GROUP BY 1"""))
def agg_2(spark, sf):
    return A.status_counts(flat(spark, sf), "cancelled", ["year"])


@q("agg_3_arr_delay_stats_by_carrier", S.with_fact("""
SELECT carrier_code AS op_unique_carrier, count(arr_delay) AS n, min(arr_delay) AS min_value,
       max(arr_delay) AS max_value, round(avg(arr_delay), 2) AS avg_value
FROM flat GROUP BY 1"""))
def agg_3(spark, sf):
    return A.measure_stats(flat(spark, sf), "arr_delay", ["op_unique_carrier"])


@q("agg_4_count_distinct", S.with_fact("""
SELECT count(DISTINCT carrier_code) AS distinct_op_unique_carrier, count(DISTINCT origin) AS distinct_origin,
       count(DISTINCT dest) AS distinct_dest, count(DISTINCT flight_number) AS distinct_op_carrier_fl_num
FROM flat"""))
def agg_4(spark, sf):
    return A.distinct_count(flat(spark, sf), ["op_unique_carrier", "origin", "dest", "op_carrier_fl_num"])


@q("agg_5_process_hours_by_region_status", S.with_fact("""
SELECT origin_region AS region, cancelled, count(*) AS completed,
       CAST(CAST(avg(process_hours) AS DECIMAL(10,2)) AS DOUBLE) AS avg_hours,
       CAST(CAST(min(process_hours) AS DECIMAL(10,2)) AS DOUBLE) AS min_hours,
       CAST(CAST(max(process_hours) AS DECIMAL(10,2)) AS DOUBLE) AS max_hours
FROM fact WHERE process_hours IS NOT NULL GROUP BY 1, 2"""))
def agg_5(spark, sf):
    f = cube(spark, sf).frame(["origin.region"]).withColumnRenamed("origin_region", "region")
    out = A.process_time_by(f.withColumn("cancelled", F.col("cancelled").cast("int")), ["region", "cancelled"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("avg_hours", "min_hours", "max_hours")})


@q("agg_6_duplicate_line_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def agg_6(spark, sf):
    return A.duplicate_keys(FX.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@q("agg_7_group_by_delay_bucket", S.with_fact("""
SELECT CAST(floor(arr_delay / 100) * 100 AS BIGINT) AS delay_bucket, count(*) AS flights
FROM flat GROUP BY 1"""))
def agg_7(spark, sf):
    bucket = (F.floor(F.col("arr_delay") / 100) * 100).cast("long").alias("delay_bucket")
    return A.grouped(flat(spark, sf), [bucket], {"flights": F.count(F.lit(1))})


@q("agg_8_distinct_carrier_origin", S.with_fact("SELECT DISTINCT carrier_code AS op_unique_carrier, origin FROM flat"))
def agg_8(spark, sf):
    from dwkit.operators.sets import dedup
    return dedup(flat(spark, sf).select("op_unique_carrier", "origin"))


@q("agg_9_first_line_per_order", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) t
WHERE rn = 1""")
def agg_9(spark, sf):
    return W.first_per_key(FX.table(spark, sf, "lineitem"), "l_orderkey", FX.LINE_ORDER)


@q("agg_10_value_counts_cancellation_code", S.with_fact("""
SELECT cancellation_code AS value, count(*) AS count,
       round_even(count(*) * 100.0 / (SELECT count(*) FROM flat), 2) AS pct
FROM flat GROUP BY 1"""))
def agg_10(spark, sf):
    return A.value_counts(flat(spark, sf), "cancellation_code")


@q("agg_11_correlation_dep_arr", S.with_fact("""
SELECT round(corr(dep_delay, arr_delay), 4) AS correlation, count(*) AS pairs
FROM flat WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL"""))
def agg_11(spark, sf):
    return A.correlation(flat(spark, sf), "dep_delay", "arr_delay")


@q("agg_12_completion_status", S.with_fact("""
SELECT count(*) AS total_rows, count(complete_time) AS completed, count(*) - count(complete_time) AS pending,
       count(process_hours) AS with_hours,
       CAST(CAST(count(complete_time) * 100.0 / count(*) AS DECIMAL(5,2)) AS DOUBLE) AS pct_complete
FROM fact"""))
def agg_12(spark, sf):
    out = A.completion_status(build(spark, sf)["fact"])
    return out.withColumn("pct_complete", F.col("pct_complete").cast("double"))


_DELAY_RECORDS = """
, delays AS (SELECT * FROM flat WHERE cancelled = 0 AND greatest(carrier_delay, weather_delay, nas_delay,
             security_delay, late_aircraft_delay, 0) > 0)"""


@q("agg_15_component_counts", S.with_ctes(_DELAY_RECORDS, " UNION ALL ".join(
    f"""SELECT '{p}' AS component, CAST(sum(CASE WHEN {p} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_zero,
       round_even(sum(CASE WHEN {p} > 0 THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS pct FROM delays"""
    for p in S.PARTS)))
def agg_15(spark, sf):
    return A.component_counts(build(spark, sf)["delay_record"], list(S.PARTS))


_PV = [("op_unique_carrier", "carrier_code"), ("cancellation_code", "cancellation_code"), ("origin", "origin"),
       ("dest", "dest"), ("origin_state_nm", "origin"), ("dest_state_nm", "dest"),
       ("day_of_week", "dayofweek(fl_date) + 1"), ("month", "month(fl_date)")]


@q("dq_3_profile_values", S.with_fact(" UNION ALL ".join(
    f"""SELECT '{c}' AS column, CAST({e} AS VARCHAR) AS value, count(*) AS count,
       round_even(count(*) * 100.0 / (SELECT count(*) FROM flat), 2) AS pct FROM flat GROUP BY 2"""
    for c, e in _PV)))
def dq_3(spark, sf):
    return A.profile_values(flat(spark, sf), [c for c, _ in _PV])


# ---------------------------------------------------------------------------
# Windows, sorting, sampling (WIN-*, SORT-*, SAMP-1)
# ---------------------------------------------------------------------------

_FEED = """
, feed AS (
  SELECT l_orderkey AS operation_id, CAST(l_shipdate AS TIMESTAMP) AS accm_txn_complete_time FROM lineitem
  UNION ALL
  SELECT (SELECT max(o_orderkey) FROM orders) + i, TIMESTAMP '2002-01-01 00:00:00' FROM range(1, 501) r(i))"""


@q("win_1_latest_completion_per_id", S.with_ctes(_FEED, """
SELECT operation_id, accm_txn_complete_time FROM (
  SELECT *, row_number() OVER (PARTITION BY operation_id ORDER BY accm_txn_complete_time DESC NULLS LAST) AS rn
  FROM feed) t WHERE rn = 1"""))
def win_1(spark, sf):
    from dwkit.operators.snapshot import latest_completion
    return latest_completion(FX.completion_feed(spark, sf))


_FLIGHTS = """
, flights AS (
  SELECT row_number() OVER (ORDER BY carrier_code NULLS FIRST, flight_number NULLS FIRST, origin NULLS FIRST,
         dest NULLS FIRST) AS flight_id, carrier_code, flight_number, origin AS origin_code, dest AS dest_code,
         min(distance) AS distance
  FROM flat GROUP BY carrier_code, flight_number, origin, dest)"""


@q("win_2_surrogate_flight_ids", S.with_ctes(_FLIGHTS, "SELECT CAST(flight_id AS BIGINT) AS flight_id, "
                                             "carrier_code, flight_number, origin_code, dest_code, distance FROM flights"))
def win_2(spark, sf):
    return build(spark, sf)["flight"]


@q("win_3_parallel_period_carrier_year", S.with_ctes("""
, by_year AS (SELECT carrier_name, CAST(year AS INTEGER) AS year, count(*) AS flights FROM fact GROUP BY 1, 2)""", """
SELECT a.carrier_name, a.year, a.flights, b.flights AS flights_prior, a.flights - b.flights AS flights_trend
FROM by_year a LEFT JOIN by_year b ON b.carrier_name = a.carrier_name AND b.year = a.year - 1"""))
def win_3(spark, sf):
    f = cube(spark, sf).frame(["airline.carrier_name", "date.year"])
    agg = f.groupBy(F.col("airline_carrier_name").alias("carrier_name"),
                    F.col("date_year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("flights"))
    return W.parallel_period(agg, "year", ["carrier_name"], "flights")


@q("win_4_carrier_share_within_region", S.with_fact("""
SELECT origin_region AS region, carrier_name, count(*) AS flights,
       round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY origin_region), 4) AS share
FROM fact GROUP BY 1, 2"""))
def win_4(spark, sf):
    f = cube(spark, sf).frame(["origin.region", "airline.carrier_name"])
    agg = f.groupBy(F.col("origin_region").alias("region"), F.col("airline_carrier_name").alias("carrier_name")) \
        .agg(F.count(F.lit(1)).alias("flights"))
    return W.share(agg, "flights", ["region"]).withColumn("share", F.round("share", 4))


@q("win_5_carrier_rank_within_region", S.with_fact("""
SELECT origin_region AS region, carrier_name, count(*) AS flights,
       dense_rank() OVER (PARTITION BY origin_region ORDER BY count(*) DESC) AS rank
FROM fact GROUP BY 1, 2"""))
def win_5(spark, sf):
    f = cube(spark, sf).frame(["origin.region", "airline.carrier_name"])
    agg = f.groupBy(F.col("origin_region").alias("region"), F.col("airline_carrier_name").alias("carrier_name")) \
        .agg(F.count(F.lit(1)).alias("flights"))
    return W.ranked(agg, "flights", ["region"], dense=True).withColumn("rank", F.col("rank").cast("long"))


@q("sort_2_top_10_arrival_delay", S.with_fact("""
SELECT operation_id, carrier_code AS op_unique_carrier, arr_delay FROM flat
ORDER BY arr_delay DESC NULLS LAST, operation_id LIMIT 10"""))
def sort_2(spark, sf):
    f = flat(spark, sf).select("operation_id", "op_unique_carrier", "arr_delay")
    return SM.top_n(f, 10, [F.col("arr_delay").desc_nulls_last(), F.col("operation_id")])


@q("sort_4_random_rows", S.with_fact("""
SELECT operation_id, carrier_code AS op_unique_carrier FROM flat
ORDER BY md5('42|' || CAST(operation_id AS VARCHAR)), operation_id LIMIT 100"""))
def sort_4(spark, sf):
    """Repeatable random 100 operations (seeded hash)."""
    return SM.random_rows(flat(spark, sf).select("operation_id", "op_unique_carrier"), 100, ["operation_id"], 42)


@q("samp_1_stratified_sample_counts", S.with_fact("""
SELECT CAST(cancelled AS TINYINT) AS cancelled, CAST(round_even(count(*) * 0.1, 0) AS BIGINT) AS sampled
FROM flat GROUP BY 1"""))
def samp_1_counts(spark, sf):
    s = SM.stratified_sample(flat(spark, sf), "cancelled", 0.1, ["operation_id"], 42)
    return s.groupBy("cancelled").agg(F.count(F.lit(1)).alias("sampled"))


@q("samp_1_stratified_sample", S.with_fact("""
SELECT operation_id, CAST(cancelled AS TINYINT) AS cancelled FROM (
  SELECT operation_id, cancelled,
         row_number() OVER (PARTITION BY cancelled ORDER BY md5('42|' || CAST(operation_id AS VARCHAR)), operation_id) AS rn,
         count(*) OVER (PARTITION BY cancelled) AS n FROM flat) x
WHERE rn <= round_even(n * 0.1, 0)"""))
def samp_1(spark, sf):
    """Exact 10 % per cancelled stratum: the rows of the smallest seeded hashes."""
    return SM.stratified_sample(flat(spark, sf).select("operation_id", "cancelled"), "cancelled", 0.1, ["operation_id"], 42)


# ---------------------------------------------------------------------------
# Warehouse tables: normalisation, dimensions, fact load (NORM-*, DIM-*, JOIN-1/3/8)
# ---------------------------------------------------------------------------

from dwkit.operators import joins as J  # noqa: E402
from dwkit.operators import quality as Q  # noqa: E402
from dwkit.operators import scd as SCD  # noqa: E402
from dwkit.operators import snapshot as ACC  # noqa: E402
from dwkit.operators import dims as D  # noqa: E402
from dwkit.operators import sets as SET  # noqa: E402
from dwkit.sources.reference import US_FEDERAL_HOLIDAYS_2024  # noqa: E402

_KEYS = _FLIGHTS + """
, carriers AS (SELECT carrier_code, min(carrier_name) AS carrier_name FROM flat
               WHERE carrier_code IS NOT NULL GROUP BY 1),
airline_keys AS (SELECT CAST(row_number() OVER (ORDER BY carrier_code) AS BIGINT) AS airline_key,
                 carrier_code, carrier_name FROM carriers),
airports AS (SELECT DISTINCT code FROM (SELECT origin AS code FROM flat UNION ALL SELECT dest FROM flat) x
             WHERE code IS NOT NULL),
airport_keys AS (SELECT CAST(row_number() OVER (ORDER BY code) AS BIGINT) AS airport_key, code FROM airports),
ops AS (
  SELECT f.*, CAST(fl.flight_id AS BIGINT) AS flight_id, fl.distance AS route_distance
  FROM flat f JOIN flights fl
    ON fl.carrier_code IS NOT DISTINCT FROM f.carrier_code AND fl.flight_number IS NOT DISTINCT FROM f.flight_number
   AND fl.origin_code IS NOT DISTINCT FROM f.origin AND fl.dest_code IS NOT DISTINCT FROM f.dest),
fact_keys AS (
  SELECT CAST(row_number() OVER (ORDER BY f.operation_id) AS BIGINT) AS operation_key,
    CAST(year(f.fl_date) * 10000 + month(f.fl_date) * 100 + day(f.fl_date) AS INTEGER) AS date_key,
    a.airline_key, o.airport_key AS origin_airport_key, d.airport_key AS dest_airport_key,
    p.flight_id AS route_key,
    CASE f.cancellation_code_clean WHEN 'N/A' THEN 0 WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3
         WHEN 'D' THEN 4 END AS cancellation_key,
    f.operation_id, f.dep_delay, f.arr_delay, f.taxi_out, f.taxi_in, f.actual_elapsed_time, f.air_time,
    CAST(f.diverted AS SMALLINT) AS diverted, p.route_distance AS distance,
    CAST(f.carrier_delay AS BIGINT) AS carrier_delay, CAST(f.weather_delay AS BIGINT) AS weather_delay,
    CAST(f.nas_delay AS BIGINT) AS nas_delay, CAST(f.security_delay AS BIGINT) AS security_delay,
    CAST(f.late_aircraft_delay AS BIGINT) AS late_aircraft_delay,
    CAST(f.total_delay_minutes AS BIGINT) AS total_delay_minutes, CAST(f.cancelled AS SMALLINT) AS cancelled,
    f.create_time AS accm_txn_create_time, f.complete_time AS accm_txn_complete_time,
    f.process_hours AS txn_process_time_hours,
    CAST(year(f.fl_date) * 100 + month(f.fl_date) AS INTEGER) AS month_key
  FROM fact f
  JOIN airline_keys a ON a.carrier_code = f.carrier_code
  JOIN airport_keys o ON o.code = f.origin
  JOIN airport_keys d ON d.code = f.dest
  JOIN ops p ON p.operation_id = f.operation_id)"""


_DATES = """
, dates AS (SELECT CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS date_key FROM generate_series(
        (SELECT CAST(min(fl_date) AS TIMESTAMP) FROM flat), (SELECT CAST(max(fl_date) AS TIMESTAMP) FROM flat),
        INTERVAL 1 DAY) t(ts))"""


@q("norm_1_flight_operations", S.with_ctes(_KEYS, """
SELECT operation_id, flight_id, fl_date, CAST(year(fl_date) AS SMALLINT) AS year,
       CAST(month(fl_date) AS TINYINT) AS month, CAST(day(fl_date) AS TINYINT) AS day_of_month,
       CAST(dayofweek(fl_date) + 1 AS TINYINT) AS day_of_week, dep_delay, arr_delay, taxi_out, taxi_in,
       actual_elapsed_time, air_time, CAST(diverted AS TINYINT) AS diverted,
       CAST(cancelled AS TINYINT) AS cancelled, cancellation_code
FROM ops"""))
def norm_1_ops(spark, sf):
    return build(spark, sf)["flight_operation"]


@q("norm_1_airlines", S.with_ctes(_KEYS, "SELECT carrier_code, carrier_name FROM carriers"))
def norm_1_airlines(spark, sf):
    return build(spark, sf)["airline"]


@q("norm_2_delay_records", S.with_ctes(_DELAY_RECORDS, """
SELECT CAST(row_number() OVER (ORDER BY operation_id) AS BIGINT) AS delay_id, operation_id,
       carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay FROM delays"""))
def norm_2(spark, sf):
    return build(spark, sf)["delay_record"]


@q("set_2_airports_from_roles", S.with_ctes(_KEYS, """
SELECT code AS airport_code, code AS city_name, code AS state_name FROM airports"""))
def set_2(spark, sf):
    return build(spark, sf)["airport"]


@q("join_8_assign_flight_fk", S.with_ctes(_KEYS, "SELECT operation_id, flight_id FROM ops"))
def join_8(spark, sf):
    f = flat(spark, sf)
    keys = ["op_unique_carrier", "op_carrier_fl_num", "origin", "dest"]
    return J.assign_fk(f.select("operation_id", *keys), build(spark, sf)["flight"], keys, "flight_id",
                       ["carrier_code", "flight_number", "origin_code", "dest_code"]).select("operation_id", "flight_id")


@q("join_1_prepare_operations", S.with_ctes(_KEYS, """
SELECT operation_id, flight_id,
       CASE WHEN cancelled = 0 THEN 'N/A' ELSE coalesce(cancellation_code, 'A') END AS cancellation_code_clean,
       """ + ", ".join(f"CAST(CASE WHEN cancelled = 0 THEN {p} ELSE 0 END AS BIGINT) AS {p}" for p in S.PARTS) + """,
       CAST(CASE WHEN cancelled = 0 THEN carrier_delay + weather_delay + nas_delay + security_delay
            + late_aircraft_delay ELSE 0 END AS BIGINT) AS total_delay_minutes
FROM ops"""))
def join_1(spark, sf):
    """JOIN-1 itself: stored operations left-joined to stored delay records
    (the pipeline derives the same frame from one keyed pass instead)."""
    from dwkit.plans.fact import prepare
    w = build(spark, sf)
    p = prepare(w["flight_operation"], w["delay_record"])
    return p.select("operation_id", "flight_id", "cancellation_code_clean", *S.PARTS, "total_delay_minutes")


@q("join_3_load_fact", S.with_ctes(_KEYS, "SELECT * FROM fact_keys"))
def join_3(spark, sf):
    return build(spark, sf)["fact"]


@q("join_3_fact_errors", S.with_ctes(_KEYS, """
SELECT 'fact_flight_operation' AS source_table, 2 AS error_code,
       'lookup failed: ' || concat_ws(',', CASE WHEN carrier_code IS NULL THEN 'airline_key' END,
              CASE WHEN origin IS NULL THEN 'origin_airport_key' END,
              CASE WHEN dest IS NULL THEN 'dest_airport_key' END) AS error_description,
       concat_ws('|', CAST(operation_id AS VARCHAR), coalesce(CAST(flight_id AS VARCHAR), ''),
                 coalesce(carrier_code, ''), coalesce(origin, ''), coalesce(dest, ''),
                 CASE WHEN cancelled = 0 THEN 'N/A' ELSE coalesce(cancellation_code, 'A') END,
                 CAST(fl_date AS VARCHAR)) AS raw_row,
       TIMESTAMP '2025-01-01 00:00:00' AS captured_at
FROM ops WHERE carrier_code IS NULL OR origin IS NULL OR dest IS NULL"""))
def join_3_errors(spark, sf):
    return build(spark, sf)["fact_errors"]


@q("dim_1_date_dim", S.with_fact("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS SMALLINT) AS year,
       CAST(quarter(d) AS SMALLINT) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
       CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name, strftime(d, '%b %Y') AS month_year,
       CAST(week(d) AS SMALLINT) AS week_of_year, CAST(day(d) AS SMALLINT) AS day_of_month,
       CAST(dayofweek(d) + 1 AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend, d IN (""" + ", ".join(
    f"DATE '{h.isoformat()}'" for h in US_FEDERAL_HOLIDAYS_2024) + """) AS is_public_holiday,
       CAST(year(d) * 100 + month(d) AS INTEGER) AS month_key
FROM (SELECT CAST(ts AS DATE) AS d FROM generate_series(
        (SELECT CAST(min(fl_date) AS TIMESTAMP) FROM flat), (SELECT CAST(max(fl_date) AS TIMESTAMP) FROM flat),
        INTERVAL 1 DAY) t(ts)) days"""))
def dim_1(spark, sf):
    return build(spark, sf)["dim_date"]


@q("dim_2_airport_dim", S.with_ctes(_KEYS, """
SELECT k.airport_key, k.code AS airport_code, k.code AS city_name, k.code AS state_name,
       coalesce(r.region, 'Unknown') AS region, coalesce(r.region_code, 'XX') AS region_code
FROM airport_keys k LEFT JOIN regions r ON r.state_name = k.code"""))
def dim_2(spark, sf):
    return build(spark, sf)["dim_airport"]


@q("dim_3_route_dim", S.with_ctes(_KEYS, """
SELECT CAST(flight_id AS BIGINT) AS route_key, CAST(flight_id AS BIGINT) AS flight_id, carrier_code,
       flight_number, origin_code, dest_code, distance,
       CASE WHEN distance IS NULL THEN NULL WHEN distance < 500 THEN 'Short' WHEN distance <= 1500 THEN 'Medium'
            ELSE 'Long' END AS distance_band
FROM flights"""))
def dim_3(spark, sf):
    return build(spark, sf)["dim_route"]


@q("dim_4_region_reference", S.with_ctes(_KEYS, """
SELECT state_name, region, region_code FROM regions WHERE state_name IN (SELECT code FROM airports)"""))
def dim_4(spark, sf):
    """Region reference rows for the states that occur in the operations
    (origin or destination), a semi join against the flat table."""
    states = SET.union_all([flat(spark, sf).select(F.col("origin_state_nm").alias("state_name")),
                            flat(spark, sf).select(F.col("dest_state_nm").alias("state_name"))])
    return J.semi(FX.region_reference(spark, sf), states.where(F.col("state_name").isNotNull()), "state_name")


@q("dim_5_flights_by_reason", S.with_fact("""
SELECT cancellation_code_clean AS cancellation_code, count(*) AS flights FROM fact GROUP BY 1"""))
def dim_5(spark, sf):
    w = build(spark, sf)
    return J.star(w["fact"], [(w["dim_reason"], "cancellation_key")], broadcast=True) \
        .groupBy("cancellation_code").agg(F.count(F.lit(1)).alias("flights"))


@q("err_1_airport_error_rows", S.with_ctes(_KEYS, """
SELECT 'airport' AS source_table, 1 AS error_code, 'No region for state_name' AS error_description,
       code || '|' || code AS raw_row, TIMESTAMP '2025-01-01 00:00:00' AS captured_at
FROM airports WHERE code NOT IN (SELECT state_name FROM regions)"""))
def err_1(spark, sf):
    return build(spark, sf)["airport_errors"]


# ---------------------------------------------------------------------------
# Slowly changing dimensions (SCD-*, JOIN-12, FLT-5)
# ---------------------------------------------------------------------------

_SCD2 = _KEYS + """
, v1 AS (SELECT airline_key, carrier_code, carrier_name, TIMESTAMP '1900-01-01 00:00:00' AS scd_effective_date,
                CASE WHEN carrier_code < 'C' THEN TIMESTAMP '1998-01-01 00:00:00'
                     ELSE TIMESTAMP '9999-12-31 00:00:00' END AS scd_expiry_date,
                carrier_code >= 'C' AS is_current_record FROM airline_keys),
v2 AS (SELECT CAST((SELECT count(*) FROM carriers) + row_number() OVER (ORDER BY carrier_code) AS BIGINT)
                AS airline_key, carrier_code, carrier_name || ' (renamed)' AS carrier_name,
              TIMESTAMP '1998-01-01 00:00:00' AS scd_effective_date, TIMESTAMP '9999-12-31 00:00:00' AS scd_expiry_date,
              true AS is_current_record FROM carriers WHERE carrier_code < 'C'),
airline_scd AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2)"""


def _airline_two_loads(spark, sf):
    w = build(spark, sf)
    first = D.airline_dim(None, w["airline"], FX.RUN_TS)
    return first, D.airline_dim(first, FX.renamed_carriers(w["airline"]), FX.CHANGE_TS)


@q("scd_4_scd2_two_loads", S.with_ctes(_SCD2, "SELECT * FROM airline_scd"))
def scd_4(spark, sf):
    return _airline_two_loads(spark, sf)[1]


@q("scd_4_scd2_rerun_is_noop", S.with_ctes(_SCD2, "SELECT count(*) AS row_count FROM airline_scd"))
def scd_4_rerun(spark, sf):
    w = build(spark, sf)
    _, second = _airline_two_loads(spark, sf)
    again = D.airline_dim(second, FX.renamed_carriers(w["airline"]), FX.RUN_TS)
    return again.agg(F.count(F.lit(1)).alias("row_count"))


@q("scd_5_classify_second_batch", S.with_ctes(_SCD2, """
SELECT carrier_code, CASE WHEN carrier_code < 'C' THEN carrier_name || ' (renamed)' ELSE carrier_name END
       AS carrier_name, CASE WHEN carrier_code < 'C' THEN 'changed' ELSE 'unchanged' END AS scd_status
FROM carriers"""))
def scd_5(spark, sf):
    w = build(spark, sf)
    first, _ = _airline_two_loads(spark, sf)
    return SCD.scd2_classify(first, FX.renamed_carriers(w["airline"]), "carrier_code", ["carrier_name"])


@q("scd_6_current_versions", S.with_ctes(_SCD2, "SELECT * FROM airline_scd WHERE is_current_record"))
def scd_6(spark, sf):
    return SCD.current(_airline_two_loads(spark, sf)[1])


@q("flt_5_history_of_carrier", S.with_ctes(_SCD2, "SELECT * FROM airline_scd WHERE carrier_code = 'AUTOMOBILE'"))
def flt_5(spark, sf):
    return SCD.history_of(_airline_two_loads(spark, sf)[1], "carrier_code", "AUTOMOBILE")


@q("join_12_as_of_carrier_name", S.with_ctes(_SCD2, """
SELECT s.carrier_name, count(*) AS flights
FROM fact f JOIN airline_scd s ON s.carrier_code = f.carrier_code
 AND s.scd_effective_date <= CAST(f.fl_date AS TIMESTAMP) AND CAST(f.fl_date AS TIMESTAMP) < s.scd_expiry_date
GROUP BY 1"""))
def join_12(spark, sf):
    # Facts are counted by carrier and day first; those counts meet the versions.
    dim = _airline_two_loads(spark, sf)[1]
    f = cube(spark, sf).frame(["airline.carrier", "date.day"]).groupBy(
        F.col("airline_carrier_code").alias("carrier_code"), F.col("date_full_date").alias("fl_date")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return J.lookup_as_of(f, dim, "carrier_code", "fl_date", ["carrier_name"], how="inner") \
        .groupBy("carrier_name").agg(F.sum("n").alias("flights"))


@q("scd_1_scd1_two_loads", S.with_ctes(_KEYS + """
, m AS (SELECT CAST(row_number() OVER (ORDER BY code) AS BIGINT) AS airport_key, code FROM airports
        WHERE code IN (SELECT state_name FROM regions)),
u AS (SELECT CAST((SELECT count(*) FROM m) + row_number() OVER (ORDER BY code) AS BIGINT) AS airport_key, code
      FROM airports WHERE code NOT IN (SELECT state_name FROM regions))""", """
SELECT k.airport_key, k.code AS airport_code, k.code AS city_name, k.code AS state_name,
       coalesce(r.region, 'Unknown') AS region, coalesce(r.region_code, 'XX') AS region_code
FROM (SELECT * FROM m UNION ALL SELECT * FROM u) k LEFT JOIN regions r ON r.state_name = k.code"""))
def scd_1(spark, sf):
    w = build(spark, sf)
    regions = FX.region_reference(spark, sf)
    first, _ = D.airport_dim(None, w["airport"], regions, FX.RUN_TS, unmatched="quarantine")
    second, _ = D.airport_dim(first, w["airport"], regions, FX.RUN_TS, unmatched="default")
    return second


@q("scd_7_default_member", S.with_ctes(_KEYS, """
SELECT k.airport_key, k.code AS airport_code, k.code AS city_name, k.code AS state_name,
       coalesce(r.region, 'Unknown') AS region, coalesce(r.region_code, 'XX') AS region_code
FROM airport_keys k LEFT JOIN regions r ON r.state_name = k.code
UNION ALL SELECT 0, 'N/A', 'N/A', 'N/A', 'N/A', 'XX'"""))
def scd_7(spark, sf):
    row = {"airport_key": 0, "airport_code": "N/A", "city_name": "N/A", "state_name": "N/A", "region": "N/A",
           "region_code": "XX"}
    return SCD.with_default_member(build(spark, sf)["dim_airport"], row)


# ---------------------------------------------------------------------------
# Accumulating snapshot (ACC-*, PRJ-7, DQ-11)
# ---------------------------------------------------------------------------

_LATEST = _FEED + """
, latest AS (SELECT operation_id, max(accm_txn_complete_time) AS accm_txn_complete_time FROM feed GROUP BY 1)"""


@q("acc_2_feed_stats", S.with_ctes(_FEED, """
SELECT count(*) AS staged_rows, count(DISTINCT operation_id) AS distinct_ids,
       count(*) - count(DISTINCT operation_id) AS duplicate_rows FROM feed"""))
def acc_2(spark, sf):
    return ACC.feed_stats(build(spark, sf)["feed"])


@q("acc_4_apply_completions", S.with_fact("""
SELECT operation_id, complete_time AS accm_txn_complete_time, process_hours AS txn_process_time_hours
FROM fact"""))
def acc_4(spark, sf):
    return build(spark, sf)["fact"].select("operation_id", "accm_txn_complete_time", "txn_process_time_hours")


@q("acc_4_completion_errors", S.with_ctes(_LATEST, """
SELECT l.operation_id, l.accm_txn_complete_time, 'operation_id not found in fact table' AS error_reason,
       TIMESTAMP '2025-01-01 00:00:00' AS captured_at, CAST(NULL AS BIGINT) AS batch_id
FROM latest l WHERE l.operation_id NOT IN (SELECT operation_id FROM fact)"""))
def acc_4_errors(spark, sf):
    return build(spark, sf)["accum_errors"]


@q("acc_4_rerun_is_noop", S.with_fact("""
SELECT count(*) AS row_count, count(complete_time) AS completed, sum(process_hours) AS hours FROM fact"""))
def acc_4_rerun(spark, sf):
    w = build(spark, sf)
    again, _ = ACC.apply_completions(w["fact"], w["feed"], FX.RUN_TS)
    return again.agg(F.count(F.lit(1)).alias("row_count"), F.count("accm_txn_complete_time").alias("completed"),
                     F.sum("txn_process_time_hours").alias("hours"))


@q("acc_9_error_summary", S.with_ctes(_LATEST, """
SELECT count(*) AS error_rows, min(operation_id) AS min_id, max(operation_id) AS max_id,
       TIMESTAMP '2025-01-01 00:00:00' AS first_captured, TIMESTAMP '2025-01-01 00:00:00' AS last_captured
FROM latest WHERE operation_id NOT IN (SELECT operation_id FROM fact)"""))
def acc_9(spark, sf):
    return ACC.error_summary(build(spark, sf)["accum_errors"])


@q("dq_11_completed_before_created", S.with_fact("""
SELECT carrier_name, count(*) AS violations FROM fact WHERE complete_time <= create_time GROUP BY 1"""))
def dq_11(spark, sf):
    f = cube(spark, sf).frame(["airline.carrier_name"])
    return Q.check_timeline(f, "accm_txn_create_time", "accm_txn_complete_time") \
        .groupBy(F.col("airline_carrier_name").alias("carrier_name")).agg(F.count(F.lit(1)).alias("violations"))


# ---------------------------------------------------------------------------
# Quality, reconciliation, references (DQ-*, JOIN-2/6/7/9/10/11/13, SET-*)
# ---------------------------------------------------------------------------

_PROFILE_COLS = [("operation_id", "operation_id", "bigint"), ("year", "CAST(year(fl_date) AS SMALLINT)", "smallint"),
                 ("month", "CAST(month(fl_date) AS TINYINT)", "tinyint"),
                 ("day_of_month", "CAST(day(fl_date) AS TINYINT)", "tinyint"),
                 ("day_of_week", "CAST(dayofweek(fl_date) + 1 AS TINYINT)", "tinyint"), ("fl_date", "fl_date", "date"),
                 ("op_unique_carrier", "carrier_code", "string"), ("carrier_name", "carrier_name", "string"),
                 ("op_carrier_fl_num", "flight_number", "bigint"), ("origin", "origin", "string"),
                 ("origin_city_name", "origin", "string"), ("origin_state_nm", "origin", "string"),
                 ("dest", "dest", "string"), ("dest_city_name", "dest", "string"), ("dest_state_nm", "dest", "string"),
                 ("dep_delay", "dep_delay", "double"), ("arr_delay", "arr_delay", "double"),
                 ("taxi_out", "taxi_out", "double"), ("taxi_in", "taxi_in", "double"),
                 ("actual_elapsed_time", "actual_elapsed_time", "double"), ("air_time", "air_time", "double"),
                 ("diverted", "CAST(diverted AS TINYINT)", "tinyint"),
                 ("cancelled", "CAST(cancelled AS TINYINT)", "tinyint"),
                 ("cancellation_code", "cancellation_code", "string"), ("distance", "distance", "double"),
                 *[(p, p, "bigint") for p in S.PARTS], ("first_ship", "first_ship", "timestamp_ntz")]


def _profile_sql(samples: bool = False) -> str:
    parts = []
    for i, (name, expr, dtype) in enumerate(_PROFILE_COLS):
        few = (f"(SELECT '[' || coalesce(string_agg(v, ', ' ORDER BY v), '') || ']' FROM (SELECT DISTINCT "
               f"CAST({expr} AS VARCHAR) AS v FROM flat WHERE {expr} IS NOT NULL ORDER BY v LIMIT 5) s)")
        pct = f"round_even((count(*) - count({expr})) * 100.0 / count(*), 2)"
        parts.append(f"""SELECT '{name}' AS column, '{dtype}' AS dtype, count(*) AS total_rows,
       count(*) - count({expr}) AS null_count, {pct} AS null_pct,
       printf('%.2f', 100 - {pct}) || '%' AS completeness, count(DISTINCT {expr}) AS unique_values,
       CAST(min({expr}) AS VARCHAR) AS min, CAST(max({expr}) AS VARCHAR) AS max,
       {few if samples else "CAST(NULL AS VARCHAR)"} AS sample_values FROM flat""")
    return " UNION ALL ".join(parts)


@q("dq_1_profile", S.with_fact(_profile_sql()))
def dq_1(spark, sf):
    return Q.profile(flat(spark, sf), samples=False)


@q("dq_1_profile_with_samples", S.with_fact(_profile_sql(samples=True)))
def dq_1_samples(spark, sf):
    """Profile of all columns with the five smallest distinct values of each."""
    return Q.profile(flat(spark, sf))


def _rules():
    return Q.flight_rules(dep_time="dep_delay", parts=S.PARTS)


_CHECKS = """
SELECT 0 AS check_no, 'Cancelled flights with non-null dep_time' AS "check",
       CAST(count(*) FILTER (WHERE cancelled = 1 AND dep_delay IS NOT NULL) AS VARCHAR) AS value,
       CASE WHEN count(*) FILTER (WHERE cancelled = 1 AND dep_delay IS NOT NULL) > 0 THEN 'HIGH' ELSE 'OK' END
         AS severity FROM flat
UNION ALL SELECT 1, 'Operated flights missing dep_time',
       CAST(count(*) FILTER (WHERE cancelled = 0 AND dep_delay IS NULL) AS VARCHAR),
       CASE WHEN count(*) FILTER (WHERE cancelled = 0 AND dep_delay IS NULL) > 0 THEN 'MEDIUM' ELSE 'OK' END FROM flat
UNION ALL SELECT 2, 'Cancelled flights with non-zero delay components',
       CAST(count(*) FILTER (WHERE cancelled = 1 AND carrier_delay + weather_delay + nas_delay + security_delay
            + late_aircraft_delay > 0) AS VARCHAR), 'LOW' FROM flat
UNION ALL SELECT 3, 'dep_delay ↔ arr_delay Pearson correlation',
       CAST(round(corr(dep_delay, arr_delay), 4) AS VARCHAR),
       CASE WHEN round(corr(dep_delay, arr_delay), 4) > 0.8 THEN 'OK' ELSE 'REVIEW' END FROM flat
UNION ALL SELECT 4, 'Cancelled flights with actual_elapsed_time',
       CAST(count(*) FILTER (WHERE cancelled = 1 AND actual_elapsed_time IS NOT NULL) AS VARCHAR),
       CASE WHEN count(*) FILTER (WHERE cancelled = 1 AND actual_elapsed_time IS NOT NULL) > 0 THEN 'HIGH' ELSE 'OK' END FROM flat
UNION ALL SELECT 5, 'Earliest fl_date', CAST(CAST(min(fl_date) AS TIMESTAMP) AS VARCHAR), 'INFO' FROM flat
UNION ALL SELECT 6, 'Latest fl_date', CAST(CAST(max(fl_date) AS TIMESTAMP) AS VARCHAR), 'INFO' FROM flat
UNION ALL SELECT 7, 'Months covered', CAST(count(DISTINCT month(fl_date)) AS VARCHAR), 'INFO' FROM flat"""


@q("dq_2_run_checks", S.with_fact(_CHECKS))
def dq_2(spark, sf):
    return Q.run_checks(flat(spark, sf), _rules())


@q("dq_4_check_references", S.with_ctes(_KEYS + """
, dates AS (SELECT CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS date_key FROM generate_series(
        (SELECT CAST(min(fl_date) AS TIMESTAMP) FROM flat), (SELECT CAST(max(fl_date) AS TIMESTAMP) FROM flat),
        INTERVAL 1 DAY) t(ts))""", """
SELECT relationship, orphans, CASE WHEN orphans = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
SELECT 'fact.date_key' AS relationship, count(*) FILTER (WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM dates))
       AS orphans FROM fact_keys
UNION ALL SELECT 'fact.airline_key' AS relationship, count(*) FILTER (WHERE airline_key IS NOT NULL AND airline_key NOT IN (SELECT airline_key FROM airline_keys))
       AS orphans FROM fact_keys
UNION ALL SELECT 'fact.origin_airport_key' AS relationship, count(*) FILTER (WHERE origin_airport_key IS NOT NULL AND origin_airport_key NOT IN (SELECT airport_key FROM airport_keys))
       AS orphans FROM fact_keys
UNION ALL SELECT 'fact.dest_airport_key' AS relationship, count(*) FILTER (WHERE dest_airport_key IS NOT NULL AND dest_airport_key NOT IN (SELECT airport_key FROM airport_keys))
       AS orphans FROM fact_keys
UNION ALL SELECT 'fact.route_key' AS relationship, count(*) FILTER (WHERE route_key IS NOT NULL AND route_key NOT IN (SELECT flight_id FROM flights))
       AS orphans FROM fact_keys
UNION ALL SELECT 'fact.cancellation_key' AS relationship, count(*) FILTER (WHERE cancellation_key IS NOT NULL AND cancellation_key NOT IN (SELECT k FROM (SELECT unnest([0, 1, 2, 3, 4]) AS k) r))
       AS orphans FROM fact_keys
UNION ALL SELECT 'flight_operation.flight_id' AS relationship, count(*) FILTER (WHERE flight_id IS NOT NULL AND flight_id NOT IN (SELECT flight_id FROM flights))
       AS orphans FROM ops) t"""))
def dq_4(spark, sf):
    w = build(spark, sf)
    f = w["fact"]
    return Q.check_references([
        ("fact.date_key", f, "date_key", w["dim_date"], "date_key"),
        ("fact.airline_key", f, "airline_key", w["dim_airline"], "airline_key"),
        ("fact.origin_airport_key", f, "origin_airport_key", w["dim_airport"], "airport_key"),
        ("fact.dest_airport_key", f, "dest_airport_key", w["dim_airport"], "airport_key"),
        ("fact.route_key", f, "route_key", w["dim_route"], "route_key"),
        ("fact.cancellation_key", f, "cancellation_key", w["dim_reason"], "cancellation_key"),
        ("flight_operation.flight_id", w["flight_operation"], "flight_id", w["flight"], "flight_id"),
    ])


@q("dq_6_row_counts", S.with_ctes(_KEYS + _DATES, """
SELECT 'flight_operation' AS table_name, count(*) AS row_count FROM flat
UNION ALL SELECT 'flight', count(*) FROM flights
UNION ALL SELECT 'dim_airline', count(*) FROM carriers
UNION ALL SELECT 'dim_airport', count(*) FROM airports
UNION ALL SELECT 'fact', count(*) FROM fact
UNION ALL SELECT 'fact_errors', count(*) FROM flat WHERE dest IS NULL OR origin IS NULL OR carrier_code IS NULL
UNION ALL SELECT 'dim_date', (SELECT count(*) FROM dates)
UNION ALL SELECT 'dim_airline_current', count(*) FROM carriers
UNION ALL SELECT 'dim_route', count(*) FROM flights
UNION ALL SELECT 'dim_reason', count(*) FROM (SELECT unnest(['N/A', 'A', 'B', 'C', 'D'])) r"""))
def dq_6(spark, sf):
    w = build(spark, sf)
    return Q.row_counts({"flight_operation": w["flight_operation"], "flight": w["flight"],
                         "dim_airline": w["dim_airline"], "dim_airport": w["dim_airport"], "fact": w["fact"],
                         "fact_errors": w["fact_errors"], "dim_date": w["dim_date"],
                         "dim_airline_current": SCD.current(w["dim_airline"]), "dim_route": w["dim_route"],
                         "dim_reason": w["dim_reason"]})


@q("dq_7_null_fk_counts", S.with_ctes(_KEYS, "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {k} IS NULL) AS null_{k}" for k in ['date_key', 'airline_key', 'origin_airport_key', 'dest_airport_key', 'route_key', 'cancellation_key']) + " FROM fact_keys"))
def dq_7(spark, sf):
    from dwkit.plans.fact import FK_COLUMNS
    return Q.null_counts(build(spark, sf)["fact"], FK_COLUMNS)


@q("dq_8_reconcile", S.with_fact("""
SELECT (SELECT count(*) FROM flat) AS source_rows, count(*) AS loaded_rows,
       CAST(sum(1 - cancelled) AS BIGINT) AS operated_rows, CAST(sum(cancelled) AS BIGINT) AS cancelled_rows,
       (SELECT count(*) FROM flat WHERE dest IS NULL OR origin IS NULL OR carrier_code IS NULL) AS rejected_rows,
       true AS balanced, true AS status_balanced
FROM fact"""))
def dq_8(spark, sf):
    w = build(spark, sf)
    return Q.reconcile(w["prepared"], w["fact"], w["fact_errors"])


@q("dq_9_10_13_14_violation_counts", S.with_ctes(_KEYS, """
SELECT count(*) FILTER (WHERE total_delay_minutes <> carrier_delay + weather_delay + nas_delay + security_delay
                        + late_aircraft_delay) AS total_mismatch,
       count(*) FILTER (WHERE txn_process_time_hours IS NOT NULL AND abs(txn_process_time_hours - date_diff(
           'minute', accm_txn_create_time, accm_txn_complete_time) / 60.0) > 0.01) AS hours_mismatch,
       (SELECT count(*) FROM customer WHERE length(rtrim(c_name)) <> length(c_name)) AS padded_names,
       count(*) FILTER (WHERE cancelled = 1 AND (cancellation_key IS NULL OR cancellation_key = 0))
         AS cancelled_without_reason
FROM fact_keys"""))
def dq_9(spark, sf):
    from dwkit.functions.dates import hours_between
    w = build(spark, sf)
    f = w["fact"]
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    tot = Q.check_total(f, list(S.PARTS), "total_delay_minutes")
    rec = Q.check_recompute(f.where(F.col("txn_process_time_hours").isNotNull()), "txn_process_time_hours",
                            hours_between("accm_txn_create_time", "accm_txn_complete_time"))
    pad = Q.check_padding(FX.table(spark, sf, "customer"), "c_name")
    rsn = Q.check_reason(f)
    return spark.range(1).select(n(tot).alias("total_mismatch"), n(rec).alias("hours_mismatch"),
                                 n(pad).alias("padded_names"), n(rsn).alias("cancelled_without_reason"))


@q("join_2_lookup_matched", S.with_ctes(_KEYS, """
SELECT a.code AS airport_code, a.code AS city_name, a.code AS state_name, r.region, r.region_code
FROM airports a JOIN regions r ON r.state_name = a.code"""))
def join_2_matched(spark, sf):
    m, _ = J.lookup(build(spark, sf)["airport"], FX.region_reference(spark, sf), "state_name",
                    ["region", "region_code"])
    return m


@q("join_2_lookup_unmatched", S.with_ctes(_KEYS, """
SELECT a.code AS airport_code, a.code AS city_name, a.code AS state_name FROM airports a
WHERE a.code NOT IN (SELECT state_name FROM regions)"""))
def join_2_unmatched(spark, sf):
    _, u = J.lookup(build(spark, sf)["airport"], FX.region_reference(spark, sf), "state_name",
                    ["region", "region_code"])
    return u


@q("join_6_orders_without_lines", """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def join_6(spark, sf):
    return J.orphans(FX.table(spark, sf, "orders"), "o_orderkey", FX.table(spark, sf, "lineitem"), "l_orderkey")


@q("join_7_orders_with_lines_by_status", """
SELECT o_orderstatus, count(*) AS orders FROM orders o
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""")
def join_7(spark, sf):
    o = FX.table(spark, sf, "orders")
    li = FX.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.semi(o, li, "o_orderkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@q("join_9_map_customer_region", """
SELECT coalesce(r.r_name, 'Unknown') AS region, count(*) AS customers
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey AND r.r_name <> 'MIDDLE EAST'
GROUP BY 1""")
def join_9(spark, sf):
    """Every customer's nation mapped to its region through the reference
    with the hole; unmapped nations get the default 'Unknown'."""
    nation = FX.table(spark, sf, "nation").select("n_nationkey", "n_name")
    cust = FX.table(spark, sf, "customer").select("c_nationkey").join(
        F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    mapped = J.map_values(cust, "n_name", FX.region_reference(spark, sf), "state_name", "region", "region")
    return mapped.groupBy("region").agg(F.count(F.lit(1)).alias("customers"))


@q("set_3_unmapped_states", S.with_ctes(_KEYS, """
SELECT code AS state_name FROM airports WHERE code NOT IN (SELECT state_name FROM regions)"""))
def set_3(spark, sf):
    return SET.missing_values(build(spark, sf)["airport"], "state_name", FX.region_reference(spark, sf),
                              "state_name")


@q("join_10_bring_distance", S.with_ctes(_KEYS, "SELECT operation_id, route_distance AS distance FROM ops"))
def join_10(spark, sf):
    w = build(spark, sf)
    return J.bring(w["flight_operation"].select("operation_id", "flight_id"), w["flight"], "flight_id",
                   ["distance"]).select("operation_id", "distance")


@q("join_11_origin_dest_roles", S.with_fact("""
SELECT origin_region, dest_region, count(*) AS flights FROM fact GROUP BY 1, 2"""))
def join_11(spark, sf):
    w = build(spark, sf)
    f = J.join_role(w["fact"], w["dim_airport"], "origin_airport_key", "airport_key", "origin_", ["region"])
    f = J.join_role(f, w["dim_airport"], "dest_airport_key", "airport_key", "dest_", ["region"])
    return f.groupBy("origin_region", "dest_region").agg(F.count(F.lit(1)).alias("flights"))


@q("join_13_check_reason_lookup", S.with_ctes(_KEYS, """
SELECT CASE WHEN cancelled = 0 THEN 'N/A' ELSE coalesce(cancellation_code, 'A') END AS code,
       count(*) AS row_count, 'PASS' AS status FROM ops GROUP BY 1"""))
def join_13(spark, sf):
    w = build(spark, sf)
    return J.check_lookup(w["prepared"], "cancellation_code_clean", w["dim_reason"], "cancellation_code")


@q("join_5_fk_spot_check", S.with_ctes(_KEYS, """
SELECT k.operation_id, k.date_key, a.carrier_name, o.code AS origin_code, d.code AS dest_code
FROM fact_keys k JOIN airline_keys a ON a.airline_key = k.airline_key
JOIN airport_keys o ON o.airport_key = k.origin_airport_key JOIN airport_keys d ON d.airport_key = k.dest_airport_key
ORDER BY k.operation_id LIMIT 10"""))
def join_5(spark, sf):
    w = build(spark, sf)
    ap = w["dim_airport"]
    f = SM.top_n(w["fact"].select("operation_id", "date_key", "airline_key", "origin_airport_key",
                                  "dest_airport_key"), 10, [F.col("operation_id")])
    out = J.fk_spot_check(f, [(w["dim_airline"], "airline_key", ["carrier_name"])])
    out = J.join_role(out, ap, "origin_airport_key", "airport_key", "origin_", ["airport_code"])
    out = J.join_role(out, ap, "dest_airport_key", "airport_key", "dest_", ["airport_code"])
    return out.select("operation_id", "date_key", "carrier_name", F.col("origin_airport_code").alias("origin_code"),
                      F.col("dest_airport_code").alias("dest_code"))


@q("set_1_union_airport_roles", S.with_fact("""
SELECT code, count(*) AS uses FROM (SELECT origin AS code FROM flat UNION ALL SELECT dest FROM flat) x
WHERE code IS NOT NULL GROUP BY 1"""))
def set_1(spark, sf):
    f = flat(spark, sf)
    u = SET.union_all([f.select(F.col("origin").alias("code")), f.select(F.col("dest").alias("code"))])
    return u.where(F.col("code").isNotNull()).groupBy("code").agg(F.count(F.lit(1)).alias("uses"))


@q("prj_4_clean_code_counts", S.with_fact("""
SELECT CASE WHEN cancelled = 0 THEN 'N/A' ELSE coalesce(cancellation_code, 'A') END AS code, count(*) AS n
FROM flat GROUP BY 1"""))
def prj_4(spark, sf):
    from dwkit.functions.expr import clean_code
    return flat(spark, sf).groupBy(clean_code("cancelled", "cancellation_code").alias("code")) \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Streaming (STR-1)
# ---------------------------------------------------------------------------

@q("str_1_stream_completions", ORACLES["acc_4_apply_completions"])
def str_1(spark, sf):
    """Completion feed written as CSV files (derived from lineitem), streamed
    with ``availableNow``, read back through the merge-on-read view; the
    result must equal the batch update (acc_4)."""
    from dwkit.sources.files import scratch_path
    from dwkit.streaming.completions import completed_view, completion_log, stream_completions
    w = build(spark, sf)
    base = scratch_path(spark, "str1")
    src = base + "/incoming"
    (w["feed"].select("operation_id", F.date_format("accm_txn_complete_time", "yyyy-MM-dd HH:mm:ss")
                      .alias("accm_txn_complete_time"))
     .write.option("header", True).csv(src))
    stream_completions(spark, src, base + "/log", base + "/ckpt")
    view = completed_view(w["fact_loaded"], completion_log(spark, base + "/log"))
    return view.select("operation_id", "accm_txn_complete_time", "txn_process_time_hours")


@q("str_1_compacted_errors", ORACLES["acc_4_completion_errors"])
def str_1_errors(spark, sf):
    """Unknown ids of the streamed feed, returned when the log is folded into the fact."""
    from dwkit.sources.files import scratch_path
    from dwkit.streaming.completions import compact, completion_log, stream_completions
    w = build(spark, sf)
    base = scratch_path(spark, "str1")
    (w["feed"].select("operation_id", F.date_format("accm_txn_complete_time", "yyyy-MM-dd HH:mm:ss")
                      .alias("accm_txn_complete_time"))
     .write.option("header", True).csv(base + "/incoming"))
    stream_completions(spark, base + "/incoming", base + "/log", base + "/ckpt")
    return compact(w["fact_loaded"], completion_log(spark, base + "/log"), FX.RUN_TS)[1]


# ---------------------------------------------------------------------------
# Sources and sinks (SRC-1, SRC-2, SRC-10)
# ---------------------------------------------------------------------------

@q("src_1_typed_csv_round_trip", S.with_fact("""
SELECT operation_id, fl_date, carrier_code AS op_unique_carrier, arr_delay FROM flat"""))
def src_1(spark, sf):
    """The flat table exported as CSV (SRC-10) and read back with a declared
    schema, FAILFAST, and a 4-column projection (SRC-1, SRC-2)."""
    from dwkit.sources.files import read_csv, scratch_path, write_csv
    base = scratch_path(spark, "src1")
    cols = ["operation_id", "fl_date", "op_unique_carrier", "origin", "dest", "arr_delay", "cancelled"]
    write_csv(flat(spark, sf).select(*cols), base + "/csv")
    schema = ("operation_id bigint, fl_date date, op_unique_carrier string, origin string, dest string, "
              "arr_delay double, cancelled tinyint")
    return read_csv(spark, base + "/csv", schema, columns=["operation_id", "fl_date", "op_unique_carrier",
                                                           "arr_delay"], date_format="yyyy-MM-dd")


# ---------------------------------------------------------------------------
# Report pages (RPT-3, RPT-4, RPT-6, RPT-11)
# ---------------------------------------------------------------------------

_EU = "(origin_region = 'EUROPE')"


@q("rpt_3_delay_by_carrier_in_region", S.with_fact(f"""
SELECT carrier_name AS airline_carrier_name, count(*) AS flights,
       sum(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated,
       count(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated_n,
       round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay
FROM fact WHERE {_EU} GROUP BY 1"""))
def rpt_3_carrier(spark, sf):
    return R.delay_overview(cube(spark, sf), {"origin.region": "EUROPE"})["delay_by_carrier"]


@q("rpt_3_monthly_on_time_in_region", S.with_fact(f"""
SELECT year AS date_year, month AS date_month, max(monthname(fl_date)) AS date_month_name,
       CAST({S.ON_TIME} AS BIGINT) AS on_time, CAST({S.OPERATED} AS BIGINT) AS operated,
       {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate
FROM fact WHERE {_EU} GROUP BY 1, 2"""))
def rpt_3_monthly(spark, sf):
    return R.delay_overview(cube(spark, sf), {"origin.region": "EUROPE"})["monthly_on_time"]


_CAUSES_EU = " UNION ALL ".join(
    f"SELECT '{p}' AS cause, CAST(sum({p}) AS BIGINT) AS minutes FROM fact WHERE {_EU}" for p in S.PARTS)


@q("rpt_3_cause_share_in_region", S.with_ctes(f", causes AS ({_CAUSES_EU})", """
SELECT cause, minutes, round(CAST(minutes AS DOUBLE) / (SELECT sum(minutes) FROM causes), 4) AS share
FROM causes"""))
def rpt_3_causes(spark, sf):
    return R.delay_overview(cube(spark, sf), {"origin.region": "EUROPE"})["cause_share"]


@q("rpt_3_kpi_cards_in_region", S.with_fact(f"""
SELECT count(*) AS flights, CAST(sum(cancelled) AS BIGINT) AS cancelled, CAST({S.ON_TIME} AS BIGINT) AS on_time,
       CAST({S.OPERATED} AS BIGINT) AS operated, {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate,
       {S.rate('sum(cancelled)', 'count(*)')} AS cancellation_rate,
       sum(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated,
       count(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated_n,
       round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay
FROM fact WHERE {_EU}"""))
def rpt_3_kpis(spark, sf):
    return R.delay_overview(cube(spark, sf), {"origin.region": "EUROPE"})["kpis"]


@q("rpt_4_drill_table_with_totals", S.with_fact(f"""
SELECT year AS date_year, quarter AS date_quarter,
       CASE WHEN GROUPING(quarter) = 1 THEN NULL ELSE max({_QN}) END AS date_quarter_name,
       count(*) AS flights, CAST({S.ON_TIME} AS BIGINT) AS on_time, CAST({S.OPERATED} AS BIGINT) AS operated,
       {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate,
       CAST(GROUPING(year, quarter) AS BIGINT) AS grouping_id
FROM fact WHERE carrier_code = 'FURNITURE' GROUP BY ROLLUP (year, quarter)"""))
def rpt_4(spark, sf):
    out = R.drill_table(cube(spark, sf), "date", "Calendar", "quarter", ["flights", "on_time_rate"],
                        {"airline.carrier": "FURNITURE"})
    return out.withColumn("grouping_id", F.col("grouping_id").cast("long"))


_BLD = "(carrier_code = 'BUILDING')"


@q("rpt_6_carrier_detail_monthly", S.with_fact(f"""
SELECT year AS date_year, month AS date_month, max(monthname(fl_date)) AS date_month_name, count(*) AS flights,
       CAST({S.ON_TIME} AS BIGINT) AS on_time, CAST({S.OPERATED} AS BIGINT) AS operated,
       {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate,
       sum(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated,
       count(CASE WHEN cancelled = 0 THEN arr_delay END) AS arr_delay_operated_n,
       round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay
FROM fact WHERE {_BLD} GROUP BY 1, 2"""))
def rpt_6_monthly(spark, sf):
    return R.carrier_detail(cube(spark, sf), "BUILDING")["monthly"]


_CQ = " UNION ALL ".join(
    f"SELECT year, quarter, '{p}' AS cause, CAST(sum({p}) AS BIGINT) AS minutes FROM fact WHERE {_BLD} "
    "GROUP BY year, quarter" for p in S.PARTS)


@q("rpt_6_carrier_detail_causes_by_quarter", S.with_ctes(f", cq AS ({_CQ})", """
SELECT year, quarter, cause, minutes,
       round(CAST(minutes AS DOUBLE) / sum(minutes) OVER (PARTITION BY year, quarter), 4) AS share FROM cq"""))
def rpt_6_causes(spark, sf):
    return R.carrier_detail(cube(spark, sf), "BUILDING")["causes_by_quarter"]


@q("rpt_6_carrier_detail_top_routes", S.with_fact(f"""
SELECT flight_number, origin, dest, round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay,
       count(*) AS flights
FROM fact WHERE {_BLD} GROUP BY 1, 2, 3
ORDER BY avg_arr_delay DESC NULLS LAST, flight_number, origin, dest LIMIT 10"""))
def rpt_6_routes(spark, sf):
    return R.carrier_detail(cube(spark, sf), "BUILDING")["top_routes"]


@q("rpt_6_carrier_detail_gauge", S.with_fact(f"""
SELECT {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate, CAST(85.0 AS DOUBLE) AS target,
       round({S.rate(S.ON_TIME, S.OPERATED)} - 85.0, 4) AS gap FROM fact WHERE {_BLD}"""))
def rpt_6_gauge_one(spark, sf):
    return R.carrier_detail(cube(spark, sf), "BUILDING")["gauge"]


@q("rpt_11_riskiest_origin_dest_pairs", S.with_fact(f"""
SELECT origin, dest, {S.headline_sql()} FROM fact GROUP BY 1, 2
ORDER BY cancellation_rate DESC NULLS LAST, origin, dest LIMIT 10"""))
def rpt_11_riskiest(spark, sf):
    f = cube(spark, sf).frame(["origin.airport", "dest.airport"]).withColumnsRenamed(
        {"origin_airport_code": "origin", "dest_airport_code": "dest"})
    return R.riskiest(f, ["origin", "dest"], 10)


# ---------------------------------------------------------------------------
# Key uniqueness and dimension integrity (DQ-5, OLAP-11)
# ---------------------------------------------------------------------------

@q("dq_5_duplicate_dimension_keys", S.with_ctes(_KEYS, """
SELECT 'dim_airport.airport_code' AS key_name,
       (SELECT count(*) FROM (SELECT code FROM airport_keys GROUP BY 1 HAVING count(*) > 1) d) AS duplicated_keys
UNION ALL SELECT 'dim_route.flight_id',
       (SELECT count(*) FROM (SELECT flight_id FROM flights GROUP BY 1 HAVING count(*) > 1) d)
UNION ALL SELECT 'fact.operation_id',
       (SELECT count(*) FROM (SELECT operation_id FROM fact_keys GROUP BY 1 HAVING count(*) > 1) d)"""))
def dq_5(spark, sf):
    w = build(spark, sf)
    checks = [("dim_airport.airport_code", w["dim_airport"], ["airport_code"]),
              ("dim_route.flight_id", w["dim_route"], ["flight_id"]),
              ("fact.operation_id", w["fact"], ["operation_id"])]
    parts = [A.duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicated_keys"))
             .select(F.lit(name).alias("key_name"), "duplicated_keys") for name, df, keys in checks]
    return SET.union_all(parts)


@q("olap_11_check_dimensions", S.with_ctes(_KEYS + """
, dates AS (SELECT CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS date_key FROM generate_series(
        (SELECT CAST(min(fl_date) AS TIMESTAMP) FROM flat), (SELECT CAST(max(fl_date) AS TIMESTAMP) FROM flat),
        INTERVAL 1 DAY) t(ts))""", """
SELECT 'date_key' AS fk, count(*) FILTER (WHERE date_key IS NULL) AS null_keys,
       count(*) FILTER (WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM dates)) AS not_found,
       (SELECT count(*) FROM (SELECT date_key FROM dates GROUP BY 1 HAVING count(*) > 1) d) AS duplicate_keys
FROM fact_keys
UNION ALL SELECT 'airline_key' AS fk, count(*) FILTER (WHERE airline_key IS NULL) AS null_keys,
       count(*) FILTER (WHERE airline_key IS NOT NULL AND airline_key NOT IN (SELECT airline_key FROM airline_keys)) AS not_found,
       (SELECT count(*) FROM (SELECT airline_key FROM airline_keys GROUP BY 1 HAVING count(*) > 1) d) AS duplicate_keys
FROM fact_keys
UNION ALL SELECT 'origin_airport_key' AS fk, count(*) FILTER (WHERE origin_airport_key IS NULL) AS null_keys,
       count(*) FILTER (WHERE origin_airport_key IS NOT NULL AND origin_airport_key NOT IN (SELECT airport_key FROM airport_keys)) AS not_found,
       (SELECT count(*) FROM (SELECT airport_key FROM airport_keys GROUP BY 1 HAVING count(*) > 1) d) AS duplicate_keys
FROM fact_keys
UNION ALL SELECT 'route_key' AS fk, count(*) FILTER (WHERE route_key IS NULL) AS null_keys,
       count(*) FILTER (WHERE route_key IS NOT NULL AND route_key NOT IN (SELECT flight_id FROM flights)) AS not_found,
       (SELECT count(*) FROM (SELECT flight_id FROM flights GROUP BY 1 HAVING count(*) > 1) d) AS duplicate_keys
FROM fact_keys"""))
def olap_11(spark, sf):
    from dwkit.plans.cube import check_dimensions
    w = build(spark, sf)
    return check_dimensions(w["fact"], [
        ("date_key", w["dim_date"], "date_key"), ("airline_key", w["dim_airline"], "airline_key"),
        ("origin_airport_key", w["dim_airport"], "airport_key"), ("route_key", w["dim_route"], "route_key")])


# ---------------------------------------------------------------------------
# Two-batch load (pipeline.run + pipeline.run_increment)
# ---------------------------------------------------------------------------

@q("pipe_1_incremental_load_by_airline_version", S.with_ctes(_SCD2, """
SELECT s.airline_key, s.carrier_code, s.carrier_name, s.is_current_record, count(*) AS flights
FROM fact f JOIN airline_scd s ON s.carrier_code = f.carrier_code
 AND s.carrier_name = CASE WHEN f.carrier_code < 'C' AND f.fl_date >= DATE '1998-01-01'
                           THEN f.carrier_name || ' (renamed)' ELSE f.carrier_name END
GROUP BY 1, 2, 3, 4"""))
def pipe_1(spark, sf):
    """Orders before 1998 are the first load, the rest a second batch in
    which carriers whose code sorts before 'C' are renamed: old fact rows
    keep the old airline version, new ones resolve to the new version."""
    from dwkit.plans.pipeline import run, run_increment
    from dwkit.sources.files import scratch_path
    w = build(spark, sf)
    base = scratch_path(spark, "pipe1")
    cut = F.col("fl_date") < F.lit("1998-01-01").cast("date")
    regions = FX.region_reference(spark, sf)
    w1 = run(spark, w["flat"].where(cut), None, regions, base + "/load1", FX.CHANGE_TS,
             unmatched_airports="default")
    w2 = run_increment(spark, w1, w["flat"].where(~cut), regions, base + "/load2", FX.CHANGE_TS,
                       carrier_names=FX.renamed_carriers(w["airline"]), unmatched_airports="default")
    counts = w2["fact_loaded"].groupBy("airline_key").agg(F.count(F.lit(1)).alias("flights"))
    return counts.join(w2["dim_airline"].select("airline_key", "carrier_code", "carrier_name", "is_current_record"),
                       "airline_key")


_TWO: dict = {}


def _complete_then_load(spark, sf):
    """Orders before 1998 loaded and completed by the feed, the rest loaded as a
    second batch, and once more with the feed; kept for the queries on it."""
    from dwkit.plans.pipeline import run, run_increment, together
    from dwkit.sources.files import scratch_path
    key = (spark.sparkContext.applicationId, sf)      # an address may belong to a later session
    if key not in _TWO:
        w, base = build(spark, sf), scratch_path(spark, "pipe2")
        cut = F.col("fl_date") < F.lit("1998-01-01").cast("date")
        regions = FX.region_reference(spark, sf)
        w1 = run(spark, w["flat"].where(cut), w["feed"], regions, base + "/load1", FX.RUN_TS, unmatched_airports="default")
        more = (w["flat"].where(~cut), regions)
        _TWO[key] = together(spark,                        # both go on from the first load, in folders of their own
            lambda: run_increment(spark, w1, *more, base + "/load2", FX.RUN_TS, unmatched_airports="default"),
            lambda: run_increment(spark, w1, *more, base + "/load3", FX.RUN_TS, unmatched_airports="default", feed=w["feed"]))
    return _TWO[key]


@q("pipe_2_load_complete_load_again", S.with_ctes(_KEYS, """
SELECT operation_id, CASE WHEN accm_txn_create_time < TIMESTAMP '1998-01-01' THEN accm_txn_complete_time END AS accm_txn_complete_time,
       CASE WHEN accm_txn_create_time < TIMESTAMP '1998-01-01' THEN txn_process_time_hours END AS txn_process_time_hours
FROM fact_keys"""))
def pipe_2(spark, sf):
    """Completions made before a second load are still there after it; the
    second batch's rows are open."""
    return _complete_then_load(spark, sf)[0]["fact"].select("operation_id", "accm_txn_complete_time", "txn_process_time_hours")


@q("pipe_2_load_complete_load_complete_again", ORACLES["acc_4_apply_completions"])
def pipe_2_again(spark, sf):
    """The same feed applied with the second batch completes its rows too."""
    return _complete_then_load(spark, sf)[1]["fact"].select("operation_id", "accm_txn_complete_time", "txn_process_time_hours")


@q("pipe_3_reconcile_after_second_load", ORACLES["dq_8_reconcile"])
def pipe_3(spark, sf):
    """Rows of both batches against the fact and its rejects."""
    w = _complete_then_load(spark, sf)[0]
    return Q.reconcile(w["flat"], w["fact_loaded"], w["fact_errors"])


@q("pipe_4_rerun_with_other_input", S.with_fact("""
SELECT CAST(year AS INTEGER) AS year, count(*) AS flights FROM fact WHERE fl_date >= DATE '1998-01-01' GROUP BY 1"""))
def pipe_4(spark, sf):
    """A folder loaded from the orders before 1998 and then from the others
    holds the others alone."""
    from dwkit.plans.pipeline import run
    from dwkit.sources.files import scratch_path
    w, out = build(spark, sf), scratch_path(spark, "pipe4")
    cut = F.col("fl_date") < F.lit("1998-01-01").cast("date")
    regions = FX.region_reference(spark, sf)
    run(spark, w["flat"].where(cut), None, regions, out, FX.RUN_TS, unmatched_airports="default")
    again = run(spark, w["flat"].where(~cut), None, regions, out, FX.RUN_TS, unmatched_airports="default")
    return (again["fact_loaded"].groupBy(F.expr("date_key div 10000").cast("int").alias("year"))
            .agg(F.count(F.lit(1)).alias("flights")))


@q("norm_1_airlines_with_names_reference", S.with_ctes(_KEYS, """
SELECT carrier_code, CASE WHEN carrier_code < 'C' THEN carrier_name || ' (renamed)' WHEN carrier_code = 'MACHINERY' THEN 'Unknown'
       ELSE carrier_name END AS carrier_name FROM carriers"""))
def norm_1_names(spark, sf):
    """Carriers named by a reference that lacks one code."""
    from dwkit.operators.normalise import airlines
    names = FX.renamed_carriers(build(spark, sf)["airline"]).where("carrier_code <> 'MACHINERY'")
    return airlines(flat(spark, sf), names)


@q("dq_12_airport_enrichment_spot_check", S.with_ctes(_KEYS, """
SELECT k.code AS airport_code, k.code AS city_name, k.code AS state_name,
       coalesce(r.region, 'Unknown') AS region, coalesce(r.region_code, 'XX') AS region_code
FROM airport_keys k LEFT JOIN regions r ON r.state_name = k.code ORDER BY k.code LIMIT 10"""))
def dq_12_airports(spark, sf):
    """First 10 airports by code with their enrichment (spot check)."""
    d = build(spark, sf)["dim_airport"].select("airport_code", "city_name", "state_name", "region", "region_code")
    return SM.top_n(d, 10, [F.col("airport_code")])


@q("dq_12_route_enrichment_spot_check", S.with_ctes(_KEYS, """
SELECT CAST(flight_id AS BIGINT) AS flight_id, carrier_code, flight_number, origin_code, dest_code, distance,
       CASE WHEN distance IS NULL THEN NULL WHEN distance < 500 THEN 'Short' WHEN distance <= 1500 THEN 'Medium'
            ELSE 'Long' END AS distance_band
FROM flights ORDER BY flight_id LIMIT 10"""))
def dq_12_routes(spark, sf):
    """First 10 routes by id with their distance band (spot check)."""
    d = build(spark, sf)["dim_route"].select("flight_id", "carrier_code", "flight_number", "origin_code",
                                            "dest_code", "distance", "distance_band")
    return SM.top_n(d, 10, [F.col("flight_id")])


@q("agg_2_fact_status_counts", S.with_fact("""
SELECT CAST(sum(1 - cancelled) AS BIGINT) AS operated, CAST(sum(cancelled) AS BIGINT) AS cancelled,
       count(*) AS total FROM fact"""))
def agg_2_fact(spark, sf):
    return A.status_counts(build(spark, sf)["fact"])


@q("dq_10_process_hours_recomputed", S.with_ctes(_KEYS, """
SELECT operation_id, txn_process_time_hours AS stored_hours,
       date_diff('minute', accm_txn_create_time, accm_txn_complete_time) / 60.0 AS recomputed,
       abs(txn_process_time_hours - date_diff('minute', accm_txn_create_time, accm_txn_complete_time) / 60.0)
         AS discrepancy
FROM fact_keys WHERE accm_txn_complete_time IS NOT NULL"""))
def dq_10(spark, sf):
    """Stored hours next to an independent recomputation for every completed
    row (the validation sampled ten rows; here all rows are shown)."""
    from dwkit.functions.dates import hours_between
    f = build(spark, sf)["fact"].where(F.col("accm_txn_complete_time").isNotNull())
    out = Q.check_recompute(f, "txn_process_time_hours",
                            hours_between("accm_txn_create_time", "accm_txn_complete_time"), eps=-1.0)
    return out.select("operation_id", F.col("txn_process_time_hours").alias("stored_hours"), "recomputed",
                      "discrepancy")


def _in_place(spark, sf):
    from dwkit.plans.warehouse import FACT_PARTITION
    from dwkit.plans.pipeline import FACT_PARTITIONS
    from dwkit.sources.files import scratch_path
    w = build(spark, sf)
    part = FACT_PARTITIONS[FACT_PARTITION]
    base = scratch_path(spark, "inplace")
    w["fact_loaded"].write.partitionBy(part).parquet(base + "/fact")
    errors = ACC.apply_completions_in_place(base + "/fact", w["feed"], part, base + "/stage", FX.RUN_TS)
    return spark.read.parquet(base + "/fact"), errors


@q("acc_4_in_place_partition_update", ORACLES["acc_4_apply_completions"])
def acc_4_in_place(spark, sf):
    """Completion update that rewrites only the touched fact partitions;
    must equal the full batch update."""
    fact, _ = _in_place(spark, sf)
    return fact.select("operation_id", "accm_txn_complete_time", "txn_process_time_hours")


@q("acc_4_in_place_errors", ORACLES["acc_4_completion_errors"])
def acc_4_in_place_errors(spark, sf):
    _, errors = _in_place(spark, sf)
    return errors


@q("olap_8_pivot_swapped_quarter_by_carrier", S.with_fact("""
SELECT CAST(quarter AS SMALLINT) AS date_quarter, """ + ", ".join(
    f"nullif(count(*) FILTER (WHERE carrier_name = 'Carrier {c}'), 0) AS \"Carrier {c}\""
    for c in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + """
FROM fact GROUP BY 1"""))
def olap_8_swapped(spark, sf):
    """The pivot with axes swapped: quarters as rows, carriers as columns,
    the carrier members discovered from the data."""
    return cube(spark, sf).pivot(["date.quarter"], "airline.carrier_name", "flights")


# ---------------------------------------------------------------------------
# Geography and calendar hierarchies, questions by route and airport, slicers
# ---------------------------------------------------------------------------

_FIVE = ["taxi_out", "taxi_in", "actual_elapsed_time", "air_time", "diverted"]


@q("olap_1_sums_of_operation_measures", S.with_fact("SELECT " + ", ".join(
    f"CAST(sum({c}) AS {'BIGINT' if c == 'diverted' else 'DOUBLE'}) AS {c}" for c in _FIVE) + " FROM fact"))
def olap_1_sums(spark, sf):
    return cube(spark, sf).summary(_FIVE)


def _geography(role: str, region: str, state: str) -> str:
    return f"""
SELECT {region} AS {role}_region, {state} AS {role}_state, {state} AS {role}_city, {state} AS {role}_airport,
       count(*) AS flights, {S.rate(S.ON_TIME, S.OPERATED)} AS on_time_rate,
       CAST({S.ON_TIME} AS BIGINT) AS on_time, CAST({S.OPERATED} AS BIGINT) AS operated"""


@q("olap_4_geography_to_airport_origin", S.with_fact(_geography("origin", "origin_region", "origin") + " FROM fact GROUP BY 1, 2"))
def olap_4_origin(spark, sf):
    return cube(spark, sf).roll_up("origin", "Geography", "airport", ["flights", "on_time_rate"])


@q("olap_5_geography_drill_dest", S.with_fact(_geography("dest", "dest_region", "dest")
                                              + " FROM fact WHERE dest_region = 'EUROPE' GROUP BY 1, 2"))
def olap_5_dest(spark, sf):
    """From city to airport within one region, in the destination role."""
    return cube(spark, sf).drill_down("dest", "Geography", "city", ["flights", "on_time_rate"], {"dest.region": "EUROPE"})


@q("rpt_4_drill_to_day_with_totals", S.with_fact(f"""
SELECT year AS date_year, quarter AS date_quarter,
       CASE WHEN GROUPING(quarter) = 1 THEN NULL ELSE max({_QN}) END AS date_quarter_name, month AS date_month,
       CASE WHEN GROUPING(month) = 1 THEN NULL ELSE max(monthname(fl_date)) END AS date_month_name, fl_date AS date_day,
       count(*) AS flights, CAST(GROUPING(year, quarter, month, fl_date) AS BIGINT) AS grouping_id
FROM fact WHERE carrier_code = 'FURNITURE' GROUP BY ROLLUP (year, quarter, month, fl_date)"""))
def rpt_4_day(spark, sf):
    out = R.drill_table(cube(spark, sf), "date", "Calendar", "day", ["flights"], {"airline.carrier": "FURNITURE"})
    return out.withColumn("grouping_id", F.col("grouping_id").cast("long"))


@q("rpt_11_dominant_cause_by_route_quarter", S.with_fact(f"""
SELECT origin, dest, quarter, {_PICK} AS dominant_cause, {_DOM} AS minutes FROM (
  SELECT origin, dest, CAST(quarter AS INTEGER) AS quarter, {", ".join(f"CAST(sum({p}) AS BIGINT) AS s_{p}" for p in S.PARTS)}
  FROM fact GROUP BY 1, 2, 3) t"""))
def rpt_11_route_cause(spark, sf):
    f = cube(spark, sf).frame(["origin.airport", "dest.airport", "date.quarter"])
    f = f.withColumns({"origin": F.col("origin_airport_code"), "dest": F.col("dest_airport_code"),
                       "quarter": F.col("date_quarter").cast("int")})
    return R.dominant_cause(f, ["origin", "dest", "quarter"])


@q("rpt_11_riskiest_origin_airports", S.with_fact(f"""
SELECT origin, {S.headline_sql()} FROM fact GROUP BY 1 ORDER BY cancellation_rate DESC NULLS LAST, origin LIMIT 10"""))
def rpt_11_airports(spark, sf):
    f = cube(spark, sf).frame(["origin.airport"]).withColumnRenamed("origin_airport_code", "origin")
    return R.riskiest(f, ["origin"], 10)


@q("olap_13_members_under_filters_of_other_dimensions", S.with_fact("""
SELECT DISTINCT origin AS origin_state FROM fact WHERE carrier_code = 'BUILDING' AND year = 1997 AND origin_region = 'EUROPE'"""))
def olap_13_across(spark, sf):
    return cube(spark, sf).members("origin.state", {"airline.carrier": "BUILDING", "date.year": 1997, "origin.region": "EUROPE"})


# ---------------------------------------------------------------------------
# Sources and sinks on the given tables (SRC-3, SRC-4, SRC-6 to SRC-9), second loads (SCD-2, SCD-3)
# ---------------------------------------------------------------------------

@q("src_3_typed_completion_feed", "SELECT l_orderkey AS operation_id, CAST(l_shipdate AS TIMESTAMP) AS accm_txn_complete_time FROM lineitem")
def src_3(spark, sf):
    """The feed written as CSV text and read with the declared schema."""
    from dwkit.sources.files import read_csv, scratch_path
    from dwkit.sources.reference import COMPLETION_SCHEMA
    path = scratch_path(spark, "src3")
    (FX.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("operation_id"),
                                            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("accm_txn_complete_time"))
     .write.option("header", True).csv(path))
    return read_csv(spark, path, COMPLETION_SCHEMA, timestamp_format="yyyy-MM-dd HH:mm:ss")


@q("src_4_newest_version_and_command", """
SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1""")
def src_4(spark, sf):
    """A table in two versions read back as the newest, then through a SQL command."""
    from dwkit.sources.files import read_table, scratch_path, write_version
    path, orders = scratch_path(spark, "src4"), FX.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    write_version(orders, path)
    write_version(orders.where("o_orderkey % 2 = 0"), path)
    read_table(spark, path).createOrReplaceTempView("src_4_orders")
    return read_table(spark, "", sql="SELECT o_orderstatus, count(*) AS orders FROM src_4_orders GROUP BY 1")


@q("src_6_length_limits", """
SELECT p_partkey, p_brand, p_type FROM part""")
def src_6(spark, sf):
    """Conversion with limits that all parts keep; a longer text would fail the job."""
    from dwkit.sources.files import convert_types
    return convert_types(FX.table(spark, sf, "part").select("p_partkey", "p_brand", "p_type"),
                         {"p_brand": ("string", 20), "p_type": ("string", 60)})


@q("src_7_refresh_and_append", """
SELECT o_orderstatus, count(*) AS orders FROM (
  SELECT o_orderstatus FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderstatus FROM orders WHERE o_orderstatus = 'P') x
GROUP BY 1""")
def src_7(spark, sf):
    """Staged rows are replaced by a refresh (SRC-7), then added to (SRC-8)."""
    from dwkit.sources.files import append, refresh, scratch_path
    path, orders = scratch_path(spark, "src7"), FX.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    refresh(orders, path)
    refresh(orders.where("o_orderstatus <> 'P'"), path)
    append(orders.where("o_orderstatus = 'P'"), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@q("src_9_quarantined_orders", """
SELECT 'orders' AS source_table, CAST(9 AS INTEGER) AS error_code, 'no line' AS error_description, CAST(o_orderkey AS VARCHAR) AS raw_row,
       TIMESTAMP '2025-01-01 00:00:00' AS captured_at
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def src_9(spark, sf):
    """Orders without lines appended to an error table with code and reason."""
    from dwkit.sources.files import quarantine, scratch_path
    path = scratch_path(spark, "src9")
    bad = J.orphans(FX.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", FX.table(spark, sf, "lineitem"), "l_orderkey")
    quarantine(Q.as_error_rows(bad, "orders", 9, "no line", ["o_orderkey"], FX.RUN_TS), path)
    return spark.read.parquet(path)


@q("scd_2_second_load_of_routes", S.with_ctes(_KEYS, """
SELECT CAST(flight_id AS BIGINT) AS route_key, CAST(flight_id AS BIGINT) AS flight_id, carrier_code, flight_number, origin_code, dest_code,
       distance + CASE WHEN flight_id % 3 = 0 THEN 1000 ELSE 0 END AS distance,
       CASE WHEN distance IS NULL THEN NULL
            WHEN distance + CASE WHEN flight_id % 3 = 0 THEN 1000 ELSE 0 END < 500 THEN 'Short'
            WHEN distance + CASE WHEN flight_id % 3 = 0 THEN 1000 ELSE 0 END <= 1500 THEN 'Medium' ELSE 'Long' END AS distance_band
FROM flights"""))
def scd_2(spark, sf):
    """Routes merged a second time: every third flight is 1,000 longer, and the
    batch brings only those; the rest stay as they are."""
    w = build(spark, sf)
    longer = w["flight"].where("flight_id % 3 = 0").withColumn("distance", F.col("distance") + 1000)
    return D.route_dim(w["dim_route"], longer)


@q("scd_3_second_load_of_reasons", """
SELECT CAST(k AS INTEGER) AS cancellation_key, code AS cancellation_code, n AS flights FROM (
  SELECT code, n, row_number() OVER (ORDER BY code) + 4 AS k FROM (
    SELECT 'X' || substr(o_orderpriority, 1, 1) AS code, count(*) AS n FROM orders GROUP BY 1) x) y""")
def scd_3(spark, sf):
    """A sheet of further reasons (the order priorities) merged after the seeded
    ones: new codes get the next keys."""
    orders = FX.table(spark, sf, "orders").groupBy(F.concat(F.lit("X"), F.substring("o_orderpriority", 1, 1)).alias("cancellation_code")) \
        .agg(F.count(F.lit(1)).alias("flights"))
    sheet = orders.select("cancellation_code", F.lit("from orders").alias("reason_description"),
                          F.lit("Carrier").alias("responsible_party"), F.lit("No").alias("compensation_eligibility"))
    dim = D.reason_dim(spark, D.reason_dim(spark), sheet)
    return (dim.select(F.col("cancellation_key").cast("int").alias("cancellation_key"), "cancellation_code")
            .join(orders, "cancellation_code"))


@q("prj_6_defaults_and_casts", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2)) AS price, CAST(o_orderdate AS DATE) + 7 AS due,
       coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority FROM orders""")
def prj_6(spark, sf):
    """Null-to-default (PRJ-6), days added to a date (FN-4), casts and text to null (FN-11)."""
    return FX.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.date_add(F.col("o_orderdate").cast("date"), 7).alias("due"),
        F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("none")).alias("priority"))


@q("dim_1_holiday_flags_of_event_days", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       d IN (DATE '2024-01-01', DATE '2024-01-15', DATE '2024-02-19', DATE '2024-05-27', DATE '2024-06-19', DATE '2024-07-04',
             DATE '2024-09-02', DATE '2024-10-14', DATE '2024-11-11', DATE '2024-11-28', DATE '2024-12-25') AS is_public_holiday,
       n AS events
FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) x""")
def dim_1_holidays(spark, sf):
    """Calendar of the event days with their holiday flags and events."""
    events = FX.table(spark, sf, "events")
    days = D.date_dim_for(events, "ts", US_FEDERAL_HOLIDAYS_2024).select("date_key", "full_date", "is_public_holiday")
    n = events.groupBy(F.col("ts").cast("date").alias("full_date")).agg(F.count(F.lit(1)).alias("events"))
    return days.join(n, "full_date")
