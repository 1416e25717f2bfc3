"""Oracle SQL building blocks (DuckDB dialect) for the registered queries.

The oracle recomputes each answer from the driver's raw tables with plain
SQL (window ``row_number`` where the Spark side uses partial aggregation,
``generate_series`` for the calendar, and so on), so agreement checks the
Spark plans end to end, not just the last step.
"""

from __future__ import annotations

PARTS = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]

FLAT_CTE = """
fl AS (
  SELECT l_orderkey, l_partkey AS first_partkey, l_suppkey AS first_suppkey, l_shipdate AS first_ship,
    l_linenumber AS first_number, l_quantity AS first_quantity, l_returnflag AS first_flag
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber,
               l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
        FROM lineitem) t
  WHERE rn = 1),
la AS (
  SELECT l_orderkey, min(l_shipdate) AS min_ship, max(l_shipdate) AS max_ship,
    CAST(coalesce(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0) AS BIGINT) AS carrier_delay,
    CAST(coalesce(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 0) AS BIGINT) AS weather_delay,
    CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS BIGINT) AS nas_delay,
    CAST(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 0) AS BIGINT) AS security_delay,
    CAST(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 0) AS BIGINT) AS late_aircraft_delay
  FROM lineitem GROUP BY l_orderkey),
flat AS (
  SELECT o.o_orderkey AS operation_id, CAST(o.o_orderdate AS DATE) AS fl_date,
    c.c_mktsegment AS carrier_code, 'Carrier ' || c.c_mktsegment AS carrier_name,
    CAST(fl.first_partkey AS BIGINT) AS flight_number,
    cn.n_name AS origin, sn.n_name AS dest,
    CAST(p.p_size * 100 AS DOUBLE) AS distance,
    CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END AS cancelled,
    CASE WHEN o.o_orderstatus = 'P' THEN CASE substr(o.o_orderpriority, 1, 1)
         WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C' WHEN '4' THEN 'D' END END AS cancellation_code,
    CASE WHEN o.o_orderstatus <> 'P'
         THEN CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(la.min_ship AS DATE)) AS DOUBLE) END AS dep_delay,
    CASE WHEN o.o_orderstatus <> 'P'
         THEN CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(fl.first_ship AS DATE)) AS DOUBLE) END AS arr_delay,
    CASE WHEN o.o_orderstatus <> 'P' THEN CAST(fl.first_number AS DOUBLE) END AS taxi_out,
    CASE WHEN o.o_orderstatus <> 'P' THEN fl.first_quantity END AS taxi_in,
    CASE WHEN o.o_orderstatus <> 'P' THEN fl.first_quantity * 6 + fl.first_number END AS actual_elapsed_time,
    CASE WHEN o.o_orderstatus <> 'P' THEN fl.first_quantity * 5 END AS air_time,
    CASE WHEN o.o_orderstatus <> 'P' AND fl.first_flag = 'R' THEN 1 ELSE 0 END AS diverted,
    coalesce(la.carrier_delay, 0) AS carrier_delay, coalesce(la.weather_delay, 0) AS weather_delay,
    coalesce(la.nas_delay, 0) AS nas_delay, coalesce(la.security_delay, 0) AS security_delay,
    coalesce(la.late_aircraft_delay, 0) AS late_aircraft_delay,
    la.max_ship AS last_ship, CAST(fl.first_ship AS TIMESTAMP) AS first_ship
  FROM orders o
  LEFT JOIN la ON la.l_orderkey = o.o_orderkey
  LEFT JOIN fl ON fl.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
  LEFT JOIN supplier s ON s.s_suppkey = fl.first_suppkey
  LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey
  LEFT JOIN part p ON p.p_partkey = fl.first_partkey),
regions AS (
  SELECT n.n_name AS state_name, r.r_name AS region, upper(substr(r.r_name, 1, 2)) AS region_code
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'MIDDLE EAST'),
fact AS (
  SELECT f.operation_id, f.fl_date, f.carrier_code, f.carrier_name, f.flight_number, f.origin, f.dest,
    f.distance, f.cancelled, f.dep_delay, f.arr_delay, f.taxi_out, f.taxi_in, f.actual_elapsed_time, f.air_time, f.diverted,
    CASE WHEN f.cancelled = 0 THEN f.carrier_delay ELSE 0 END AS carrier_delay,
    CASE WHEN f.cancelled = 0 THEN f.weather_delay ELSE 0 END AS weather_delay,
    CASE WHEN f.cancelled = 0 THEN f.nas_delay ELSE 0 END AS nas_delay,
    CASE WHEN f.cancelled = 0 THEN f.security_delay ELSE 0 END AS security_delay,
    CASE WHEN f.cancelled = 0 THEN f.late_aircraft_delay ELSE 0 END AS late_aircraft_delay,
    CASE WHEN f.cancelled = 0 THEN f.carrier_delay + f.weather_delay + f.nas_delay + f.security_delay
         + f.late_aircraft_delay ELSE 0 END AS total_delay_minutes,
    coalesce(ro.region, 'Unknown') AS origin_region, coalesce(ro.region_code, 'XX') AS origin_region_code,
    coalesce(rd.region, 'Unknown') AS dest_region,
    CASE WHEN f.cancelled = 0 THEN 'N/A' ELSE coalesce(f.cancellation_code, 'A') END AS cancellation_code_clean,
    CAST(f.fl_date AS TIMESTAMP) AS create_time, CAST(f.last_ship AS TIMESTAMP) AS complete_time,
    CASE WHEN f.last_ship IS NOT NULL THEN date_diff('minute', date_trunc('minute', CAST(f.fl_date AS TIMESTAMP)),
         date_trunc('minute', CAST(f.last_ship AS TIMESTAMP))) / 60.0 END AS process_hours,
    CASE WHEN f.distance IS NULL THEN NULL WHEN f.distance < 500 THEN 'Short'
         WHEN f.distance <= 1500 THEN 'Medium' ELSE 'Long' END AS distance_band,
    CAST(year(f.fl_date) AS SMALLINT) AS year, CAST(quarter(f.fl_date) AS SMALLINT) AS quarter,
    CAST(month(f.fl_date) AS SMALLINT) AS month
  FROM flat f
  LEFT JOIN regions ro ON ro.state_name = f.origin
  LEFT JOIN regions rd ON rd.state_name = f.dest
  WHERE f.dest IS NOT NULL AND f.origin IS NOT NULL AND f.carrier_code IS NOT NULL)
"""


def with_fact(select: str) -> str:
    """``WITH <flat, fact ctes> <select>``."""
    return "WITH " + FLAT_CTE.strip() + "\n" + select


def with_ctes(extra: str, select: str) -> str:
    """Base ctes plus more ctes (``extra`` starts with ``, name AS (...)``)."""
    return "WITH " + FLAT_CTE.strip() + extra + "\n" + select


ON_TIME = "sum(CASE WHEN cancelled = 0 AND coalesce(arr_delay, 0) <= 0 THEN 1 ELSE 0 END)"
OPERATED = "sum(CASE WHEN cancelled = 0 THEN 1 ELSE 0 END)"


def rate(num: str, den: str) -> str:
    return f"round(coalesce(CAST({num} AS DOUBLE) * 100.0 / nullif(CAST({den} AS DOUBLE), 0), 0.0), 4)"


def headline_sql() -> str:
    return (f"count(*) AS flights, CAST({OPERATED} AS BIGINT) AS operated, "
            f"CAST(sum(cancelled) AS BIGINT) AS cancelled, CAST({ON_TIME} AS BIGINT) AS on_time, "
            f"{rate(ON_TIME, OPERATED)} AS on_time_rate, {rate('sum(cancelled)', 'count(*)')} AS cancellation_rate, "
            f"round(avg(CASE WHEN cancelled = 0 THEN arr_delay END), 4) AS avg_arr_delay")
