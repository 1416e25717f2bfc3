"""The driver's tables playing the warehouse roles (FIXTURES.md part B).

| role | built from |
|---|---|
| operation (grain) | one ``orders`` row, ``operation_id = o_orderkey`` |
| event date | ``cast(o_orderdate as date)`` |
| carrier | ``c_mktsegment`` |
| origin / destination airport | customer's nation / first line's supplier's nation |
| route, distance | first line's ``l_partkey``; ``p_size * 100`` |
| cancelled | ``o_orderstatus = 'P'`` |
| cancellation code | priority digit 1-4 -> A-D, 5 -> null, on cancelled rows |
| arrival delay | days from order date to first line's ship date (null if cancelled / no lines) |
| departure delay | days from order date to the earliest ship date (same nulls) |
| delay parts | ``l_quantity`` summed by return flag A / N / R and line status O / F |
| completion feed | (``l_orderkey``, ``l_shipdate``) plus 500 ids after the largest order key |
| region reference | nation -> region without MIDDLE EAST (lookup misses) |

The "first line" of an order is its lineitem row that sorts first on all
columns.  All per-order lineitem facts come from **one** grouped aggregate
(``min`` of a struct plus conditional sums), which Spark combines map-side:
an order holding a third of all lines still costs one partial row per task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.functions.dates import ts_lit

LINE_ORDER = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
# Fixed fixture parameters.
UNKNOWN_IDS = 500
UNKNOWN_TIME = _dt.datetime(2002, 1, 1)
REGION_HOLE = "MIDDLE EAST"
RUN_TS = _dt.datetime(2025, 1, 1)
CHANGE_TS = _dt.datetime(1998, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Per order: first line (all its columns), earliest ship date and the
    five delay parts, from one grouped aggregate."""
    q = F.col("l_quantity")
    part = lambda cond: F.coalesce(F.sum(F.when(cond, q)), F.lit(0.0)).cast("long")
    return lineitem.groupBy("l_orderkey").agg(
        F.min(F.struct(*LINE_ORDER)).alias("first"),
        F.min("l_shipdate").alias("min_ship"),
        part(F.col("l_returnflag") == "A").alias("carrier_delay"),
        part(F.col("l_returnflag") == "N").alias("weather_delay"),
        part(F.col("l_returnflag") == "R").alias("nas_delay"),
        part(F.col("l_linestatus") == "O").alias("security_delay"),
        part(F.col("l_linestatus") == "F").alias("late_aircraft_delay"),
    ).select("l_orderkey", "min_ship", "carrier_delay", "weather_delay", "nas_delay", "security_delay",
             "late_aircraft_delay", F.col("first.l_partkey").alias("first_partkey"),
             F.col("first.l_suppkey").alias("first_suppkey"), F.col("first.l_shipdate").alias("first_ship"),
             F.col("first.l_linenumber").alias("first_number"), F.col("first.l_quantity").alias("first_quantity"),
             F.col("first.l_returnflag").alias("first_flag"))


def flat_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat table in the source layout (orders x customer x nation x first line)."""
    t = lambda n: table(spark, sf_dir, n)
    orders, customer, nation = t("orders"), t("customer"), t("nation")
    supplier, part = t("supplier"), t("part")
    lines = order_lines(t("lineitem"))
    # nation (25 rows) is bounded by definition; customer, supplier and
    # part grow with the data and are left to the planner / AQE.
    cn = F.broadcast(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("origin")))
    sn = F.broadcast(nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("dest")))
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(cn, "c_nationkey", "left")
    supp = supplier.select(F.col("s_suppkey").alias("first_suppkey"), "s_nationkey").join(sn, "s_nationkey", "left")
    prt = part.select(F.col("p_partkey").alias("first_partkey"), "p_size")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    # customers come first: when they are too many to broadcast, the join moves
    # the five columns of an order, not those with all facts of its lines.
    j = (o.join(cust, o.o_custkey == cust.c_custkey, "left").drop("o_custkey", "c_custkey", "c_nationkey")
         .join(lines, o.o_orderkey == lines.l_orderkey, "left")
         .join(supp, "first_suppkey", "left")
         .join(prt, "first_partkey", "left"))
    d = F.col("o_orderdate").cast("date")
    cancelled = (F.col("o_orderstatus") == "P")
    digit = F.substring("o_orderpriority", 1, 1)
    code = (F.when(digit == "1", "A").when(digit == "2", "B").when(digit == "3", "C").when(digit == "4", "D"))
    delay = lambda ship: F.when(~cancelled, F.datediff(F.col(ship).cast("date"), d).cast("double"))
    operated = lambda v: F.when(~cancelled, v)
    return j.select(
        F.col("o_orderkey").alias("operation_id"),
        F.year(d).cast("short").alias("year"), F.month(d).cast("byte").alias("month"),
        F.dayofmonth(d).cast("byte").alias("day_of_month"), F.dayofweek(d).cast("byte").alias("day_of_week"),
        d.alias("fl_date"),
        F.col("c_mktsegment").alias("op_unique_carrier"),
        F.concat(F.lit("Carrier "), F.col("c_mktsegment")).alias("carrier_name"),
        F.col("first_partkey").alias("op_carrier_fl_num"),
        F.col("origin"), F.col("origin").alias("origin_city_name"), F.col("origin").alias("origin_state_nm"),
        F.col("dest"), F.col("dest").alias("dest_city_name"), F.col("dest").alias("dest_state_nm"),
        delay("min_ship").alias("dep_delay"),
        delay("first_ship").alias("arr_delay"),
        operated(F.col("first_number").cast("double")).alias("taxi_out"),
        operated(F.col("first_quantity")).alias("taxi_in"),
        operated(F.col("first_quantity") * 6 + F.col("first_number")).alias("actual_elapsed_time"),
        operated(F.col("first_quantity") * 5).alias("air_time"),
        F.coalesce(~cancelled & (F.col("first_flag") == "R"), F.lit(False)).cast("byte").alias("diverted"),
        cancelled.cast("byte").alias("cancelled"),
        F.when(cancelled, code).alias("cancellation_code"),
        (F.col("p_size") * 100).cast("double").alias("distance"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in
          ("carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay")],
        F.col("first_ship").cast("timestamp_ntz").alias("first_ship"),
    )


def completion_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(operation_id, completion time) with natural duplicates, plus
    ``UNKNOWN_IDS`` ids after the largest order key (fault injection)."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    feed = li.select(F.col("l_orderkey").alias("operation_id"),
                     F.col("l_shipdate").cast("timestamp_ntz").alias("accm_txn_complete_time"))
    top = orders.select(F.max("o_orderkey")).scalar()
    extra = spark.range(1, UNKNOWN_IDS + 1).select(
        (F.col("id") + top).alias("operation_id"),
        ts_lit(UNKNOWN_TIME).alias("accm_txn_complete_time"))
    return feed.unionByName(extra)


def region_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region, with the MIDDLE EAST hole."""
    from dwkit.operators.dims import region_reference_from
    return region_reference_from(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"), [REGION_HOLE])


def renamed_carriers(airlines: DataFrame) -> DataFrame:
    """Second airline batch for the SCD2 fixture: carriers whose code sorts
    before 'C' get a new name; the others arrive unchanged."""
    return airlines.select(
        "carrier_code",
        F.when(F.col("carrier_code") < "C", F.concat(F.col("carrier_name"), F.lit(" (renamed)")))
        .otherwise(F.col("carrier_name")).alias("carrier_name"))
