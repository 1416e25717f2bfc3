"""A cube over the warehouse tables (OLAP-1..OLAP-3).

Six dimensions (date, airline, origin and destination airport as two roles
of one table, route, cancellation reason), the additive measures of the
fact, derived ratios and the completion KPI.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.functions.expr import safe_divide
from dwkit.plans.cube import Attribute, CubeModel, Derived, Dimension, Hierarchy, Kpi, Measure, Role

SUM_COLUMNS = ["arr_delay", "dep_delay", "taxi_out", "taxi_in", "actual_elapsed_time", "air_time", "distance",
               "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
               "total_delay_minutes", "cancelled", "diverted", "txn_process_time_hours"]


def _ratio(num: str, den: str, scale: float = 100.0):
    return lambda: F.round(safe_divide(F.col(num) * F.lit(scale), F.col(den), 0.0), 4)


def flight_cube(tables: dict[str, DataFrame]) -> CubeModel:
    fact = tables["fact"]
    date = Dimension("date", tables["dim_date"], "date_key", (
        Attribute("year", "year"), Attribute("quarter", "quarter", "quarter_name"),
        Attribute("month", "month", "month_name", "month"), Attribute("day", "full_date"),
        Attribute("month_year", "month_year"), Attribute("day_name", "day_name"),
        Attribute("is_weekend", "is_weekend"), Attribute("is_public_holiday", "is_public_holiday"),
    ), (Hierarchy("Calendar", ("year", "quarter", "month", "day")),), bounded=True)
    airline = Dimension("airline", tables["dim_airline"], "airline_key", (
        Attribute("carrier", "carrier_code", "carrier_name"), Attribute("carrier_name", "carrier_name"),
    ))
    airport = Dimension("airport", tables["dim_airport"], "airport_key", (
        Attribute("region", "region"), Attribute("region_code", "region_code"),
        Attribute("state", "state_name"), Attribute("city", "city_name"), Attribute("airport", "airport_code"),
    ), (Hierarchy("Geography", ("region", "state", "city", "airport")),))
    route = Dimension("route", tables["dim_route"], "route_key", (
        Attribute("distance_band", "distance_band"), Attribute("flight_number", "flight_number"),
        Attribute("route", "flight_id"), Attribute("origin_code", "origin_code"),
        Attribute("dest_code", "dest_code"),
    ), grows=True)
    reason = Dimension("reason", tables["dim_reason"], "cancellation_key", (
        Attribute("code", "cancellation_code", "reason_description"),
        Attribute("party", "responsible_party"),
    ), bounded=True)
    roles = [Role("date", date, "date_key", (("month_key", "month_key"), ("year", "year"))), Role("airline", airline, "airline_key"),
             Role("origin", airport, "origin_airport_key"), Role("dest", airport, "dest_airport_key"),
             Role("route", route, "route_key"), Role("reason", reason, "cancellation_key")]
    measures = [Measure(c, "sum", c) for c in SUM_COLUMNS if c in fact.columns]
    measures += [
        Measure("flights", "count"),
        Measure("operated", "count_if", condition=F.col("cancelled") == 0),
        Measure("on_time", "count_if",
                condition=(F.col("cancelled") == 0) & (F.coalesce(F.col("arr_delay"), F.lit(0.0)) <= 0)),
        Measure("completed", "count_nonnull", "accm_txn_complete_time"),
        Measure("arr_delay_operated", "sum", "arr_delay_operated"),
        Measure("arr_delay_operated_n", "count_nonnull", "arr_delay_operated"),
    ]
    derived = [
        Derived("on_time_rate", ("on_time", "operated"), _ratio("on_time", "operated")),
        Derived("cancellation_rate", ("cancelled", "flights"), _ratio("cancelled", "flights")),
        Derived("completion_rate", ("operated", "flights"), _ratio("operated", "flights")),
        Derived("avg_arr_delay", ("arr_delay_operated", "arr_delay_operated_n"),
                lambda: F.round(F.try_divide(F.col("arr_delay_operated"), F.col("arr_delay_operated_n")), 4)),
        Derived("avg_process_hours", ("txn_process_time_hours", "completed"),
                lambda: F.round(F.try_divide(F.col("txn_process_time_hours"), F.col("completed")), 4)),
    ]
    kpis = [Kpi("On-Time Performance Rate", "operated", "flights")]
    fact = fact.withColumn("arr_delay_operated", F.when(F.col("cancelled") == 0, F.col("arr_delay")))
    return CubeModel(fact, roles, measures, derived, kpis)
