"""Registered queries: positions of a sorted result, reference sheets as data, process time by flight type."""

from __future__ import annotations

from pyspark.sql import functions as F

from dwkit.operators import aggregates as A
from dwkit.operators import joins as J
from dwkit.operators.windows import with_surrogate
from dwkit.plans import catalog_sql as S
from dwkit.plans.catalog import cube, q
from dwkit.plans.fixtures import table
from dwkit.plans.warehouse import build
from dwkit.sources.reference import REASON_ROWS, REGION_CODES, US_STATE_REGIONS, us_region_reference


@q("sort_1_positions_by_delay", S.with_fact("""
SELECT operation_id, arr_delay, row_number() OVER (ORDER BY arr_delay DESC NULLS LAST, operation_id) AS position FROM fact"""))
def sort_1(spark, sf):
    """The whole fact by arrival delay, worst first, each row with its position in that order (SORT-1)."""
    rows = build(spark, sf)["fact"].select("operation_id", "arr_delay")
    return with_surrogate(rows, "position", [F.col("arr_delay").desc_nulls_last(), F.col("operation_id")])


@q("sort_1_calendar_drill_positions", S.with_fact("""
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, count(*) AS flights, row_number() OVER (ORDER BY year, month) AS position
FROM fact GROUP BY year, month"""))
def sort_1_drill(spark, sf):
    """A drill-down by month in calendar order, with each row's position."""
    months = cube(spark, sf).query(["date.year", "date.month"], ["flights"]).select(
        F.col("date_year").cast("int").alias("year"), F.col("date_month").cast("int").alias("month"), "flights")
    return with_surrogate(months, "position", ["year", "month"])


@q("agg_5_process_hours_by_flight_type", S.with_fact("""
SELECT distance_band, count(*) AS completed, CAST(CAST(avg(process_hours) AS DECIMAL(10,2)) AS DOUBLE) AS avg_hours,
       CAST(CAST(min(process_hours) AS DECIMAL(10,2)) AS DOUBLE) AS min_hours, CAST(CAST(max(process_hours) AS DECIMAL(10,2)) AS DOUBLE) AS max_hours
FROM fact WHERE process_hours IS NOT NULL GROUP BY 1"""))
def agg_5_type(spark, sf):
    """How long the processing of a flight takes, by its distance band."""
    f = cube(spark, sf).frame(["route.distance_band"]).withColumnRenamed("route_distance_band", "distance_band")
    return A.process_time_by(f, ["distance_band"]).withColumns({c: F.col(c).cast("double") for c in ("avg_hours", "min_hours", "max_hours")})


def _quoted(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


_REASONS = "(VALUES " + ", ".join(f"({', '.join(map(_quoted, r))})" for r in REASON_ROWS) + ") r(cancellation_key, code, description, party, compensation)"


@q("dim_5_reason_texts_of_cancelled", S.with_fact(f"""
SELECT r.description AS reason_description, r.party AS responsible_party, r.compensation AS compensation_eligibility, count(*) AS flights
FROM fact JOIN {_REASONS} ON r.code = cancellation_code_clean GROUP BY ALL"""))
def dim_5_texts(spark, sf):
    """Flights by the reason's texts, as the built-in sheet has them."""
    w = build(spark, sf)
    return J.star(w["fact"], [(w["dim_reason"], "cancellation_key")], broadcast=True).groupBy(
        "reason_description", "responsible_party", "compensation_eligibility").agg(F.count(F.lit(1)).alias("flights"))


_STATES = sorted(US_STATE_REGIONS)
_SHEET = "(VALUES " + ", ".join(f"({i}, {_quoted(s)}, {_quoted(US_STATE_REGIONS[s])}, {_quoted(REGION_CODES[US_STATE_REGIONS[s]])})"
                                for i, s in enumerate(_STATES)) + ") s(i, state_name, region, region_code)"


@q("src_5_suppliers_by_us_region", f"""
SELECT s.state_name, s.region, s.region_code, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance
FROM supplier JOIN {_SHEET} ON s.i = s_suppkey % {len(_STATES)} GROUP BY ALL""")
def src_5(spark, sf):
    """The built-in sheet of states looked up for suppliers, who are given states in turn by their keys."""
    names = F.array(*map(F.lit, _STATES))
    placed = table(spark, sf, "supplier").select("s_acctbal", F.get(names, (F.col("s_suppkey") % len(_STATES)).cast("int")).alias("state_name"))
    matched, _ = J.lookup(placed, us_region_reference(spark), ["state_name"], ["region", "region_code"])
    return matched.groupBy("state_name", "region", "region_code").agg(F.count(F.lit(1)).alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))
