"""Reference data, declared schemas and seed rows (SRC-5, SRC-11, DIM-4).

Values here are fixed: they must equal the warehouse's so lookups resolve
the same way.  They are small by construction (tens of rows), which is why
joins against them may always be broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Declared schemas (no inference anywhere).
# ---------------------------------------------------------------------------

FLAT_SCHEMA = T.StructType([
    T.StructField("year", T.ShortType()), T.StructField("month", T.ByteType()),
    T.StructField("day_of_month", T.ByteType()), T.StructField("day_of_week", T.ByteType()),
    T.StructField("fl_date", T.DateType()), T.StructField("op_unique_carrier", T.StringType()),
    T.StructField("op_carrier_fl_num", T.IntegerType()), T.StructField("origin", T.StringType()),
    T.StructField("origin_city_name", T.StringType()), T.StructField("origin_state_nm", T.StringType()),
    T.StructField("dest", T.StringType()), T.StructField("dest_city_name", T.StringType()),
    T.StructField("dest_state_nm", T.StringType()), T.StructField("crs_dep_time", T.ShortType()),
    T.StructField("dep_time", T.DoubleType()), T.StructField("dep_delay", T.DoubleType()),
    T.StructField("taxi_out", T.DoubleType()), T.StructField("wheels_off", T.DoubleType()),
    T.StructField("wheels_on", T.DoubleType()), T.StructField("taxi_in", T.DoubleType()),
    T.StructField("crs_arr_time", T.ShortType()), T.StructField("arr_time", T.DoubleType()),
    T.StructField("arr_delay", T.DoubleType()), T.StructField("cancelled", T.ByteType()),
    T.StructField("cancellation_code", T.StringType()), T.StructField("diverted", T.ByteType()),
    T.StructField("crs_elapsed_time", T.DoubleType()), T.StructField("actual_elapsed_time", T.DoubleType()),
    T.StructField("air_time", T.DoubleType()), T.StructField("distance", T.DoubleType()),
    T.StructField("carrier_delay", T.ShortType()), T.StructField("weather_delay", T.ShortType()),
    T.StructField("nas_delay", T.ShortType()), T.StructField("security_delay", T.ShortType()),
    T.StructField("late_aircraft_delay", T.ShortType()),
])

COMPLETION_SCHEMA = T.StructType([
    T.StructField("operation_id", T.LongType()),
    T.StructField("accm_txn_complete_time", T.TimestampNTZType()),
])

ERROR_SCHEMA = T.StructType([
    T.StructField("source_table", T.StringType()), T.StructField("error_code", T.IntegerType()),
    T.StructField("error_description", T.StringType()), T.StructField("raw_row", T.StringType()),
    T.StructField("captured_at", T.TimestampNTZType()),
])

# Names of the source checks, as in the quality report.
CHECK_NAMES = (
    "Cancelled flights with non-null dep_time",
    "Operated flights missing dep_time",
    "Cancelled flights with non-zero delay components",
    "dep_delay ↔ arr_delay Pearson correlation",
    "Cancelled flights with actual_elapsed_time",
    "Earliest fl_date",
    "Latest fl_date",
    "Months covered",
)

DELAY_PARTS = ("carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay")

# ---------------------------------------------------------------------------
# Cancellation reasons, as seeded in the warehouse dimension
# (key 0 is the "not cancelled" default member, A-D are keys 1-4).
# ---------------------------------------------------------------------------

REASON_ROWS = [
    (0, "N/A", "Flight operated — not cancelled", "N/A", "N/A"),
    (1, "A", "Carrier — airline-controllable (mechanical, crew, etc.)",
     "Airline", "Yes — DOT 14 CFR 250 rebooking/refund obligation"),
    (2, "B", "Weather — meteorological conditions beyond airline control",
     "External/Weather", "No — force majeure, airline not liable"),
    (3, "C", "National Air System — NAS/ATC traffic or airport operations",
     "FAA/NAS", "Case by case — depends on ATC fault determination"),
    (4, "D", "Security — TSA screening failure or aircraft security breach",
     "TSA/Airport", "Case by case — depends on prior notice to airline"),
]
REASON_COLUMNS = ["cancellation_key", "cancellation_code", "reason_description",
                  "responsible_party", "compensation_eligibility"]

# ---------------------------------------------------------------------------
# US state -> census region, region -> two-letter code,
# default code for an unknown region.
# ---------------------------------------------------------------------------

US_STATE_REGIONS = {
    "Connecticut": "Northeast", "Maine": "Northeast", "Massachusetts": "Northeast",
    "New Hampshire": "Northeast", "Rhode Island": "Northeast", "Vermont": "Northeast",
    "New Jersey": "Northeast", "New York": "Northeast", "Pennsylvania": "Northeast",
    "Illinois": "Midwest", "Indiana": "Midwest", "Michigan": "Midwest", "Ohio": "Midwest",
    "Wisconsin": "Midwest", "Iowa": "Midwest", "Kansas": "Midwest", "Minnesota": "Midwest",
    "Missouri": "Midwest", "Nebraska": "Midwest", "North Dakota": "Midwest",
    "South Dakota": "Midwest",
    "Delaware": "South", "Florida": "South", "Georgia": "South", "Maryland": "South",
    "North Carolina": "South", "South Carolina": "South", "Virginia": "South",
    "West Virginia": "South", "Alabama": "South", "Kentucky": "South", "Mississippi": "South",
    "Tennessee": "South", "Arkansas": "South", "Louisiana": "South", "Oklahoma": "South",
    "Texas": "South", "District of Columbia": "South",
    "Arizona": "West", "Colorado": "West", "Idaho": "West", "Montana": "West", "Nevada": "West",
    "New Mexico": "West", "Utah": "West", "Wyoming": "West", "Alaska": "West",
    "California": "West", "Hawaii": "West", "Oregon": "West", "Washington": "West",
    "Puerto Rico": "Territories", "U.S. Virgin Islands": "Territories",
    "U.S. Pacific Trust Territories and Possessions": "Territories",
}
REGION_CODES = {"Northeast": "NE", "Midwest": "MW", "South": "SO", "West": "WE", "Territories": "TR"}
UNKNOWN_REGION_CODE = "XX"

# Declared text lengths of the reference sheets (a longer value
# fails the load instead of being truncated).
REASON_LENGTHS = {"cancellation_code": ("string", 3), "reason_description": ("string", 200),
                  "responsible_party": ("string", 50), "compensation_eligibility": ("string", 200)}
REGION_LENGTHS = {"state_name": ("string", 100), "region": ("string", 20), "region_code": ("string", 2)}

# US federal holidays of 2024 (the warehouse calendar year).
US_FEDERAL_HOLIDAYS_2024 = [
    _dt.date(2024, 1, 1), _dt.date(2024, 1, 15), _dt.date(2024, 2, 19), _dt.date(2024, 5, 27),
    _dt.date(2024, 6, 19), _dt.date(2024, 7, 4), _dt.date(2024, 9, 2), _dt.date(2024, 10, 14),
    _dt.date(2024, 11, 11), _dt.date(2024, 11, 28), _dt.date(2024, 12, 25),
]


def local_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small constant table built on the JVM side (``inline`` of literal
    structs): no Python worker, one partition."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


REASON_SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c == "cancellation_key" else T.StringType())
                              for c in REASON_COLUMNS])
REGION_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("state_name", "region", "region_code")])


def seed_reasons(spark: SparkSession) -> DataFrame:
    """Cancellation reason rows including the default member (SRC-11)."""
    return local_rows(spark, REASON_ROWS, REASON_SCHEMA)


def us_region_reference(spark: SparkSession) -> DataFrame:
    """state_name, region, region_code for US states (DIM-4)."""
    rows = [(s, r, REGION_CODES.get(r, UNKNOWN_REGION_CODE)) for s, r in US_STATE_REGIONS.items()]
    return local_rows(spark, rows, REGION_SCHEMA)
