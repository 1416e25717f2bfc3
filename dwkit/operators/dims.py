"""Dimension builders (DIM-1..DIM-5, SCD wrappers).

Calendar rows come from ``sequence`` + ``explode`` (no loop); the other
dimensions are lookups and merges over their staged entities.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.functions.dates import date_key, date_names, date_parts
from dwkit.functions.expr import band
from dwkit.operators.joins import lookup_flagged
from dwkit.operators.quality import as_error_rows
from dwkit.operators.scd import scd1_merge, scd2_merge, with_default_member
from dwkit.sources.files import convert_types, scratch_path, stage
from dwkit.sources.reference import (REASON_COLUMNS, REASON_LENGTHS, REASON_ROWS, UNKNOWN_REGION_CODE,
                                     seed_reasons)

DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "quarter_name", "month", "month_name",
                "month_year", "week_of_year", "day_of_month", "day_of_week", "day_name",
                "is_weekend", "is_public_holiday", "month_key"]


def calendar(days: DataFrame, holidays: Sequence[_dt.date] = ()) -> DataFrame:
    """The 14 calendar attributes of each ``full_date`` row (DIM-1, FN-1..3)."""
    d = F.col("full_date")
    parts, names = date_parts(d), date_names(d)
    hol = d.isin(*[F.lit(h) for h in holidays]) if holidays else F.lit(False)
    return days.select(
        date_key(d).alias("date_key"), d,
        parts["year"].alias("year"), parts["quarter"].alias("quarter"), names["quarter_name"].alias("quarter_name"),
        parts["month"].alias("month"), names["month_name"].alias("month_name"),
        names["month_year"].alias("month_year"), parts["week_of_year"].alias("week_of_year"),
        parts["day_of_month"].alias("day_of_month"), parts["day_of_week"].alias("day_of_week"),
        names["day_name"].alias("day_name"), parts["is_weekend"].alias("is_weekend"),
        hol.alias("is_public_holiday"),
        (F.year(d) * 100 + F.month(d)).cast("int").alias("month_key"))


def date_dim(spark: SparkSession, start, end, holidays: Sequence[_dt.date] = ()) -> DataFrame:
    """Calendar dimension for ``start .. end`` inclusive (DIM-1).  Its size is
    the number of days in the range, so it may always be broadcast."""
    days = spark.range(0, 1, 1, 1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
                                 .alias("full_date"))
    return calendar(days, holidays)


def date_dim_for(df: DataFrame, date_col: str, holidays: Sequence[_dt.date] = ()) -> DataFrame:
    """Calendar covering the smallest to the largest date of ``df[date_col]``
    (one aggregate over the column, then one generated row per day)."""
    rng = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    days = rng.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return calendar(days, holidays)


def add_missing_dates(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Only-if-missing load: calendar rows whose key is not yet present."""
    return existing.unionByName(wanted.join(existing.select("date_key"), "date_key", "left_anti"))


def airline_dim(dim: DataFrame | None, airlines: DataFrame, run_ts, **kw) -> DataFrame:
    """Airline SCD2 on ``carrier_code``, tracking ``carrier_name`` (SCD-4)."""
    return scd2_merge(dim, airlines, "carrier_code", ["carrier_name"], "airline_key", run_ts, **kw)


def airport_dim(dim: DataFrame | None, airports: DataFrame, regions: DataFrame, run_ts=None,
                source_table: str = "airport", unmatched: str = "quarantine",
                default_region: str = "Unknown",
                default_code: str = UNKNOWN_REGION_CODE) -> tuple[DataFrame, DataFrame]:
    """Airports enriched with region by state (DIM-2, JOIN-2, ERR-1).

    Unmatched rows always become error rows (raw code and state).  With
    ``unmatched="quarantine"`` (the ETL behaviour) they are not loaded, so
    facts referencing them are rejected later; with ``"default"`` they are
    also loaded with ``default_region`` / ``default_code`` (the mapping
    default of the source preparation).  The dimension is type-1 merged.
    """
    flagged = lookup_flagged(airports, regions, "state_name", ["region", "region_code"])
    flagged = stage(flagged, scratch_path(airports.sparkSession, "airports"))     # read by three outputs
    matched, missed = flagged.where("matched"), flagged.where("NOT matched")
    attrs = ["city_name", "state_name", "region", "region_code"]
    load = matched.select("airport_code", *attrs)
    if unmatched == "default":
        load = load.unionByName(missed.select("airport_code", "city_name", "state_name",
                                              F.lit(default_region).alias("region"),
                                              F.lit(default_code).alias("region_code")))
    elif unmatched != "quarantine":
        raise ValueError("unmatched must be 'quarantine' or 'default'")
    new_dim = scd1_merge(dim, load, "airport_code", attrs, "airport_key")
    errors = as_error_rows(missed, source_table, 1, "No region for state_name",
                           ["airport_code", "state_name"], run_ts)
    return new_dim, errors


def route_dim(dim: DataFrame | None, flights: DataFrame, edges=(500, 1500),
              labels=("Short", "Medium", "Long")) -> DataFrame:
    """Routes keyed by ``flight_id`` with a distance band (DIM-3, PRJ-3).  On the
    first load the routes' dense ``flight_id`` is their key: one projection."""
    attrs = [c for c in flights.columns if c != "flight_id"] + ["distance_band"]
    f = flights.withColumn("distance_band", band("distance", edges, labels))
    if dim is None:
        return f.select(F.col("flight_id").cast("long").alias("route_key"), "flight_id", *attrs)
    return scd1_merge(dim, f, "flight_id", attrs, "route_key")


def reason_dim(spark: SparkSession, dim: DataFrame | None = None,
               incoming: DataFrame | None = None) -> DataFrame:
    """Cancellation reasons with the default member 0 = ``N/A`` (DIM-5, SCD-7).

    Without arguments this is the seeded dimension; an incoming reason sheet
    is type-1 merged on ``cancellation_code``.
    """
    base = dim if dim is not None else seed_reasons(spark)
    if incoming is None:
        return base
    attrs = REASON_COLUMNS[2:]
    incoming = convert_types(incoming.select("cancellation_code", *attrs), REASON_LENGTHS)
    merged = scd1_merge(base.where(F.col("cancellation_key") != 0), incoming,
                        "cancellation_code", attrs, "cancellation_key")
    return with_default_member(merged.select(*REASON_COLUMNS),
                               dict(zip(REASON_COLUMNS, REASON_ROWS[0])))


def region_reference_from(nations: DataFrame, regions: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """state_name / region / region_code rows from nation and region tables
    (the fixture's stand-in for the state sheet); ``exclude`` leaves holes."""
    r = regions.where(~F.col("r_name").isin(*exclude)) if exclude else regions
    return (nations.join(r, nations.n_regionkey == r.r_regionkey)
            .select(F.col("n_name").alias("state_name"), F.col("r_name").alias("region"),
                    F.upper(F.substring("r_name", 1, 2)).alias("region_code")))

