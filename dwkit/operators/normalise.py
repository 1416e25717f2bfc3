"""Normalise a flat operations table into entities (NORM-1, NORM-2).

Column names default to the flat source layout (``sources.FLAT_SCHEMA``);
columns absent from the input are skipped, so a narrower flat table works.
Surrogate ids are dense and assigned once, by an explicit order (never file
order, SURVEY Q15/Q16).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.functions.expr import any_positive
from dwkit.operators.joins import assign_fk
from dwkit.operators.sets import entity_from_roles
from dwkit.operators.windows import first_per_key, with_surrogate
from dwkit.sources.reference import DELAY_PARTS

ROUTE_IDENTITY = ("op_unique_carrier", "op_carrier_fl_num", "origin", "dest", "crs_dep_time", "crs_arr_time")
ROUTE_ATTRS = ("crs_elapsed_time", "distance")
ROUTE_RENAME = {"op_unique_carrier": "carrier_code", "op_carrier_fl_num": "flight_number",
                "origin": "origin_code", "dest": "dest_code"}
OPERATION_COLS = ("fl_date", "year", "month", "day_of_month", "day_of_week", "dep_time", "dep_delay",
                  "taxi_out", "wheels_off", "wheels_on", "taxi_in", "arr_time", "arr_delay",
                  "actual_elapsed_time", "air_time", "cancelled", "cancellation_code", "diverted")
ORIGIN_ROLE = {"airport_code": "origin", "city_name": "origin_city_name", "state_name": "origin_state_nm"}
DEST_ROLE = {"airport_code": "dest", "city_name": "dest_city_name", "state_name": "dest_state_nm"}


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def airlines(flat: DataFrame, names: DataFrame | None = None, code: str = "op_unique_carrier",
             name: str = "carrier_name", default: str = "Unknown") -> DataFrame:
    """Distinct carriers with their names: from a names reference (unmapped
    -> ``default``) or, when the flat table carries a name column, its
    smallest name per code."""
    if names is None and name in flat.columns:
        return first_per_key(flat.select(F.col(code).alias("carrier_code"), F.col(name).alias("carrier_name"))
                             .where(F.col("carrier_code").isNotNull()), "carrier_code", "carrier_name")
    codes = flat.select(F.col(code).alias("carrier_code")).where(F.col("carrier_code").isNotNull()).distinct()
    if names is None:
        return codes.withColumn("carrier_name", F.lit(default))
    n = first_per_key(names.select("carrier_code", "carrier_name"), "carrier_code", "carrier_name")
    return (codes.join(n, "carrier_code", "left")
            .withColumn("carrier_name", F.coalesce("carrier_name", F.lit(default))))


def airports(flat: DataFrame) -> DataFrame:
    """Airports seen as origin or destination, one row per code (SET-2)."""
    roles = []
    for r in (ORIGIN_ROLE, DEST_ROLE):
        roles.append({k: v for k, v in r.items() if v in flat.columns})
    return entity_from_roles(flat, roles, "airport_code")


def route_identities(flat: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """Distinct route identities (six columns) with their smallest
    attributes, renamed to the entity layout; returns (frame, keys, attrs)."""
    ident = _present(flat, ROUTE_IDENTITY)
    attrs = _present(flat, ROUTE_ATTRS)
    f = first_per_key(flat.select(*ident, *attrs), ident, attrs or ident)
    f = f.select(*[F.col(c).alias(ROUTE_RENAME.get(c, c)) for c in ident + attrs])
    return f, [ROUTE_RENAME.get(c, c) for c in ident], attrs


def flights(flat: DataFrame) -> DataFrame:
    """Route definitions: unique on the six identity columns, the smallest
    attributes kept, ``flight_id`` dense by identity (NORM-1)."""
    f, keys, _ = route_identities(flat)
    return with_surrogate(f, "flight_id", [F.col(k).asc_nulls_first() for k in keys])


def operations(flat: DataFrame, flight: DataFrame, id_col: str = "operation_id",
               order: Sequence[str] | None = None) -> DataFrame:
    """One row per operation with its ``flight_id`` (null-safe composite
    lookup, JOIN-8).  An existing ``id_col`` is kept; otherwise ids are
    assigned densely by ``order``."""
    ident = _present(flat, ROUTE_IDENTITY)
    cols = _present(flat, OPERATION_COLS)
    base = flat if id_col in flat.columns else with_surrogate(flat, id_col, list(order or flat.columns))
    keyed = assign_fk(base.select(id_col, *ident, *cols), flight, ident,
                      "flight_id", [ROUTE_RENAME.get(c, c) for c in ident])
    return keyed.select(id_col, "flight_id", *cols)


def keyed_operations(flat: DataFrame, flight: DataFrame) -> DataFrame:
    """Every flat row with its ``flight_id`` (one null-safe composite join,
    JOIN-8), all flat columns kept."""
    ident = _present(flat, ROUTE_IDENTITY)
    return assign_fk(flat, flight, ident, "flight_id", [ROUTE_RENAME.get(c, c) for c in ident])


def delay_records(flat_or_ops: DataFrame, id_col: str = "operation_id",
                  parts: Sequence[str] = DELAY_PARTS, flag: str = "cancelled", start=1) -> DataFrame:
    """Delay records: operated rows with any component > 0, 1 : 0..1
    (NORM-2); ``delay_id`` dense by operation id from ``start``."""
    d = flat_or_ops.where((F.col(flag) == 0) & any_positive(*parts)).select(id_col, *parts)
    return with_surrogate(d, "delay_id", [id_col], start=start)


def normalise(flat: DataFrame, carrier_names: DataFrame | None = None,
              id_col: str = "operation_id", order: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Flat table -> airline, airport, flight, flight_operation, delay_record
    (NORM-1).  Cancellation reasons are reference data (``seed_reasons``)."""
    if id_col not in flat.columns:
        flat = with_surrogate(flat, id_col, list(order or flat.columns))
    flight = flights(flat)
    ops = operations(flat, flight, id_col)
    parts = _present(flat, DELAY_PARTS)
    delays = delay_records(flat.select(id_col, "cancelled", *parts), id_col, parts)
    return {"airline": airlines(flat, carrier_names), "airport": airports(flat), "flight": flight,
            "flight_operation": ops, "delay_record": delays}
