"""Registered queries: mergeable state (bitmaps and sketches) over the fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.operators import bitmaps as B
from dwkit.operators import sketches as K
from dwkit.plans import fixtures as FX
from dwkit.plans import catalog_sql as S
from dwkit.plans.catalog import q
from dwkit.plans.warehouse import build
from dwkit.sources.files import scratch_path, stage

MEMBERS = {"routes": ["route_key"], "airports": ["origin_airport_key", "dest_airport_key"], "carriers": ["airline_key"]}
_LEVELS = {"month": ["year", "quarter", "month"], "quarter": ["year", "quarter"], "year": ["year"]}


def _distinct_state(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Bitmaps by day from one scan of the fact, then each level from the one below."""
    w = build(spark, sf)
    calendar = F.broadcast(w["dim_date"].select("date_key", "full_date", "year", "quarter", "month"))
    day = stage(B.state(w["fact"], ["date_key"], MEMBERS).join(calendar, "date_key").drop("date_key"), scratch_path(spark, "bitmaps"))
    out, below = {"day": day}, day
    for level, by in _LEVELS.items():
        below = out[level] = stage(B.roll_up(below, by), scratch_path(spark, "bitmaps"))
    return out


_ROUTE = "(carrier_code, flight_number, origin, dest)"
_PART = {"year": "CAST(year AS INTEGER)", "quarter": "CAST(quarter AS INTEGER)", "month": "CAST(month AS INTEGER)", "full_date": "fl_date"}


def _level_sql(level: str, by: list[str]) -> str:
    cols = ", ".join(f"{_PART[c] if c in by else 'NULL'} AS {c}" for c in _PART)
    on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM x.{c}" for c in _PART)
    return f"""
SELECT x.*, a.airports FROM (
  SELECT '{level}' AS level, {cols}, count(DISTINCT {_ROUTE}) AS routes, count(DISTINCT carrier_code) AS carriers FROM fact GROUP BY ALL) x
JOIN (SELECT {cols}, count(DISTINCT code) AS airports FROM (
  SELECT *, origin AS code FROM fact UNION ALL SELECT *, dest FROM fact) y GROUP BY ALL) a ON {on}"""


@q("agg_4_distinct_by_calendar_level", S.with_fact(" UNION ALL ".join(
    _level_sql(level, by) for level, by in [("day", list(_PART)), *_LEVELS.items()])))
def agg_4_levels(spark, sf):
    parts = []
    for level, of in _distinct_state(spark, sf).items():
        by = _LEVELS.get(level, list(_PART))
        parts.append(B.counts(of, by, list(MEMBERS)).select(
            F.lit(level).alias("level"), *[(F.col(c) if c in by else F.lit(None)).cast("date" if c == "full_date" else "int").alias(c) for c in _PART],
            *MEMBERS))
    return reduce(DataFrame.unionByName, parts)


@q("agg_4_served_again_next_quarter", S.with_fact(f""", m AS (
  SELECT DISTINCT CAST(year * 4 + quarter AS INTEGER) AS q, 'routes' AS kind, CAST({_ROUTE} AS VARCHAR) AS k FROM fact
  UNION SELECT DISTINCT CAST(year * 4 + quarter AS INTEGER), 'airports', origin FROM fact
  UNION SELECT DISTINCT CAST(year * 4 + quarter AS INTEGER), 'airports', dest FROM fact
  UNION SELECT DISTINCT CAST(year * 4 + quarter AS INTEGER), 'carriers', carrier_code FROM fact)
SELECT a.q AS quarter_number, count(*) FILTER (WHERE a.kind = 'routes') AS routes, count(*) FILTER (WHERE a.kind = 'airports') AS airports,
       count(*) FILTER (WHERE a.kind = 'carriers') AS carriers
FROM m a JOIN m b ON a.kind = b.kind AND a.k = b.k AND b.q = a.q + 1 GROUP BY 1"""))
def agg_4_again(spark, sf):
    quarters = _distinct_state(spark, sf)["quarter"].withColumn("quarter_number", (F.col("year") * 4 + F.col("quarter")).cast("int"))
    before = quarters.withColumn("quarter_number", F.col("quarter_number") - 1)
    return B.common(quarters, before, ["quarter_number"], list(MEMBERS))


@q("agg_4_distinct_merged_over_loads", S.with_fact(f"""
SELECT carrier_code, count(DISTINCT {_ROUTE}) AS routes, count(DISTINCT dest) AS destinations FROM fact GROUP BY 1"""))
def agg_4_loads(spark, sf):
    # The state of each year's load is kept; a later load adds its own and reads no earlier fact row.
    w = build(spark, sf)
    fact, members = w["fact"].withColumn("load", F.expr("month_key div 100")), {"routes": ["route_key"], "destinations": ["dest_airport_key"]}
    earlier = stage(B.state(fact.where("load < 1996"), ["airline_key"], members), scratch_path(spark, "bitmaps"))
    later = stage(B.state(fact.where("load >= 1996"), ["airline_key"], members), scratch_path(spark, "bitmaps"))
    airline = w["dim_airline"].select("airline_key", "carrier_code")
    return B.counts(B.merge(earlier, later), ["airline_key"], list(members)).join(airline, "airline_key").drop("airline_key")


#: Numeric columns of the flat table, whose median is checked.
_NUMBERS = ["dep_delay", "arr_delay", "taxi_out", "taxi_in", "actual_elapsed_time", "air_time", "distance", "carrier_delay", "late_aircraft_delay"]
_TEXTS = {"op_unique_carrier": "carrier_code", "origin": "origin", "dest": "dest", "fl_date": "fl_date", "operation_id": "operation_id",
          "op_carrier_fl_num": "flight_number"}


def _exact_sql(name: str, column: str) -> str:
    return (f"SELECT '{name}' AS column, count(*) AS total_rows, count(*) - count({column}) AS null_count, CAST(min({column}) AS VARCHAR) AS min, "
            f"CAST(max({column}) AS VARCHAR) AS max, count(DISTINCT {column}) AS exact_distinct, true AS distinct_ok, true AS quantiles_ok, "
            f"true AS frequent_ok FROM flat")


@q("dq_1_sketches_of_yearly_loads", S.with_ctes("", " UNION ALL ".join(
    [_exact_sql(c, c) for c in _NUMBERS] + [_exact_sql(name, c) for name, c in _TEXTS.items()])))
def dq_1_sketches(spark, sf):
    """State of each year's rows, merged, against exact figures: distinct counts, quartiles and most frequent
    values within their bounds."""
    cols = [*_NUMBERS, *_TEXTS]
    flat = stage(FX.flat_operations(spark, sf).select("year", *cols), scratch_path(spark, "flat"))
    years = [r.year for r in flat.select("year").distinct().collect()]                       # a handful: calendar years
    loads = [stage(K.sketch(flat.where(F.col("year").eqNullSafe(F.lit(y))), cols), scratch_path(spark, "sketch")) for y in years]
    found = stage(K.report(K.merge(loads)), scratch_path(spark, "profile"))

    # Exact: values and their counts, once; the sketches' answers are looked up in them.
    pairs = flat.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                                                    (F.col(c).cast("double") if c in _NUMBERS else F.lit(None).cast("double")).alias("x")) for c in cols])))
    counted = stage(pairs.where("value IS NOT NULL").groupBy("column", "value", "x").agg(F.count(F.lit(1)).alias("n")), scratch_path(spark, "values"))
    distinct = counted.groupBy("column").agg(F.count(F.lit(1)).alias("exact_distinct"), F.sum("n").alias("values"))
    quarter = found.select("column", F.posexplode("quantiles").alias("i", "at")).withColumn("rank", (F.col("i") + 1) / F.lit(4.0))
    below = (counted.where("x IS NOT NULL").join(quarter, "column").groupBy("column", "rank")
             .agg((F.sum(F.when(F.col("x") < F.col("at"), F.col("n")).otherwise(0)) / F.sum("n")).alias("under"),
                  (F.sum(F.when(F.col("x") <= F.col("at"), F.col("n")).otherwise(0)) / F.sum("n")).alias("upto")))
    ranks = below.groupBy("column").agg(F.bool_and((F.col("under") <= F.col("rank") + K.QUANTILE_BOUND) & (F.col("upto") >= F.col("rank") - K.QUANTILE_BOUND)).alias("ok"))
    top = found.select("column", "total_rows", F.inline_outer("frequent")).join(counted.select("column", "value", "n"), ["column", "value"], "left")
    often = top.groupBy("column").agg(F.bool_and((F.abs(F.col("count") - F.col("n")) <= K.frequent_bound(F.col("total_rows")))
                                                 | F.col("value").isNull()).alias("often"))
    return (found.join(distinct, "column", "left").join(ranks, "column", "left").join(often, "column", "left")
            .select("column", "total_rows", "null_count", "min", "max", F.coalesce("exact_distinct", F.lit(0)).alias("exact_distinct"),
                    (F.abs(F.col("unique_values") - F.col("exact_distinct")) <= F.ceil(K.distinct_bound() * F.col("exact_distinct"))).alias("distinct_ok"),
                    F.coalesce("ok", F.lit(True)).alias("quantiles_ok"), F.coalesce("often", F.lit(True)).alias("frequent_ok")))
