"""Report measures and queries (RPT-1..RPT-11).

Measures are aggregate expressions over an already filtered frame: a filter
on ``cancelled`` together with a rate means "within the filter" (the report
language would replace the outer filter; documented difference).  Ratios are
always computed from aggregated counts, never averaged or summed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.functions.expr import band, safe_divide
from dwkit.operators.windows import share, top_k_per_group
from dwkit.sources.reference import DELAY_PARTS

# -- base counts (additive) ---------------------------------------------------

def n_flights() -> Column:
    return F.count(F.lit(1))


def n_cancelled(flag: str = "cancelled") -> Column:
    return F.count_if(F.col(flag) == 1)


def n_operated(flag: str = "cancelled") -> Column:
    return F.count_if(F.col(flag) == 0)


def n_on_time(delay: str = "arr_delay", flag: str = "cancelled", null_is_on_time: bool = True) -> Column:
    """Operated rows with ``delay <= 0``.  With ``null_is_on_time`` a missing
    delay counts as 0, as a blank does in the report language (SURVEY Q12)."""
    d = F.coalesce(F.col(delay), F.lit(0.0)) if null_is_on_time else F.col(delay)
    return F.count_if((F.col(flag) == 0) & (d <= 0))


# -- measures (RPT-7..RPT-10) -----------------------------------------------------

def rate(numerator: Column, denominator: Column, digits: int | None = 4) -> Column:
    """``DIVIDE(n, d, 0) * 100`` as a double."""
    r = safe_divide(numerator.cast("double") * F.lit(100.0), denominator, 0.0)
    return F.round(r, digits) if digits is not None else r


def total_flights(df: DataFrame) -> DataFrame:
    """Total Flights (RPT-7)."""
    return df.agg(n_flights().alias("total_flights"))


def on_time_rate(null_is_on_time: bool = True, digits: int | None = 4) -> Column:
    """On-Time Rate % (RPT-8)."""
    return rate(n_on_time(null_is_on_time=null_is_on_time), n_operated(), digits)


def cancellation_rate(digits: int | None = 4) -> Column:
    """Cancellation Rate % (RPT-9)."""
    return rate(n_cancelled(), n_flights(), digits)


def avg_arrival_delay(delay: str = "arr_delay", flag: str = "cancelled", digits: int | None = 4) -> Column:
    """Average delay of operated rows, nulls ignored (RPT-10)."""
    a = F.avg(F.when(F.col(flag) == 0, F.col(delay).cast("double")))
    return F.round(a, digits) if digits is not None else a


def headline(by: Sequence[str | Column] = (), null_is_on_time: bool = True) -> list[Column]:
    return [n_flights().alias("flights"), n_operated().alias("operated"), n_cancelled().alias("cancelled"),
            n_on_time(null_is_on_time=null_is_on_time).alias("on_time"),
            on_time_rate(null_is_on_time).alias("on_time_rate"),
            cancellation_rate().alias("cancellation_rate"), avg_arrival_delay().alias("avg_arr_delay")]


# -- report queries ---------------------------------------------------------------

def otp_matrix(df: DataFrame, rows: Sequence[str], col: str, bands=(60.0, 80.0),
               band_labels=("red", "amber", "green")) -> DataFrame:
    """Matrix with row and column subtotals (RPT-1).

    The additive counts are grouped to the finest cells first and ``GROUP BY
    CUBE`` runs over those few; the on-time rate is divided afterwards, so every subtotal cell is a true ratio of its own
    counts.  ``grouping_id`` tells subtotal cells from null members;
    ``colour`` is the conditional-format band of the rate.
    """
    keys = [*rows, col]
    cells = df.groupBy(*keys).agg(n_operated().alias("operated"), n_on_time().alias("on_time"))
    agg = cells.cube(*keys).agg(F.sum("operated").alias("operated"), F.sum("on_time").alias("on_time"),
                                F.grouping_id(*keys).alias("grouping_id"))
    agg = agg.withColumn("on_time_rate", F.round(safe_divide(F.col("on_time") * 100.0, "operated", 0.0), 4))
    return agg.withColumn("colour", band("on_time_rate", bands, band_labels))


def cause_breakdown(df: DataFrame, by: Sequence[str] = (), parts: Sequence[str] = DELAY_PARTS) -> DataFrame:
    """Delay minutes per cause and share of all cause minutes (RPT-3 donut,
    WIN-4): one aggregate, unpivot, share within the group."""
    agg = df.groupBy(*by).agg(*[F.sum(F.col(p).cast("long")).alias(p) for p in parts])
    long = agg.unpivot(list(by), list(parts), "cause", "minutes")
    return share(long, "minutes", list(by) or None, "share").withColumn("share", F.round("share", 4))


def dominant_cause(df: DataFrame, by: Sequence[str], parts: Sequence[str] = DELAY_PARTS) -> DataFrame:
    """Cause with the most delay minutes per group (RPT-11); ties go to the
    cause listed first."""
    agg = df.groupBy(*by).agg(*[F.sum(F.col(p).cast("long")).alias(p) for p in parts])
    best = F.greatest(*[F.col(p) for p in parts])
    pick = F.when(F.lit(False), F.lit(None))
    for p in parts:
        pick = pick.when(F.col(p) == best, F.lit(p))
    return agg.select(*by, pick.alias("dominant_cause"), best.alias("minutes"))


def carrier_scorecard(df: DataFrame, carrier: str = "carrier_name") -> DataFrame:
    """Per carrier: flights, cancel rate, average delay, rank by on-time
    rate (RPT-5; WIN-5 over the small aggregate)."""
    from dwkit.operators.windows import ranked
    agg = df.groupBy(carrier).agg(*headline())
    return ranked(agg, "on_time_rate", None, "rank")


def top_routes(df: DataFrame, part: Sequence[str], route: Sequence[str], k: int = 10,
               measure: str = "avg_arr_delay") -> DataFrame:
    """Top-k routes by average delay inside each group (RPT-6, SORT-5)."""
    agg = df.groupBy(*part, *route).agg(avg_arrival_delay().alias("avg_arr_delay"),
                                         n_flights().alias("flights"))
    order = [F.col(measure).desc_nulls_last(), *[F.col(c).asc() for c in route]]
    return top_k_per_group(agg, part, k, order, out="route_rank")


def top_routes_of_cube(cube, part: str, k: int = 10, filters: dict | None = None) -> DataFrame:
    """``top_routes`` per member of ``part``, from the cube: facts are grouped by route before the route dimension is joined."""
    route = {"route.flight_number": "flight_number", "route.origin_code": "origin", "route.dest_code": "dest"}
    cells = cube.query([part, *route], ["avg_arr_delay", "flights"], filters)
    name = cube.col_name(part)
    agg = cells.select(F.col(name).alias(part.split(".")[1]), *[F.col(cube.col_name(r)).alias(n) for r, n in route.items()], "avg_arr_delay", "flights")
    order = [F.col("avg_arr_delay").desc_nulls_last(), *[F.col(c).asc() for c in route.values()]]
    return top_k_per_group(agg, [part.split(".")[1]], k, order, out="route_rank")


def gauge(df: DataFrame, target: float = 85.0, by: Sequence[str] = ()) -> DataFrame:
    """On-time rate against a target (RPT-6 gauge)."""
    g = df.groupBy(*by) if by else df
    return g.agg(on_time_rate().alias("on_time_rate")).withColumns({
        "target": F.lit(float(target)),
        "gap": F.round(F.col("on_time_rate") - F.lit(float(target)), 4),
    })


# -- composite report pages ---------------------------------------------------------

def delay_overview(cube, filters: dict | None = None) -> dict[str, DataFrame]:
    """Report page 2 (RPT-3): delay by carrier (bar), monthly on-time rate
    (line), delay-cause share (donut) and KPI cards, all under the same
    slicer filters (e.g. ``{"origin.region": "EUROPE"}``)."""
    return {
        "delay_by_carrier": cube.query(["airline.carrier_name"], ["avg_arr_delay", "flights"], filters),
        "monthly_on_time": cube.query(["date.year", "date.month"], ["on_time_rate"], filters),
        "cause_share": cause_breakdown(cube.frame([], filters)),
        "kpis": cube.summary(["flights", "on_time_rate", "cancellation_rate", "avg_arr_delay"], filters),
    }


def carrier_detail(cube, carrier: str, target: float = 85.0, k: int = 10) -> dict[str, DataFrame]:
    """Drill-through page for one carrier (RPT-6): monthly trend, delay cause
    per quarter, top-k routes by average delay and the gauge vs ``target``."""
    f = {"airline.carrier": carrier}
    by_q = cube.frame(["date.year", "date.quarter"], f).select(
        F.col("date_year").alias("year"), F.col("date_quarter").alias("quarter"), *DELAY_PARTS)
    routes = cube.query(["route.flight_number", "route.origin_code", "route.dest_code"], ["avg_arr_delay", "flights"], f).select(
        F.col("route_flight_number").alias("flight_number"), F.col("route_origin_code").alias("origin"),
        F.col("route_dest_code").alias("dest"), "avg_arr_delay", "flights")
    from dwkit.operators.sampling import top_n
    return {
        "monthly": cube.query(["date.year", "date.month"], ["flights", "on_time_rate", "avg_arr_delay"], f),
        "causes_by_quarter": cause_breakdown(by_q, ["year", "quarter"]),
        "top_routes": top_n(routes, k, [F.col("avg_arr_delay").desc_nulls_last(), F.col("flight_number"),
                                        F.col("origin"), F.col("dest")]),
        "gauge": gauge(cube.frame([], f), target),
    }


def riskiest(df: DataFrame, keys: Sequence[str], k: int = 10,
             measure: str = "cancellation_rate") -> DataFrame:
    """The ``k`` groups with the highest rate (RPT-11), ties broken by the
    keys; the groups' ``flights`` stand beside the rate."""
    from dwkit.operators.sampling import top_n
    agg = df.groupBy(*keys).agg(*headline())
    return top_n(agg, k, [F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in keys]])


def drill_table(cube, role: str, hierarchy: str, level: str, measures: Sequence[str],
                member: dict | None = None) -> DataFrame:
    """Table at the chosen hierarchy level with subtotals of every level
    above it and a grand total (RPT-4)."""
    levels = cube.hierarchy(role, hierarchy)
    upto = levels[: levels.index(f"{role}.{level}") + 1]
    return cube.query(upto, measures, member, totals="rollup")
