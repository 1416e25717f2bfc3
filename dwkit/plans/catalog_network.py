"""Registered queries: delay propagation over the airport network (RPT-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.operators import propagation as P
from dwkit.operators.windows import ranked
from dwkit.plans import catalog_sql as S
from dwkit.plans.catalog import q
from dwkit.plans.warehouse import build

_OWN = ["carrier_delay", "weather_delay", "nas_delay", "security_delay"]


def _network(spark: SparkSession, sf: str) -> tuple[P.Propagation, DataFrame]:
    """Minutes are added up by the fact's airport keys; only scores and pairs meet the dimension."""
    w = build(spark, sf)
    own = sum((F.coalesce(F.col(c), F.lit(0)) for c in _OWN), F.lit(0))
    found = P.propagate(w["fact"], "origin_airport_key", "dest_airport_key", F.col("late_aircraft_delay"), own)
    return found, w["dim_airport"].select("airport_key", "airport_code")


#: Rounds of the oracle: the change is below 1e-12 long before.
_ROUNDS = 40
_NETWORK = f""", pairs AS (
  SELECT origin, dest, CAST(sum(late_aircraft_delay) AS DOUBLE) AS minutes, CAST(sum({' + '.join(_OWN)}) AS DOUBLE) AS own FROM fact GROUP BY 1, 2),
nodes AS (
  SELECT node, sum(own) AS own, sum(minutes) AS handed_on, sum(own) / (SELECT sum(own) FROM pairs) AS base FROM (
    SELECT origin AS node, own, minutes FROM pairs UNION ALL SELECT dest, 0, 0 FROM pairs) x GROUP BY 1),
edges AS (
  SELECT p.origin, p.dest, p.minutes, p.minutes / n.handed_on AS share FROM pairs p JOIN nodes n ON n.node = p.origin WHERE p.minutes > 0),
r0 AS MATERIALIZED (SELECT node, base AS score FROM nodes)""" + "".join(f""",
r{i + 1} AS MATERIALIZED (
  SELECT n.node, {P.DAMPING} * coalesce(i.came, 0) + n.base * (1 - {P.DAMPING} * (
    SELECT coalesce(sum(s.score), 0) FROM r{i} s JOIN nodes m ON m.node = s.node WHERE m.handed_on > 0)) AS score
  FROM nodes n LEFT JOIN (SELECT e.dest, sum(s.score * e.share) AS came FROM edges e JOIN r{i} s ON s.node = e.origin GROUP BY 1) i ON i.dest = n.node)"""
                                                                      for i in range(_ROUNDS))


@q("rpt_11_propagation_airports", S.with_ctes(_NETWORK, f"""
SELECT n.node AS airport_code, CAST(n.own AS BIGINT) AS own_minutes, CAST(n.handed_on AS BIGINT) AS minutes_handed_on, round(r.score, 7) AS score,
       rank() OVER (ORDER BY round(r.score, 7) DESC) AS risk_rank
FROM nodes n JOIN r{_ROUNDS} r ON r.node = n.node"""))
def rpt_11_airports(spark, sf):
    found, airports = _network(spark, sf)
    named = found.scores.join(airports, F.col("node") == F.col("airport_key")).select(
        "airport_code", F.col("own").cast("long").alias("own_minutes"), F.col("handed_on").cast("long").alias("minutes_handed_on"),
        F.round("score", 7).alias("score"))
    return ranked(named, "score", out="risk_rank").withColumn("risk_rank", F.col("risk_rank").cast("long"))


@q("rpt_11_propagation_routes", S.with_ctes(_NETWORK, f"""
SELECT e.origin, e.dest, CAST(e.minutes AS BIGINT) AS minutes, round({P.DAMPING} * r.score * e.share, 7) AS flow,
       rank() OVER (ORDER BY round({P.DAMPING} * r.score * e.share, 7) DESC) AS risk_rank
FROM edges e JOIN r{_ROUNDS} r ON r.node = e.origin"""))
def rpt_11_routes(spark, sf):
    found, airports = _network(spark, sf)
    end = lambda name: airports.select(F.col("airport_key").alias(f"{name}_key"), F.col("airport_code").alias(f"{name}_code"))
    named = (found.flows.join(end("o"), F.col("origin") == F.col("o_key")).join(end("d"), F.col("dest") == F.col("d_key"))
             .select(F.col("o_code").alias("origin"), F.col("d_code").alias("dest"), F.col("minutes").cast("long").alias("minutes"),
                     F.round("flow", 7).alias("flow")))
    return ranked(named, "flow", out="risk_rank").withColumn("risk_rank", F.col("risk_rank").cast("long"))
