"""Delay propagation over the airport network (RPT-11).

Airports are nodes.  Minutes lost to a late incoming aircraft are the weight of the edge
from a flight's origin to its destination: they are delay that one airport hands to the
next.  Minutes lost for other causes begin at the origin and are that airport's own.

A minute of delay begins at an airport in proportion to its own minutes; with probability
``damping`` it is handed on along one of the outgoing edges, in proportion to their weights,
else (and where no edge leads out) another minute begins.  The share of all delay that is at
an airport in the long run is its score; the share that passes along an edge is the flow of
that pair.  Both are found by power iteration:

    score' = damping * sum over incoming edges of score(origin) * weight / weights out
             + own share * (1 - damping * score handed on)

Each round is one join of the scores with the edges and one grouped sum, written to the
shared folder, so that lineage does not grow and a lost executor costs one round at most.  Two numbers a round
reach the driver: the change (sum of absolute differences), which ends the iteration at
``tolerance`` or after ``max_rounds``, and the score that is handed on.  The change shrinks by ``damping``
a round at least, so 1e-9 takes 130 rounds at most at 0.85; well-connected networks take about a dozen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.sources.files import scratch_path, stage

DAMPING, TOLERANCE, MAX_ROUNDS = 0.85, 1e-9, 200


@dataclass
class Propagation:
    """``scores``: (node, own, handed_on, score); ``flows``: (origin, dest, minutes, share, flow)."""
    scores: DataFrame
    flows: DataFrame
    rounds: int
    change: float


def propagate(flights: DataFrame, origin: str, dest: str, handed_on: Column, own: Column, damping: float = DAMPING,
              tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> Propagation:
    """Scores of all nodes and flows of all pairs of ``flights``, whose minutes are added up by pair first.

    Rows without an origin or destination take no part; pairs without minutes handed on
    are no edges.  Without any own minutes every node begins as much.  An empty frame gives none."""
    spark = flights.sparkSession
    pairs = stage(flights.where(F.col(origin).isNotNull() & F.col(dest).isNotNull())
                  .groupBy(F.col(origin).alias("origin"), F.col(dest).alias("dest"))
                  .agg(F.coalesce(F.sum(handed_on), F.lit(0)).cast("double").alias("minutes"),
                       F.coalesce(F.sum(own), F.lit(0)).cast("double").alias("own")), scratch_path(spark, "pairs"))
    out = pairs.groupBy(F.col("origin").alias("node")).agg(F.sum("own").alias("own"), F.sum("minutes").alias("handed_on"))
    both = out.unionByName(pairs.select(F.col("dest").alias("node"), F.lit(0.0).alias("own"), F.lit(0.0).alias("handed_on")).distinct())
    nodes = stage(both.groupBy("node").agg(F.sum("own").alias("own"), F.sum("handed_on").alias("handed_on")), scratch_path(spark, "nodes"))
    n, total = nodes.agg(F.count(F.lit(1)), F.sum("own")).first()
    base = (F.col("own") / F.lit(total) if total else F.lit(1.0 / n if n else 0.0)).alias("base")
    nodes = nodes.select("*", base)
    edges = stage(pairs.where("minutes > 0").join(nodes.select(F.col("node").alias("origin"), "handed_on"), "origin")
                  .select("origin", "dest", "minutes", (F.col("minutes") / F.col("handed_on")).alias("share")), scratch_path(spark, "edges"))

    scores = nodes.select("node", "own", "handed_on", "base", F.col("base").alias("score"))
    moved, change, rounds = F.sum(F.when(F.col("handed_on") > 0, F.col("score"))), float("inf"), 0
    passed = scores.agg(moved).first()[0] or 0.0
    while n and change > tolerance and rounds < max_rounds:
        came = (edges.join(scores.select(F.col("node").alias("origin"), "score"), "origin").groupBy(F.col("dest").alias("node"))
                .agg(F.sum(F.col("score") * F.col("share")).alias("came")))
        new = F.lit(damping) * F.coalesce("came", F.lit(0.0)) + F.col("base") * F.lit(1 - damping * passed)
        scores = stage(scores.join(came, "node", "left").select("node", "own", "handed_on", "base", new.alias("score"), F.col("score").alias("before")),
                       scratch_path(spark, "scores"))
        change, passed = scores.agg(F.sum(F.abs(F.col("score") - F.col("before"))), moved).first()
        passed = passed or 0.0
        rounds += 1
    flows = edges.join(scores.select(F.col("node").alias("origin"), "score"), "origin").select(
        "origin", "dest", "minutes", "share", (F.lit(damping) * F.col("score") * F.col("share")).alias("flow"))
    return Propagation(scores.select("node", "own", "handed_on", "score"), flows, rounds, change)
