"""Registered queries: point-in-time joins by merging (JOIN-12) and the snapshot in buckets or by manifest (ACC-4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from dwkit.operators.asof import merge_as_of
from dwkit.plans import catalog_sql as S
from dwkit.plans.catalog import ORACLES, _SCD2, _airline_two_loads, q
from dwkit.plans.fixtures import RUN_TS, table
from dwkit.plans.warehouse import build
from dwkit.sources.bucketed import BucketedSnapshot, buckets_for
from dwkit.sources.files import scratch_path
from dwkit.sources.manifest import ManifestTable, apply_completions


@q("join_12_merged_as_of", S.with_ctes(_SCD2, """
SELECT f.operation_id, s.carrier_name FROM fact f JOIN airline_scd s ON s.carrier_code = f.carrier_code
 AND s.scd_effective_date <= CAST(f.fl_date AS TIMESTAMP) AND CAST(f.fl_date AS TIMESTAMP) < s.scd_expiry_date"""))
def join_12_merged(spark, sf):
    """Every fact row with its carrier's name of that day."""
    w = build(spark, sf)
    codes = w["dim_airline"].select("airline_key", "carrier_code")
    rows = w["fact"].select("operation_id", "airline_key", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("fl_date"))
    events = rows.join(codes, "airline_key").select("operation_id", "carrier_code", "fl_date")
    return merge_as_of(events, _airline_two_loads(spark, sf)[1], "carrier_code", "fl_date", ["carrier_name"], how="inner").select("operation_id", "carrier_name")


@q("join_12_versions_of_every_day", """
WITH v AS (SELECT c_mktsegment AS code, CAST(o_orderdate AS DATE) AS since, max(o_totalprice) AS price
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
e AS (SELECT l_orderkey, l_linenumber, c_mktsegment AS code, l_shipdate, l_suppkey, l_partkey
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey)
SELECT e.l_orderkey, e.l_linenumber, e.code, v.since, v.price FROM e ASOF LEFT JOIN v ON e.code = v.code AND e.l_shipdate >= v.since""")
def join_12_daily(spark, sf):
    """Each line with the highest order price known for its segment when it was shipped: a segment has a
    version for every day with orders."""
    seg = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("code"))
    orders = table(spark, sf, "orders").join(seg, "o_custkey").select("o_orderkey", "code", F.col("o_orderdate").cast("date").alias("since"), "o_totalprice")
    versions = orders.groupBy("code", "since").agg(F.max("o_totalprice").alias("price"))
    ends = versions.withColumn("until", F.lead("since").over(Window.partitionBy("code").orderBy("since")))
    events = (table(spark, sf, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "code"), "l_orderkey")
              .select("l_orderkey", "l_linenumber", "code", "l_shipdate"))
    return merge_as_of(events, ends, "code", "l_shipdate", ["since", "price"], eff="since", exp="until").drop("l_shipdate")


def _bucketed(spark, sf):
    """The snapshot in buckets after two feeds, with what they could not close; between them the first is folded in."""
    w = build(spark, sf)
    box = BucketedSnapshot(spark, scratch_path(spark, "buckets"), buckets=buckets_for(w["fact_loaded"]))
    box.create(w["fact_loaded"])
    half = F.pmod(F.xxhash64("operation_id"), F.lit(2))
    first = box.apply(w["feed"].where(half == 0), RUN_TS)
    box.compact()
    return box, first.unionByName(box.apply(w["feed"].where(half == 1), RUN_TS))


@q("acc_4_bucketed_update", ORACLES["acc_4_apply_completions"])
def acc_4_bucketed(spark, sf):
    return _bucketed(spark, sf)[0].view().select("operation_id", "accm_txn_complete_time", "txn_process_time_hours")


@q("acc_4_bucketed_errors", ORACLES["acc_4_completion_errors"])
def acc_4_bucketed_errors(spark, sf):
    return _bucketed(spark, sf)[1]


def _by_manifest(spark, sf):
    """The stored snapshot by month after the feed, and what the feed could not close."""
    w = build(spark, sf)
    fact = ManifestTable(spark, scratch_path(spark, "fact"), "month_key")
    fact.append(w["fact_loaded"])
    return fact, apply_completions(fact, w["feed"], RUN_TS)


@q("acc_4_update_by_manifest", ORACLES["acc_4_apply_completions"])
def acc_4_manifest(spark, sf):
    return _by_manifest(spark, sf)[0].read().select("operation_id", "accm_txn_complete_time", "txn_process_time_hours")


@q("acc_4_errors_by_manifest", ORACLES["acc_4_completion_errors"])
def acc_4_manifest_errors(spark, sf):
    return _by_manifest(spark, sf)[1]
