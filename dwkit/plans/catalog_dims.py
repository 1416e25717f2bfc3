"""Registered queries: dimensions with mixed change types and inferred members.

Fixture: customers are the members.  Those with a balance of 500 or more come in the first
batch; orders of customers in debt come before their rows (inferred members); the second
batch has all customers, some of them changed, by balance: from 6,000 another name (type 1),
from 7,000 another segment (type 2; both below 8,000), from 9,000 another nation (fixed).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.operators import scd_mixed as M
from dwkit.plans.catalog import q
from dwkit.plans.fixtures import table
from dwkit.sources.files import scratch_path, stage

SECOND, THIRD = _dt.datetime(1998, 1, 1), _dt.datetime(1999, 1, 1)
CUSTOMER = M.ChangeTypes(["c_custkey"], fixed=["c_nationkey"], changing=["c_name"], historical=["c_mktsegment"], inferred="is_inferred",
                         fail_on_fixed=False)
_ALL = ["c_custkey", "c_nationkey", "c_name", "c_mktsegment"]


def _second_batch(customers: DataFrame) -> DataFrame:
    b = F.col("c_acctbal")
    return customers.select(
        "c_custkey", F.when(b >= 9000, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey")).cast("int").alias("c_nationkey"),
        F.when((b >= 6000) & (b < 8000), F.concat("c_name", F.lit(" Ltd"))).otherwise(F.col("c_name")).alias("c_name"),
        F.when(b >= 7000, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


def _member_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The dimension after the first batch and the early orders, and the second batch."""
    customers = table(spark, sf, "customer")
    first, _ = M.merge(None, customers.where("c_acctbal >= 500").select(*_ALL), CUSTOMER, "customer_key", SECOND)
    first = stage(first, scratch_path(spark, "customers"))
    early = (table(spark, sf, "orders").join(customers.where("c_acctbal < 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
             .select(F.col("o_custkey").alias("c_custkey")))
    return stage(M.add_inferred(first, early, CUSTOMER, "customer_key"), scratch_path(spark, "customers")), _second_batch(customers)


_MEMBERS = """
WITH src AS (SELECT *, CAST(CASE WHEN c_acctbal >= 9000 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS INTEGER) AS new_nation,
  CASE WHEN c_acctbal >= 6000 AND c_acctbal < 8000 THEN c_name || ' Ltd' ELSE c_name END AS new_name,
  CASE WHEN c_acctbal >= 7000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS new_segment,
  c_acctbal >= 500 AS loaded, c_acctbal < 0 AND c_custkey IN (SELECT o_custkey FROM orders) AS guessed FROM customer),
keyed AS (SELECT *, CASE WHEN loaded THEN row_number() OVER (PARTITION BY loaded ORDER BY c_custkey)
  WHEN guessed THEN (SELECT count(*) FROM src WHERE loaded) + row_number() OVER (PARTITION BY loaded, guessed ORDER BY c_custkey) END AS sk FROM src),
judged AS (SELECT *, loaded AND new_nation <> c_nationkey AS rejected, loaded AND new_nation = c_nationkey AND new_name <> c_name AS over,
  loaded AND new_nation = c_nationkey AND new_segment <> c_mktsegment AS version, NOT loaded AND NOT guessed AS is_new FROM keyed),
opened AS (SELECT *, (SELECT count(*) FROM judged WHERE loaded OR guessed) + row_number() OVER (ORDER BY c_custkey) AS new_sk
  FROM judged WHERE version OR is_new),
dim AS (
  SELECT CAST(sk AS BIGINT) AS customer_key, c_custkey, CASE WHEN guessed THEN new_nation ELSE c_nationkey END AS c_nationkey,
    CASE WHEN over OR guessed THEN new_name ELSE c_name END AS c_name, CASE WHEN guessed THEN new_segment ELSE c_mktsegment END AS c_mktsegment,
    false AS is_inferred, TIMESTAMP '1900-01-01' AS scd_effective_date,
    CASE WHEN version THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '9999-12-31' END AS scd_expiry_date, NOT version AS is_current_record
  FROM judged WHERE loaded OR guessed
  UNION ALL
  SELECT CAST(new_sk AS BIGINT), c_custkey, new_nation, new_name, new_segment, false,
    CASE WHEN is_new THEN TIMESTAMP '1900-01-01' ELSE TIMESTAMP '1998-01-01' END, TIMESTAMP '9999-12-31', true FROM opened)
"""


@q("scd_5_component_outputs", _MEMBERS + """
SELECT output, c_custkey, new_nation AS c_nationkey, new_name AS c_name, new_segment AS c_mktsegment, changed FROM (
  SELECT 'unchanged' AS output, *, '' AS changed FROM judged WHERE loaded AND NOT rejected AND NOT over AND NOT version
  UNION ALL SELECT 'new', *, '' FROM judged WHERE is_new
  UNION ALL SELECT 'fixed', *, 'c_nationkey' FROM judged WHERE rejected
  UNION ALL SELECT 'changing', *, 'c_name' FROM judged WHERE over
  UNION ALL SELECT 'historical', *, 'c_mktsegment' FROM judged WHERE version
  UNION ALL SELECT 'inferred', *, 'c_nationkey,c_name,c_mktsegment' FROM judged WHERE guessed) x""")
def scd_5_outputs(spark, sf):
    dim, batch = _member_loads(spark, sf)
    outputs = M.component(dim, batch, CUSTOMER, "customer_key").outputs
    return reduce(DataFrame.unionByName, [o.select(F.lit(name).alias("output"), *_ALL, F.concat_ws(",", "changed").alias("changed"))
                                          for name, o in outputs.items()])


@q("scd_4_mixed_types", _MEMBERS + "SELECT * FROM dim")
def scd_4_mixed(spark, sf):
    dim, batch = _member_loads(spark, sf)
    return M.merge(dim, batch, CUSTOMER, "customer_key", SECOND)[0]


@q("scd_4_overwritten_history", _MEMBERS + """
SELECT customer_key, c_custkey, c_nationkey, upper(c_name) AS c_name, c_mktsegment, is_inferred, scd_effective_date, scd_expiry_date, is_current_record
FROM dim""")
def scd_4_history(spark, sf):
    # A third batch brings the current rows again with other names, to be overwritten in all versions.
    from dataclasses import replace
    dim, batch = _member_loads(spark, sf)
    second = stage(M.merge(dim, batch, CUSTOMER, "customer_key", SECOND)[0], scratch_path(spark, "customers"))
    third = second.where("is_current_record").select("c_custkey", "c_nationkey", F.upper("c_name").alias("c_name"), "c_mktsegment")
    return M.merge(second, third, replace(CUSTOMER, update_history=True), "customer_key", THIRD)[0]
