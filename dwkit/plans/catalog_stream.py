"""Registered queries: streams with state (STR-1).

Fixture: an order is an operation and a line its completion, as in the warehouse.  They
arrive on three days: orders of status F on the first and of status O on the second, those of
status P never; lines by return flag, A, N and R.  So some completions come before their
operation, and some wait for one that never comes and are given up after ten days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dwkit.functions.dates import ts_lit
from dwkit.operators.snapshot import COMPLETE, CREATE
from dwkit.plans.catalog import q
from dwkit.plans.fixtures import table
from dwkit.sources.files import scratch_path
from dwkit.streaming import waiting as W

DAYS = (_dt.datetime(2002, 1, 1), _dt.datetime(2002, 1, 2), _dt.datetime(2002, 1, 31))
WAIT = _dt.timedelta(days=10)


def _three_days(spark: SparkSession, sf: str) -> str:
    """The stream run after each day's files have come, with one checkpoint; the folder of its outcomes."""
    base = scratch_path(spark, "waiting")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("operation_id"), F.col("o_orderdate").alias(CREATE), "o_orderstatus")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("operation_id"), F.col("l_shipdate").alias(COMPLETE), "l_returnflag")
    records = None
    for n, (seen, status, flag) in enumerate(zip(DAYS, ("F", "O", None), ("A", "N", "R"), strict=True)):
        came = [df.withColumn("seen", ts_lit(seen)) for df in (orders.where(F.col("o_orderstatus") == F.lit(status)), lines.where(F.col("l_returnflag") == flag))]
        day = W.arrivals(*came)
        day.write.parquet(f"{base}/in/{n}")
        records = spark.readStream.schema(day.schema).parquet(f"{base}/in/*")
        W.run(records, WAIT, f"{base}/out", f"{base}/checkpoint")
    return f"{base}/out"


_FIRST_SEEN = """
WITH c AS (SELECT l_orderkey AS operation_id, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS day, max(l_shipdate) AS at
           FROM lineitem GROUP BY ALL),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY operation_id ORDER BY day) AS rn FROM c) x WHERE rn = 1),
o AS (SELECT o_orderkey AS operation_id, o_orderdate AS created, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS day FROM orders)
"""


@q("str_1_completions_that_waited", _FIRST_SEEN + """
SELECT f.operation_id, o.created AS accm_txn_create_time, f.at AS accm_txn_complete_time, f.day < o.day AS came_early,
       CAST([DATE '2002-01-01', DATE '2002-01-02', DATE '2002-01-31'][greatest(f.day, o.day)] AS DATE) AS closed_on
FROM first f JOIN o ON o.operation_id = f.operation_id WHERE o.day IS NOT NULL""")
def str_1_closed(spark, sf):
    closed = W.outcomes(spark, _three_days(spark, sf), W.CLOSED)
    status = table(spark, sf, "orders").select(F.col("o_orderkey").alias("operation_id"), "o_orderstatus")
    early = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("operation_id")).distinct().withColumn("day_one", F.lit(True))
    return (closed.join(status, "operation_id").join(early, "operation_id", "left")
            .select("operation_id", CREATE, COMPLETE, (F.coalesce("day_one", F.lit(False)) & (F.col("o_orderstatus") == "O")).alias("came_early"),
                    F.col("seen").cast("date").alias("closed_on")))


@q("str_1_completions_given_up", _FIRST_SEEN + """
SELECT f.operation_id, f.at AS accm_txn_complete_time, CAST([DATE '2002-01-01', DATE '2002-01-02'][f.day] AS DATE) AS seen_on
FROM first f JOIN o ON o.operation_id = f.operation_id WHERE o.day IS NULL AND f.day < 3""")
def str_1_expired(spark, sf):
    return W.outcomes(spark, _three_days(spark, sf), W.EXPIRED).select("operation_id", COMPLETE, F.col("seen").cast("date").alias("seen_on"))
