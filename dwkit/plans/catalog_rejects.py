"""Registered queries: malformed rows and replayed rejects (SRC-1, SRC-9, ERR-1, DQ-8).

Fixtures.  Orders are written as CSV text in which some values are spoiled: prices of urgent
orders are words, dates of high priority ones have no such month, rows of status P have a field
too many, and cheap ones of low priority end early.  Lines are loaded against suppliers, of
which those of the Middle East are missing at first; Egypt's and Iran's come later.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwkit.plans.catalog import q
from dwkit.plans.fixtures import table
from dwkit.sources.files import scratch_path, stage
from dwkit.sources.rejects import Quarantine, read_checked

ORDER = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
                      T.StructField("o_totalprice", T.DecimalType(12, 2)), T.StructField("o_orderdate", T.DateType()),
                      T.StructField("o_orderpriority", T.StringType())])


def _spoiled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    digit, day = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate").cast("date").cast("string")
    start = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
    row = F.concat_ws(",", start, F.when(digit == "1", "unknown").otherwise(price),
                      F.when(digit == "2", F.concat(F.substring(day, 1, 5), F.lit("13"), F.substring(day, 8, 3))).otherwise(day), "o_orderpriority")
    row = F.when((digit == "5") & (F.col("o_totalprice") < 100000), start).when(F.col("o_orderstatus") == "P", F.concat(row, F.lit(",more"))).otherwise(row)
    path = scratch_path(spark, "orders-csv")
    o.select(row.alias("value")).write.text(path)
    return read_checked(spark, path, ORDER, header=False, date_format="yyyy-MM-dd")


_SPOILED = """
WITH o AS (SELECT *, substr(o_orderpriority, 1, 1) AS digit, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, concat_ws(',', o_orderkey, o_custkey, o_orderstatus) AS head FROM orders),
r AS (SELECT *, digit = '5' AND o_totalprice < 100000 AS short, CASE WHEN digit = '1' THEN 'unknown' ELSE price END AS p,
        CASE WHEN digit = '2' THEN substr(day, 1, 5) || '13' || substr(day, 8, 3) ELSE day END AS d FROM o)
"""


@q("src_1_rows_that_fit", _SPOILED + """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM r WHERE NOT short AND o_orderstatus <> 'P' AND digit NOT IN ('1', '2')""")
def src_1_fit(spark, sf):
    return _spoiled(spark, sf)[0]


@q("src_9_malformed_rows", _SPOILED + """
SELECT CASE WHEN short THEN head ELSE concat_ws(',', head, p, d, o_orderpriority) || CASE WHEN o_orderstatus = 'P' THEN ',more' ELSE '' END END AS raw_row,
  concat_ws('; ', CASE WHEN short OR o_orderstatus = 'P' THEN 'not 6 fields' END,
    CASE WHEN NOT short AND digit = '1' THEN 'o_totalprice: ''unknown'' is no decimal(12,2)' END,
    CASE WHEN NOT short AND digit = '2' THEN 'o_orderdate: ''' || d || ''' is no date' END) AS reason
FROM r WHERE short OR o_orderstatus = 'P' OR digit IN ('1', '2')""")
def src_9_malformed(spark, sf):
    return _spoiled(spark, sf)[1].select("raw_row", "reason")


def _suppliers(spark: SparkSession, sf: str, late: tuple[str, ...]) -> DataFrame:
    """Suppliers that are known: all but the Middle East's, and the nations of ``late``."""
    n = (table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
         .where((F.col("r_name") != "MIDDLE EAST") | F.col("n_name").isin(*late)))
    return (table(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("l_suppkey"), "n_name"))


def _replayed(spark: SparkSession, sf: str) -> tuple[DataFrame, list[DataFrame], Quarantine]:
    """The first load's rows, those of three replays, and the quarantine."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    tried = stage(lines.join(_suppliers(spark, sf, ()), "l_suppkey", "left"), scratch_path(spark, "lines"))
    key = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity"]
    rejects = tried.where("n_name IS NULL").select(F.concat_ws("|", *key).alias("reject_id"), F.concat_ws("|", *key).alias("raw_row"),
                                                   F.lit("no supplier").alias("reason")).distinct()
    box = Quarantine(spark, scratch_path(spark, "quarantine"), most=3)
    box.put(rejects, _dt.datetime(2025, 1, 1))

    def load(late: tuple[str, ...]):
        def run(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
            part = F.split("raw_row", r"\|")
            rows = raw.select("reject_id", *[part[i].cast("double" if c == "l_quantity" else "long").alias(c) for i, c in enumerate(key)])
            j = rows.join(_suppliers(spark, sf, late), "l_suppkey", "left")
            return j.where("n_name IS NOT NULL"), j.where("n_name IS NULL").select("reject_id", F.lit("still no supplier").alias("reason"))
        return run
    loads = [box.replay(load(late), _dt.datetime(2025, 1, 1 + day)) for day, late in enumerate([(), ("EGYPT", "IRAN"), ("EGYPT", "IRAN")], 1)]
    return tried.where("n_name IS NOT NULL"), loads, box


_LOST = """
WITH lost AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, n_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'MIDDLE EAST')
"""


@q("err_1_replayed_rejects", _LOST + """
SELECT l_orderkey, l_suppkey, l_partkey, CASE WHEN n_name IN ('EGYPT', 'IRAN') THEN 'recovered' ELSE 'given up' END AS state,
  CASE WHEN n_name IN ('EGYPT', 'IRAN') THEN 2 ELSE 3 END AS tries, CASE WHEN n_name NOT IN ('EGYPT', 'IRAN') THEN 'still no supplier' END AS reason
FROM lost""")
def err_1_replayed(spark, sf):
    part = F.split("raw_row", r"\|")
    return _replayed(spark, sf)[2].state().select(part[0].cast("long").alias("l_orderkey"), part[2].cast("long").alias("l_suppkey"),
                                                  part[3].cast("long").alias("l_partkey"), "state", "tries", "reason")


@q("dq_8_reconcile_with_replays", _LOST + """
SELECT (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity FROM lineitem) x) AS source_rows,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity FROM lineitem) x) - count(*) AS loaded,
  count(*) FILTER (WHERE n_name IN ('EGYPT', 'IRAN')) AS recovered, CAST(0 AS BIGINT) AS open, count(*) FILTER (WHERE n_name NOT IN ('EGYPT', 'IRAN')) AS given_up,
  true AS balanced FROM lost""")
def dq_8_replays(spark, sf):
    first, loads, box = _replayed(spark, sf)
    key = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity"]
    n = lambda df: df.select(*key).distinct().agg(F.count(F.lit(1))).first()[0]
    states = {r.state: r["count"] for r in box.state().groupBy("state").count().collect()}
    source, loaded, recovered = n(table(spark, sf, "lineitem")), n(first), sum(n(df) for df in loads)
    row = (source, loaded, recovered, states.get("open", 0), states.get("given up", 0))
    balanced = recovered == states.get("recovered", 0) and source == sum(row[1:])
    return spark.createDataFrame([(*row, balanced)], "source_rows long, loaded long, recovered long, open long, given_up long, balanced boolean")
