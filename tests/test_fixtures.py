import datetime as dt

from dwkit.plans import fixtures as fx

DAY = dt.datetime(1996, 1, 2)
TABLES = {
    "orders": ([(1, 7, "O", DAY, "1-URGENT"), (2, None, "F", DAY, "2-HIGH"), (3, 8, "P", DAY, "3-MEDIUM"), (None, 7, "O", DAY, "5-LOW")],
               "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
    "customer": ([(7, 1, "A"), (7, 2, "B"), (8, None, "C"), (None, 1, "D")], "c_custkey long, c_nationkey long, c_mktsegment string"),
    "lineitem": ([(1, 5, 6, 1, 2.0, 1.0, 0.0, 0.0, "A", "O", DAY), (1, 4, 6, 2, 3.0, 1.0, 0.0, 0.0, "N", "O", DAY), (2, 5, 6, 1, 4.0, 1.0, 0.0, 0.0, "R", "F", DAY)],
                 "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, l_discount double, "
                 "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "supplier": ([(6, 2)], "s_suppkey long, s_nationkey long"),
    "part": ([(4, 10), (5, 20)], "p_partkey long, p_size long"),
    "nation": ([(1, "X"), (2, "Y")], "n_nationkey long, n_name string"),
}


def test_customers_join_before_lines(spark, tmp_path):
    """An order's own columns are moved to its customer, not the facts of its lines as well; keys may repeat or be null."""
    for name, (rows, schema) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    flat = fx.flat_operations(spark, str(tmp_path))
    got = sorted((repr(r.operation_id), repr(r.op_unique_carrier), r.origin, r.dest, r.distance, r.carrier_delay, r.weather_delay) for r in flat.collect())
    assert got == [("1", "'A'", "X", "Y", 1000.0, 2, 3), ("1", "'B'", "Y", "Y", 1000.0, 2, 3), ("2", "None", None, "Y", 2000.0, 0, 0),
                   ("3", "'C'", None, None, None, 0, 0), ("None", "'A'", "X", None, None, 0, 0), ("None", "'B'", "Y", None, None, 0, 0)]
    joins = {line.partition("Join LeftOuter, ")[2][:11]: line.index("Join") for line in
             flat._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line}
    assert joins["(o_custkey#"] > joins["(o_orderkey"]                       # deeper in the plan, so earlier
