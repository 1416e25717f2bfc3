"""Registered queries: references and keys found in the driver's tables (DQ-4, DQ-5)."""

from __future__ import annotations

from itertools import combinations

from dwkit.operators.discovery import minimal_keys, references
from dwkit.plans.catalog import q
from dwkit.plans.fixtures import table

WHOLE = {"region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"],
         "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey", "p_size"], "orders": ["o_orderkey", "o_custkey"],
         "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "events": ["event_id", "user_id"]}
TEXT = {"region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"], "part": ["p_name", "p_brand", "p_type"],
        "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"]}


def _pairs_sql(columns: dict[str, list[str]]) -> str:
    every = [(t, c) for t, cs in columns.items() for c in cs]
    return " UNION ALL ".join(
        f"SELECT '{a}.{x}' AS dependent, '{b}.{y}' AS referenced, (SELECT count(DISTINCT {x}) FROM {a}) AS n_values "
        f"WHERE NOT EXISTS (SELECT 1 FROM {a} WHERE {x} IS NOT NULL AND {x} NOT IN (SELECT {y} FROM {b} WHERE {y} IS NOT NULL)) "
        f"AND EXISTS (SELECT 1 FROM {a} WHERE {x} IS NOT NULL)"
        for a, x in every for b, y in every if (a, x) != (b, y))


@q("dq_4_references_found", f"{_pairs_sql(WHOLE)} UNION ALL {_pairs_sql(TEXT)}")
def dq_4_found(spark, sf):
    return references({t: table(spark, sf, t).select(*WHOLE[t], *TEXT[t]) for t in WHOLE})


_KEY_TABLES = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
               "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
               "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
               "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
               "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"],
               "events": ["event_id", "ts", "user_id", "event_type", "value", "props"]}


def _keys_sql(most: int) -> str:
    tried = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, [{', '.join(repr(c) for c in s)}] AS cols, count(*) > 0 AND count(*) = count(DISTINCT ({', '.join(s)})) "
        f"AND {' AND '.join(f'count(*) = count({c})' for c in s)} AS is_key FROM {t}"
        for t, cols in _KEY_TABLES.items() for n in range(1, most + 1) for s in combinations(cols, n))
    return f"""WITH tried AS ({tried}), keys AS (SELECT * FROM tried WHERE is_key)
SELECT table_name, array_to_string(cols, ',') AS key_columns FROM keys k
WHERE NOT EXISTS (SELECT 1 FROM keys s WHERE s.table_name = k.table_name AND len(s.cols) < len(k.cols) AND list_has_all(k.cols, s.cols))"""


@q("dq_5_minimal_keys_found", _keys_sql(3))
def dq_5_found(spark, sf):
    rows = [(t, ",".join(k)) for t, cols in _KEY_TABLES.items() for k in minimal_keys(table(spark, sf, t), cols, most=3)]
    return spark.createDataFrame(rows, "table_name string, key_columns string")
