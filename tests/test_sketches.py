import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dwkit.operators import sketches as K

SCHEMA = "i int, x double, s string, d date, a array<int>, b binary, m decimal(10,2), e string"


def rows(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        v = int(r.paretovariate(0.7)) % 50_000
        out.append((r.choice([None, v]), r.gauss(0, 100), r.choice(["hot", "hot", f"v{v}"]), dt.date(2020, 1, 1) + dt.timedelta(days=v % 900),
                    [v % 7], bytes([v % 5]), None, None))
    return out


def test_merged_state_within_its_bounds_of_exact_figures(spark):
    parts = [rows(1, 4000), rows(2, 1), [], rows(3, 3000)]
    got = {r.column: r for r in K.report(K.merge([K.sketch(spark.createDataFrame(p, SCHEMA)) for p in parts])).collect()}
    every = [r for p in parts for r in p]
    for at, name in enumerate(("i", "x", "s", "d")):
        values = [r[at] for r in every if r[at] is not None]
        r, exact = got[name], Counter(values)
        assert (r.total_rows, r.null_count) == (len(every), len(every) - len(values))
        assert abs(r.unique_values - len(exact)) <= K.distinct_bound() * len(exact) + 1
        assert (r.min, r.max) == (str(min(values)), str(max(values)))
        for value, n in r.frequent:
            assert abs(n - next(c for v, c in exact.items() if str(v) == value)) <= len(every) / K.TRACKED + 1
        if name in "ix":
            ordered = sorted(values)
            for rank, at_rank in zip((0.25, 0.5, 0.75), r.quantiles):
                under, upto = sum(v < at_rank for v in ordered) / len(ordered), sum(v <= at_rank for v in ordered) / len(ordered)
                assert under - K.QUANTILE_BOUND <= rank <= upto + K.QUANTILE_BOUND
    assert got["s"].frequent[0].value == "hot" and got["a"].unique_values == 7 and got["b"].unique_values == 5
    for name in ("m", "e"):
        assert (got[name].unique_values, got[name].min, got[name].frequent, got[name].null_pct) == (0, None, [], 100.0)


def test_merging_is_the_same_in_any_order_and_grouping(spark):
    parts = [K.sketch(spark.createDataFrame(rows(s, 800), SCHEMA)) for s in (5, 6, 7)]
    ways = [K.merge(parts), K.merge([K.merge(parts[:2]), parts[2]]), K.merge([parts[2], K.merge(parts[1::-1])])]
    found = [{r.column: r for r in K.report(w, top=1).collect()} for w in ways]
    for c, first in found[0].items():
        for other in (f[c] for f in found[1:]):
            assert (first.total_rows, first.null_count, first.min, first.max) == (other.total_rows, other.null_count, other.min, other.max)
            assert abs(first.unique_values - other.unique_values) <= 1 + first.unique_values / 1000      # rounding of the same registers
    assert len({tuple(f["s"].frequent[0]) for f in found}) == 1


def test_state_is_kept_as_a_table_and_needs_one_aggregate(spark, tmp_path):
    for load, seed in enumerate((8, 9)):
        K.sketch(spark.createDataFrame(rows(seed, 500), SCHEMA)).withColumn("load", F.lit(load)).write.mode("append").partitionBy("load").parquet(str(tmp_path))
    kept = spark.read.parquet(str(tmp_path))
    assert K.report(K.merge(kept.drop("load"))).where("column = 'i'").first().total_rows == 1000
    plan = K.sketch(spark.createDataFrame(rows(1, 10), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


@pytest.mark.parametrize("lg_k", [8, 16])
def test_registers_set_the_bound(spark, lg_k):
    n = K.report(K.sketch(spark.range(60_000), lg_k=lg_k)).first().unique_values
    assert abs(n - 60_000) <= K.distinct_bound(lg_k) * 60_000
