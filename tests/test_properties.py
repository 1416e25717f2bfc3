import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwkit.operators.scd import OPEN_END, scd2_merge

KEYS = ["AA", "B6", "NK", None]
batch = st.lists(st.tuples(st.sampled_from(KEYS), st.sampled_from(["x", "y", None])), min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(batch, min_size=1, max_size=3))
def test_scd2_invariants(spark, batches):
    dim = None
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, "carrier_code string, carrier_name string")
        dim = scd2_merge(dim, df, "carrier_code", ["carrier_name"], "airline_key", dt.datetime(2024, 1, 1 + i))
        dim = spark.createDataFrame(dim.collect(), dim.schema)        # materialise between loads
    rows = dim.collect()
    by_key: dict = {}
    for r in rows:
        by_key.setdefault(r.carrier_code, []).append(r)
    for versions in by_key.values():
        assert sum(v.is_current_record for v in versions) == 1            # one current row per key
        vs = sorted(versions, key=lambda v: v.scd_effective_date)
        for a, b in zip(vs, vs[1:]):
            assert a.scd_expiry_date == b.scd_effective_date               # contiguous, no overlap
        assert vs[-1].is_current_record and vs[-1].scd_expiry_date == OPEN_END
    assert sorted(r.airline_key for r in rows) == list(range(1, len(rows) + 1))
    again = scd2_merge(dim, spark.createDataFrame(batches[-1], "carrier_code string, carrier_name string"),
                       "carrier_code", ["carrier_name"], "airline_key", dt.datetime(2025, 1, 1))
    assert again.count() == len(rows)                                       # re-run adds nothing
