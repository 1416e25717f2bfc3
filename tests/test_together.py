import threading

import pytest

from dwkit.plans import pipeline as P


def test_steps_overlap_and_keep_their_order(spark):
    meet = threading.Barrier(3, timeout=60)                 # passed only if all three run at once

    def step(n):
        meet.wait()
        return spark.range(n).count()
    assert P.together(spark, *(lambda n=n: step(n) for n in (3, 1, 2))) == [3, 1, 2]


def test_an_error_is_raised_when_all_have_ended(spark):
    ended = []

    def fails():
        raise ValueError("no")
    with pytest.raises(ValueError, match="no"):
        P.together(spark, fails, lambda: ended.append(spark.range(5).count()))
    assert ended == [5]


def test_the_tables_of_a_load_are_made_side_by_side(spark, tmp_path, monkeypatch):
    """Airlines, airports and routes need the flat table alone, so none waits for another."""
    from dwkit.plans import fixtures as FX
    seen, meet, store = [], threading.Barrier(3, timeout=120), P._store

    def met(df, path, partition_by=None):
        name = path.rsplit("/", 1)[1]
        if name in ("airline", "airport", "flight"):
            meet.wait()
            seen.append(name)
        store(df, path, partition_by)
    monkeypatch.setattr(P, "_store", met)
    sf = "/root/testdata/sf0.001"
    rows = FX.flat_operations(spark, sf).limit(20).collect()
    flat = spark.createDataFrame(rows, FX.flat_operations(spark, sf).schema)
    w = P.run(spark, flat, None, FX.region_reference(spark, sf), str(tmp_path), FX.RUN_TS, unmatched_airports="default")
    assert sorted(seen) == ["airline", "airport", "flight"]
    assert w["fact_loaded"].count() + w["fact_errors"].count() == 20
