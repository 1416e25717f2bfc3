import datetime as dt

from dwkit.operators.snapshot import apply_completions, open_snapshot

D = dt.datetime


def test_apply_completions_rules(spark):
    fact = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 1))],
                                 "operation_id int, fl_date date")
    fact = open_snapshot(fact)
    feed = spark.createDataFrame([(1, D(2024, 1, 2, 0, 0, 59)), (1, D(2024, 1, 3)), (3, D(2023, 12, 31)),
                                  (99, D(2024, 1, 5))], "operation_id int, accm_txn_complete_time timestamp_ntz")
    out, err = apply_completions(fact, feed, D(2025, 1, 1))
    got = {r.operation_id: (r.accm_txn_complete_time, r.txn_process_time_hours) for r in out.collect()}
    assert got[1] == (D(2024, 1, 3), 48.0)          # latest duplicate wins
    assert got[2] == (None, None)
    assert got[3][1] == -24.0                        # completion before creation is kept, flagged by DQ-11
    assert [r.operation_id for r in err.collect()] == [99]
    # first write wins: a later feed cannot move a completed row; re-run is a no-op
    again, _ = apply_completions(out, spark.createDataFrame([(1, D(2024, 2, 1))], feed.schema), D(2025, 1, 1))
    assert {r.operation_id: r.accm_txn_complete_time for r in again.collect()}[1] == D(2024, 1, 3)
    same, _ = apply_completions(out, feed, D(2025, 1, 1))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, out.collect()))


def test_hours_count_minute_boundaries(spark):
    fact = spark.createDataFrame([(1, D(2024, 1, 1, 0, 0, 59))], "operation_id int, accm_txn_create_time timestamp_ntz")
    fact = fact.selectExpr("operation_id", "accm_txn_create_time", "cast(null as timestamp_ntz) accm_txn_complete_time",
                           "cast(null as double) txn_process_time_hours")
    feed = spark.createDataFrame([(1, D(2024, 1, 1, 0, 1, 1))], "operation_id int, accm_txn_complete_time timestamp_ntz")
    out, _ = apply_completions(fact, feed)
    assert out.first().txn_process_time_hours == 1 / 60


def test_in_place_update_rewrites_only_touched_partitions(spark):
    import os
    import tempfile
    from dwkit.operators.snapshot import apply_completions_in_place
    d = tempfile.mkdtemp(prefix="dwkit-inplace-", dir="/tmp")
    fact = open_snapshot(spark.createDataFrame(
        [(1, dt.date(2023, 5, 1), 2023), (2, dt.date(2024, 1, 1), 2024), (3, dt.date(2024, 2, 1), 2024)],
        "operation_id int, fl_date date, year int"))
    path = os.path.join(d, "fact")
    fact.write.partitionBy("year").parquet(path)
    part_2023 = os.path.join(path, "year=2023")
    untouched = {f: os.path.getmtime(os.path.join(part_2023, f)) for f in os.listdir(part_2023)}
    feed = spark.createDataFrame([(2, D(2024, 1, 2)), (2, D(2024, 1, 3)), (77, D(2024, 1, 5))],
                                 "operation_id int, accm_txn_complete_time timestamp_ntz")
    errors = apply_completions_in_place(path, feed, "year", os.path.join(d, "stage"), D(2025, 1, 1))
    assert [r.operation_id for r in errors.collect()] == [77]
    after = spark.read.parquet(path)
    got = {r.operation_id: (r.accm_txn_complete_time, r.txn_process_time_hours) for r in after.collect()}
    assert got == {1: (None, None), 2: (D(2024, 1, 3), 48.0), 3: (None, None)}
    assert {f: os.path.getmtime(os.path.join(part_2023, f)) for f in os.listdir(part_2023)} == untouched
