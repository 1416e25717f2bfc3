import datetime as dt
import os
import tempfile

from dwkit.operators.snapshot import apply_completions, open_snapshot
from dwkit.streaming.completions import completed_view, completion_log, stream_completions


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="dwkit-str-", dir="/tmp")
    fact = open_snapshot(spark.createDataFrame([(i, dt.date(2024, 1, 1)) for i in range(1, 6)],
                                               "operation_id int, fl_date date"))
    fact_path = os.path.join(base, "fact")
    fact.write.parquet(fact_path)
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write("operation_id,accm_txn_complete_time\n1,2024-01-02 00:00:00\n1,2024-01-03 00:00:00\n"
                 "9,2024-01-03 00:00:00\n")
    args = (spark, src, os.path.join(base, "log"), os.path.join(base, "ck"))
    stream_completions(*args)
    with open(os.path.join(src, "b.csv"), "w") as fh:   # a later file cannot override id 1 (first write wins)
        fh.write("operation_id,accm_txn_complete_time\n1,2024-02-01 00:00:00\n2,2024-01-04 00:00:00\n")
    stream_completions(*args)
    stream_completions(*args)          # nothing new: no-op
    stored = spark.read.parquet(fact_path)
    view = {r.operation_id: r.accm_txn_complete_time for r in
            completed_view(stored, completion_log(spark, os.path.join(base, "log"))).collect()}
    assert view[1] == dt.datetime(2024, 1, 3) and view[2] == dt.datetime(2024, 1, 4) and view[3] is None
    feed = spark.read.schema("operation_id int, accm_txn_complete_time timestamp_ntz").option("header", True) \
        .csv(os.path.join(src, "a.csv"))
    batch, _ = apply_completions(stored, feed)
    b = {r.operation_id: r.accm_txn_complete_time for r in batch.collect()}
    assert b[1] == view[1]


def test_unknown_ids_are_reported_at_compaction(spark):
    from dwkit.streaming.completions import compact
    base = tempfile.mkdtemp(prefix="dwkit-str2-", dir="/tmp")
    fact = open_snapshot(spark.createDataFrame([(i, dt.date(2024, 1, 1)) for i in range(1, 4)],
                                               "operation_id int, fl_date date"))
    fact_path = os.path.join(base, "fact")
    fact.write.parquet(fact_path)
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write("operation_id,accm_txn_complete_time\n1,2024-01-02 00:00:00\n9,2024-01-03 00:00:00\n")
    stream_completions(spark, src, os.path.join(base, "log"), os.path.join(base, "ck"))
    log = completion_log(spark, os.path.join(base, "log"))
    assert sorted(r.operation_id for r in log.collect()) == [1, 9]
    new_fact, errors = compact(spark.read.parquet(fact_path), log, dt.datetime(2025, 1, 1))
    assert [r.operation_id for r in errors.collect()] == [9]
    assert {r.operation_id: r.txn_process_time_hours for r in new_fact.collect()}[1] == 24.0
