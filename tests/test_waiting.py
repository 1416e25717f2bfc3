import datetime as dt

from pyspark.sql import functions as F

from dwkit.streaming import waiting as W

SCHEMA = "operation_id long, kind string, at timestamp, seen timestamp"
DAY = dt.datetime(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def o(i, at, seen):
    return (i, W.OPERATION, day(at), day(seen))


def c(i, at, seen):
    return (i, W.COMPLETION, day(at), day(seen))


BATCHES = [
    [o(1, 0, 0), c(1, 2, 0), c(1, 3, 0),                    # together; the latest completion of a batch counts
     c(2, 4, 0),                                            # early: its operation comes next
     c(3, 5, 0),                                            # never gets one
     o(4, 0, 0), o(7, 0, 0), (None, W.COMPLETION, day(1), day(0)), (8, W.COMPLETION, None, day(0))],
    [o(2, 1, 1), c(2, 9, 1), c(1, 9, 1), c(4, 6, 1)],       # the first batch's completion wins
    [c(5, 8, 30), c(6, 8, 30)],                             # moves the watermark: 3 is over
    [o(3, 0, 31), o(5, 1, 31), c(1, 99, 31)],               # too late for 3; 1 is forgotten
    [c(9, 0, 90)],
]


def play(spark, base, batches, each=True):
    records = spark.readStream.schema(SCHEMA).parquet(f"{base}/in/*")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{base}/in/{n:03d}")
        W.run(records, dt.timedelta(days=10), f"{base}/out", f"{base}/ck")
    get = lambda kind: sorted((r.operation_id, r[W.COMPLETE]) for r in W.outcomes(spark, f"{base}/out", kind).collect())
    return get(W.CLOSED), get(W.EXPIRED)


def test_early_matched_and_expired(spark, tmp_path):
    closed, expired = play(spark, str(tmp_path), BATCHES)
    assert closed == [(1, day(3)), (2, day(4)), (4, day(6)), (5, day(8))]
    # 3 and 6 never met their operations in time; 1's state was gone when its last completion came.
    assert expired == [(1, day(99)), (3, day(5)), (6, day(8))]


def test_replay_of_a_batch_and_restarts_change_nothing(spark, tmp_path):
    base = str(tmp_path)
    first = play(spark, base, BATCHES)
    records = spark.readStream.schema(SCHEMA).parquet(f"{base}/in/*")
    W.run(records, dt.timedelta(days=10), f"{base}/out", f"{base}/ck")                       # nothing new
    get = lambda kind: sorted((r.operation_id, r[W.COMPLETE]) for r in W.outcomes(spark, f"{base}/out", kind).collect())
    assert (get(W.CLOSED), get(W.EXPIRED)) == first
    # The last micro-batches lost their commits: they are run again and overwrite what they wrote.
    import os
    commits = sorted((int(f) for f in os.listdir(f"{base}/ck/commits") if f.isdigit()))
    for n in commits[-1:]:
        for f in (f"{base}/ck/commits/{n}", f"{base}/ck/commits/.{n}.crc"):
            if os.path.exists(f):
                os.remove(f)
    W.run(records, dt.timedelta(days=10), f"{base}/out", f"{base}/ck")
    assert (get(W.CLOSED), get(W.EXPIRED)) == first


def test_state_is_forgotten(spark, tmp_path):
    base = str(tmp_path)
    play(spark, base, BATCHES)
    state = spark.read.format("statestore").load(f"{base}/ck")
    assert {r.id for r in state.select(F.col("key.operation_id").alias("id")).collect()} == {9}


def test_a_call_works_on_numbers():
    """The cost of a stream is that of its calls: one column of numbers is read, and the state is numbers."""
    import types

    import pandas as pd

    told = {}
    state = types.SimpleNamespace(exists=False, hasTimedOut=False, update=lambda v: told.update(state=v),
                                  setTimeoutTimestamp=lambda ms: told.update(until=ms), getCurrentWatermarkMs=lambda: 0)
    far = 253_370_764_800_000_000                           # the year 9999, which nanoseconds do not hold
    parts = [pd.DataFrame({"record": [[W._BEGUN, 7_000, 5_000_000], [W._NEITHER, 0, 6_000_000]]}), pd.DataFrame({"record": [[W._CAME, far, 5_000_000]]})]
    got = list(W._matcher("operation_id", 1000)((1,), iter(parts), state))
    assert [f.values.tolist() for f in got] == [[[1, W.CLOSED, 7_000, far, 6_000_000]]]
    assert told == {"state": (7_000, None, True, 6_000_000), "until": 7_000}
