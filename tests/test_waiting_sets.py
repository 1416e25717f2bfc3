"""``waiting.run`` takes micro-batches as sets, with the rules of the matcher that is called per id."""
import datetime as dt
import random

from dwkit.streaming import waiting as W

SCHEMA = "operation_id long, kind string, at timestamp, seen timestamp"
WAIT = dt.timedelta(days=10)


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def came(i, at, seen):
    return (i, W.COMPLETION, day(at), day(seen))


def by_calls(records, wait, out_path, checkpoint):
    (W.match(records, wait).writeStream.outputMode("append").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out_path}/batch_id={n}"))
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def play(spark, base, batches, run):
    records = spark.readStream.schema(SCHEMA).parquet(f"{base}/in/*")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{base}/in/{n:03d}")
        run(records, WAIT, f"{base}/out", f"{base}/ck")
    return sorted((r.operation_id, kind, str(r[W.CREATE]), r[W.COMPLETE], r.seen, r.batch_id)
                  for kind in (W.CLOSED, W.EXPIRED) for r in W.outcomes(spark, f"{base}/out", kind).collect())


def _random_batches(seed, batches, rows, ids):
    r, out, now = random.Random(seed), [], 0
    for _ in range(batches):
        now += r.choice([0, 1, 4, 11])
        at = lambda: None if r.random() < 0.05 else day(r.randrange(60))
        out.append([(r.choice([None, *range(ids)]), r.choice([W.OPERATION, W.COMPLETION, W.COMPLETION, "other"]), at(), day(max(0, now - r.choice([0, 0, 1, 3]))))
                    for _ in range(rows)])
    return out


def test_sets_give_what_calls_give(spark, tmp_path, monkeypatch):
    batches = _random_batches(7, 6, 12, 9)
    want = play(spark, f"{tmp_path}/calls", batches, by_calls)
    assert {x[1] for x in want} == {W.CLOSED, W.EXPIRED}
    monkeypatch.setattr(W, "_WHOLE", 2)                     # folders of state are written whole, and used again
    monkeypatch.setattr(W, "_matcher", None)                # no call per id
    assert play(spark, f"{tmp_path}/sets", batches, W.run) == want


def test_ids_are_forgotten(spark, tmp_path):
    base = str(tmp_path)
    play(spark, base, [[came(1, 0, 0), came(2, 0, 0)], [came(3, 1, 30)]], W.run)
    state = W._remembered(spark, f"{base}/ck", 4, f"operation_id long, batch long, {W._STATE}, until long", "operation_id")
    assert [r.operation_id for r in state.collect()] == [3]


def test_step_with_odd_times(spark):
    state = spark.range(0).selectExpr("id AS operation_id", "id AS created", "id AS waiting", "true AS closed", "id AS seen", "id AS until")
    far = 253_370_764_800_000_000                           # the year 9999
    rows = spark.createDataFrame([(1, 5_000_999, 7_000, None), (1, 6_000_000, None, far), (2, 5_000_999, None, 3), (3, 5_000_000, None, None)],
                                 "operation_id long, arrived long, begun long, came long")
    got = {r.operation_id: r for r in W.step(state, rows, 0, dt.timedelta(seconds=1)).collect()}
    assert [(got[i].outcome, got[i].created, got[i].waiting, got[i].closed, got[i].seen, got[i].until) for i in (1, 2, 3)] == [
        (W.CLOSED, 7_000, None, True, 6_000_000, 7_000), (None, None, 3, False, 5_000_999, 6_000), (None, None, None, False, 5_000_000, 6_000)]
