import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from dwkit.operators.snapshot import apply_completions, open_snapshot
from dwkit.sources.bucketed import BucketedSnapshot, buckets_for

FEED = "operation_id long, accm_txn_complete_time timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture()
def box(spark, tmp_path):
    fact = open_snapshot(spark.createDataFrame([(i, dt.date(2024, 1, 1)) for i in range(1, 400)] + [(None, dt.date(2024, 1, 1))], "operation_id long, fl_date date"))
    out = BucketedSnapshot(spark, str(tmp_path / "fact"), buckets=4)
    out.create(fact)
    return out, fact


def rows(df):
    return sorted((r.operation_id is None, r.operation_id or 0, r.accm_txn_complete_time, r.txn_process_time_hours) for r in df.collect())


def feeds(spark):
    one = spark.createDataFrame([(i, day(i % 9)) for i in range(1, 100)] + [(5, day(50)), (9999, day(1)), (None, day(2))], FEED)
    return one, spark.createDataFrame([(i, day(77)) for i in range(90, 120)], FEED)


def test_updates_are_those_of_the_batch_operator(spark, box):
    snapshot, fact = box
    one, two = feeds(spark)
    errors = snapshot.apply(one, day(100))
    first, want_errors = apply_completions(fact, one, day(100))
    assert sorted(map(str, errors.collect())) == sorted(map(str, want_errors.collect()))
    assert rows(snapshot.view()) == rows(first)
    snapshot.apply(two)
    want = rows(apply_completions(first, two)[0])
    assert rows(snapshot.view()) == want
    snapshot.apply(one)                                                     # again: nothing to close
    assert rows(snapshot.view()) == want
    snapshot.compact()
    assert rows(snapshot.stored()) == want == rows(snapshot.view())
    assert snapshot.apply(two).count() == 0 and rows(snapshot.view()) == want


def test_the_fact_is_not_exchanged(spark, box, tmp_path):
    snapshot, _ = box
    one, two = feeds(spark)
    snapshot.apply(one)
    snapshot.apply(two)
    files = lambda folder: [f for f in os.listdir(tmp_path / "fact" / folder) if f.endswith(".parquet")]
    assert len(files("fact-000001")) == 4
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = snapshot.view()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        snapshot.compact()
        assert len(files("fact-000002")) == 4                               # written as they were read
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_folders_are_found_again_and_unfinished_ones_are_not(spark, box, tmp_path):
    snapshot, fact = box
    snapshot.apply(feeds(spark)[0])
    want = rows(snapshot.view())
    for t in spark.catalog.listTables():
        if re.match("dwkit_[0-9a-f]{20}$", t.name):
            spark.sql(f"DROP TABLE {t.name}")                               # as a new session begins: the folders stay
    os.makedirs(tmp_path / "fact" / "closed-000001-000002")
    again = BucketedSnapshot(spark, str(tmp_path / "fact"), buckets=4)
    assert rows(again.view()) == want
    again.apply(feeds(spark)[1])
    assert rows(again.view()) != want


def test_buckets_grow_with_the_fact(spark, tmp_path):
    """A task holds whole buckets: their rows stay the same when the fact grows, so does its memory."""
    assert [buckets_for(spark.range(n), rows=100, least=2) for n in (0, 200, 201, 2000)] == [2, 2, 3, 20]
    largest = []
    for n in (400, 1600):
        fact = open_snapshot(spark.range(n).select(F.col("id").alias("operation_id"), F.lit(dt.date(2024, 1, 1)).alias("fl_date")))
        out = BucketedSnapshot(spark, str(tmp_path / f"fact-{n}"), buckets=buckets_for(fact, rows=50, least=2))
        out.create(fact)
        out.apply(feeds(spark)[0])
        assert rows(out.view()) == rows(apply_completions(fact, feeds(spark)[0])[0])
        per_file = spark.read.parquet(str(tmp_path / f"fact-{n}" / "fact-000001")).groupBy(F.input_file_name()).count()
        largest.append(per_file.agg(F.max("count")).first()[0])
    assert largest[1] < 2 * largest[0] < 200
