import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dwkit.operators.snapshot import apply_completions as batch
from dwkit.operators.snapshot import open_snapshot
from dwkit.sources.manifest import ManifestTable, apply_completions

FEED = "operation_id long, accm_txn_complete_time timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def snapshot(spark, ids):
    rows = spark.createDataFrame([(i, (day(i % 90)).date()) for i in ids], "operation_id long, fl_date date")
    return open_snapshot(rows).withColumn("month_key", F.date_format("fl_date", "yyyyMM").cast("int"))


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_append_replace_and_earlier_versions(spark, tmp_path):
    t = ManifestTable(spark, str(tmp_path / "t"), "p")
    make = lambda *r: spark.createDataFrame(list(r), "x int, p int")
    assert t.version() == 0
    t.append(make((1, 1), (2, 2)))
    t.append(make((3, 2), (4, 3)))
    t.replace(make((9, 2)))
    t.append(make((5, 2)))
    t.append(make())
    got = lambda v=None, **kw: sorted(map(tuple, t.read(v, **kw).collect()))
    assert got() == [(1, 1), (4, 3), (5, 2), (9, 2)] and got(2) == [(1, 1), (2, 2), (3, 2), (4, 3)] and t.version() == 5
    assert got(periods=[2]) == [(5, 2), (9, 2)] and got(periods=[7]) == []
    for i in range(6):
        t.append(make((i, 9)))
    assert t.version() == 11 and t.read().where("p = 9").count() == 6
    with pytest.raises(Exception, match="already exists"):
        t._switch(t.entries(), 11)                                             # a second writer


def test_completions_rewrite_only_what_they_touch(spark, tmp_path):
    fact = snapshot(spark, range(300))
    t = ManifestTable(spark, str(tmp_path / "fact"), "month_key")
    t.append(fact)
    feed = spark.createDataFrame([(i, day(200)) for i in range(300) if i % 90 < 20] + [(7, day(201)), (99999, day(1)), (None, day(2))], FEED)
    want, want_errors = batch(fact, feed, day(300))
    errors = apply_completions(t, feed, day(300))
    assert rows(t.read()) == rows(want) and rows(errors) == rows(want_errors)
    old, new = ({(r.period, r.segment) for r in t.entries(v).collect()} for v in (1, 2))
    assert {p for p, _ in old - new} == {"202401"} and len(old & new) == 2        # only January has another segment
    apply_completions(t, feed, day(301))
    assert t.version() == 2                                                    # nothing to close: no new version


def test_update_that_fails_midway_changes_nothing(spark, tmp_path, monkeypatch):
    t = ManifestTable(spark, str(tmp_path / "fact"), "month_key")
    t.append(snapshot(spark, range(40)))
    before = rows(t.read())
    feed = spark.createDataFrame([(i, day(200)) for i in range(10)], FEED)

    def lost(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(t, "_switch", lost)
        with pytest.raises(RuntimeError):
            apply_completions(t, feed)
    os.makedirs(tmp_path / "fact" / "_manifests" / "000002")                   # and one that had begun its manifest
    assert rows(t.read()) == before
    os.rmdir(tmp_path / "fact" / "_manifests" / "000002")
    apply_completions(t, feed)
    assert t.read().where("accm_txn_complete_time IS NOT NULL").count() == 10
