import datetime as dt
import random

import pytest

from dwkit.operators.asof import merge_as_of

DAY = dt.datetime(2020, 1, 1)
E, V = "code string, at timestamp_ntz, n int", "code string, name string, scd_effective_date timestamp_ntz, scd_expiry_date timestamp_ntz"


def day(n):
    return None if n is None else DAY + dt.timedelta(hours=n)


def brute(events, versions, how):
    out = []
    for code, at, n in events:
        best = max(((f, x or dt.datetime(9999, 12, 31, 23, 59, 59), name) for c, name, f, x in versions
                    if c == code and c is not None and f is not None and at is not None and f <= at), key=lambda r: r[:2], default=None)
        if best and at < best[1]:
            out.append((code, at, n, best[2]))
        elif how == "left":
            out.append((code, at, n, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_task", [7, 4_000_000])
def test_same_as_all_pairs(spark, rows_per_task):
    r = random.Random(6)
    versions, events = [], []
    for code, n in (("hot", 1000), ("b", 3), ("c", 1)):
        starts = sorted(r.sample(range(5000), n))
        for k, s in enumerate(starts):
            nxt = starts[k + 1] if k + 1 < n else None
            end = None if nxt is None else r.choice([nxt, nxt, s + 1])                      # some gaps
            versions.append((code, f"{code}{k}", day(s), day(end)))
    versions += [(None, "x", day(0), None), ("b", "y", None, None)]
    for i in range(600):
        code = r.choice(["hot"] * 8 + ["b", "c", "none", None])
        events.append((code, day(r.choice([None, r.randint(-50, 5100), r.choice([v[2] for v in versions if v[2]]).timestamp() // 3600 - DAY.timestamp() // 3600])), i))
    events += events[:5]
    e, v = spark.createDataFrame(events, E), spark.createDataFrame(versions, V)
    for how in ("left", "inner"):
        got = sorted(map(tuple, merge_as_of(e, v, "code", "at", ["name"], how=how, rows_per_task=rows_per_task).collect()), key=str)
        assert got == brute(events, versions, how)


def test_no_exchange_on_the_code_alone(spark):
    e, v = spark.createDataFrame([("a", day(1), 1)], E), spark.createDataFrame([("a", "x", day(0), None)], V)
    plan = merge_as_of(e, v, "code", "at", ["name"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    dealt = [(line, below) for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    assert any("__k#" in line and "__part#" in line for line, _ in dealt)
    assert all("__part#" in line or "partial_count" in below for line, below in dealt)      # rows never by the code alone, only their counts
    assert merge_as_of(e.limit(0), v, "code", "at", ["name"]).count() == 0 and merge_as_of(e, v.limit(0), "code", "at", ["name"]).first().name is None
