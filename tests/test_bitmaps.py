import random

from dwkit.operators import bitmaps as B

MEMBERS = {"m": ["x", "y"], "n": ["z"]}


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, h int, x long, y int, z long")


def some(seed, n=600):
    r = random.Random(seed)
    key = lambda: r.choice([None, r.randint(-200, 400), r.randint(0, 70), 2**62 + r.randint(0, 5)])
    return [(r.choice(["a", "b", "c", None]), r.randint(0, 3), key(), r.choice([None, r.randint(-9, 80)]), key()) for _ in range(n)]


def brute(rows, by):
    out = {}
    for row in rows:
        s = out.setdefault(tuple(row[i] for i in by), (set(), set()))
        s[0].update(k for k in (row[2], row[3]) if k is not None)
        s[1].update(k for k in (row[4],) if k is not None)
    return {k: (len(m), len(n)) for k, (m, n) in out.items() if m or n}


def test_counts_roll_up_and_merge(spark):
    one, two = some(1), some(2, 50)
    s = B.state(frame(spark, one), ["g", "h"], MEMBERS)
    assert {(r.g, r.h): (r.m, r.n) for r in B.counts(s, ["g", "h"], ["m", "n"]).collect()} == brute(one, [0, 1])
    up = B.roll_up(s, ["g"])
    assert {(r.g,): (r.m, r.n) for r in B.counts(up, ["g"], ["m", "n"]).collect()} == brute(one, [0])
    both = B.merge(s, B.state(frame(spark, two), ["g", "h"], MEMBERS))
    assert {(r.g, r.h): (r.m, r.n) for r in B.counts(both, ["g", "h"], ["m", "n"]).collect()} == brute(one + two, [0, 1])
    assert {(): (r.m, r.n) for r in B.counts(B.roll_up(both, []), [], ["m", "n"]).collect()} == brute(one + two, [])


def test_common_members(spark):
    one, two = [("a", 0, 1, 2, 3), ("a", 0, 64, None, 5), ("b", 0, 9, 9, 9)], [("a", 0, 64, 2, 7), ("c", 0, 9, 9, 9)]
    a, b = (B.state(frame(spark, r), ["g"], MEMBERS) for r in (one, two))
    assert [tuple(r) for r in B.common(a, b, ["g"], ["m", "n"]).collect()] == [("a", 2, 0)]


def test_no_rows_and_no_sort_before_the_shuffle(spark):
    assert B.counts(B.state(frame(spark, []), ["g"], MEMBERS), ["g"], ["m", "n"]).count() == 0
    plan = B.state(frame(spark, some(3)), ["g"], MEMBERS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "SortAggregate" not in plan and "Expand" not in plan
