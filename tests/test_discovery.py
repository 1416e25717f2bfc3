import random
from itertools import combinations

from dwkit.operators.discovery import minimal_keys, references


def brute_keys(rows, names, most):
    keys = []
    for size in range(1, most + 1):
        for s in combinations(range(len(names)), size):
            if any(set(k) <= set(s) for k in keys):
                continue
            values = [tuple(r[i] for i in s) for r in rows]
            if rows and all(None not in v for v in values) and len(set(values)) == len(values):
                keys.append(s)
    return sorted(tuple(names[i] for i in k) for k in keys)


def test_minimal_keys_against_all_sets(spark):
    r = random.Random(2)
    names = list("abcde")
    for n, spread in ((0, 3), (1, 3), (30, 5), (200, 12), (400, 60)):
        rows = [(i if spread == 5 else r.randrange(spread), r.randrange(spread), r.randrange(2), r.choice([None] + [1] * 50) if spread == 12 else r.randrange(spread),
                 7) for i in range(n)]
        df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
        for most in (1, 3):
            assert sorted(minimal_keys(df, most=most)) == brute_keys(rows, names, most)


def test_references_against_all_pairs(spark):
    r = random.Random(3)
    tables = {}
    for t in range(5):
        rows = [tuple(r.choice([None, *range(k)]) for k in (3, 8, 20, 20)) for _ in range(r.choice([0, 5, 60]))]
        tables[f"t{t}"] = spark.createDataFrame([(*x[:3], str(x[3])) for x in rows], "a int, b long, c short, d string")
    wide = spark.createDataFrame([tuple(range(70))], ", ".join(f"x{i} int" for i in range(70)))
    tables["wide"] = wide
    values = {f"{t}.{f}": (kind, {x[f] for x in df.select(f).collect()} - {None}) for t, df in tables.items() for f, kind in df.dtypes}
    text = lambda kind: kind == "string"
    want = sorted((a, b, len(va)) for a, (ka, va) in values.items() for b, (kb, vb) in values.items()
                  if a != b and va and text(ka) == text(kb) and va <= vb)
    assert sorted(map(tuple, references(tables).collect())) == want and len(want) > 10


def _odd_table(spark, n=600):
    """a and (b, c) are keys; (b, d) is nearly one."""
    rows = [(i, i // 3, i % 3, float(i % 3 if i % 50 else 1), "x" * (i % 7)) for i in range(n)]
    names = list("abcde")
    return rows, names, spark.createDataFrame(rows, "a long, b long, c int, d double, e string").repartition(3)


def test_minimal_keys_by_parts(spark, monkeypatch):
    """Sets that equal rows of a part show to be no keys are not grouped whole; right in every part of a table."""
    rows, names, df = _odd_table(spark)
    want, whole, group = brute_keys(rows, names, 3), [], type(df).groupBy
    assert ("a",) in want and ("b", "c") in want and ("b", "d") not in want

    def spy(self, *columns):
        if columns and self is df:
            whole.append(tuple(columns))
        return group(self, *columns)
    monkeypatch.setattr(type(df), "groupBy", spy)
    for part_rows in (10, 100, 1000):
        whole.clear()
        assert sorted(minimal_keys(df, most=3, part_rows=part_rows)) == want
        assert part_rows < 1000 or not whole
        assert len([s for s in whole if s not in want]) <= 3


def test_minimal_keys_when_hashes_are_equal(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows, names, df = _odd_table(spark, 120)
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.crc32(F.concat_ws(",", *[F.col(x).cast("string") for x in c]).cast("binary")) % 16)
    for part_rows in (20, 1000):
        assert sorted(minimal_keys(df, most=3, part_rows=part_rows)) == brute_keys(rows, names, 3)
