"""Keys and references found in the data instead of named by hand (DQ-4, DQ-5).

**References.**  Column a refers to column b if every value of a occurs in b.  All pairs are
found by one grouping: the distinct values of all columns, each with the set of columns that
hold it (a bit per column), and then for each column the intersection of the sets of all its
values.  Both steps are ``bit_or`` and ``bit_and`` of longs, combined before their shuffles, so a
value or a column of any number of rows is one row per task.  No pair of columns is joined.

**Minimal keys.**  Sets of columns are tried level by level; a set that holds a key is
not minimal and is left out, as is one whose columns have too few distinct values
for its rows.  The others are first looked at in a part of the table, all sets of a level in one grouping
by hash: the rows whose value of the set's widest column falls into one of ``2 ** bits`` parts, so that all
rows that could be equal in the set are there or none is.  Two equal rows, compared value by value, show that a set is no key.
A small table is its only part, and then no two equal hashes show a key; of a larger one only the sets that stand are grouped whole.

Values are compared within their family (whole numbers, fractions, texts, dates, times); nulls
are no values.  A key has no null in any of its columns.  A column without a value refers to
nothing; an empty table has no keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwkit.sources.files import scratch_path, stage

MASK = 63                 # columns of a word (the sign bit stays clear)
RSD = 0.02                # relative standard deviation of the distinct values of a column
PART_ROWS = 100_000       # rows of a part of a table, at least
PART_BITS = 6             # a part is a 64th of a large table
PART_FILES = 32           # a part's files, so that a small one is read by several tasks


def family(kind: T.DataType) -> str | None:
    """Values of one family can be equal; others are not compared."""
    if isinstance(kind, T.IntegralType):
        return "whole"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "fraction"
    if isinstance(kind, T.StringType):
        return "text"
    if isinstance(kind, T.DateType):
        return "date"
    return "time" if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else None


def references(tables: Mapping[str, DataFrame], families: Sequence[str] = ("whole", "text")) -> DataFrame:
    """``(dependent, referenced, n_values)``: all pairs of columns, named ``table.column``, of which the first refers to the second."""
    columns = [(f"{name}.{f.name}", df.select(F.lit(family(f.dataType)).alias("family"), F.col(f.name).cast("string").alias("value")))
               for name, df in tables.items() for f in df.schema.fields if family(f.dataType) in families]
    words = range((len(columns) + MASK - 1) // MASK)

    def marked(i: int, df: DataFrame) -> DataFrame:
        bits = [F.lit(1 << (i % MASK) if w == i // MASK else 0).cast("long").alias(f"w{w}") for w in words]
        return df.where("value IS NOT NULL").select("family", "value", *bits)
    every = reduce(DataFrame.unionByName, [marked(i, df) for i, (_, df) in enumerate(columns)])
    held = every.groupBy("family", "value").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in words])
    # For every column that holds the value: the columns that hold it.
    has = [F.when(F.col(f"w{i // MASK}").bitwiseAND(F.lit(1 << (i % MASK)).cast("long")) != 0, F.lit(i)) for i in range(len(columns))]
    own = held.select(F.explode(F.filter(F.array(*has), lambda x: x.isNotNull())).alias("i"), *[f"w{w}" for w in words])
    shared = own.groupBy("i").agg(F.count(F.lit(1)).alias("n_values"), *[F.bit_and(f"w{w}").alias(f"w{w}") for w in words])
    name = F.array(*[F.lit(n) for n, _ in columns])
    out = shared.select("i", "n_values", F.explode(F.filter(F.array(*has), lambda x: x.isNotNull())).alias("j")).where("i <> j")
    return out.select(F.get(name, F.col("i")).alias("dependent"), F.get(name, F.col("j")).alias("referenced"), "n_values")


def _in_part(column: str, bits: int) -> Column:
    return F.xxhash64(column).bitwiseAND((1 << bits) - 1) == 0


def _equal_rows(part: DataFrame, sets: Sequence[tuple[str, ...]], rows_of: Mapping[tuple[str, ...], Column]) -> dict[tuple[str, ...], bool]:
    """The sets in which rows of ``part`` (of each set those of ``rows_of``) have equal hashes, and whether two equal rows are known."""
    hashes = [F.xxhash64(*s) for s in sets]
    each = F.filter(F.array(*[F.when(rows_of[s], F.struct(F.lit(i).alias("i"), h.alias("h"))) for i, (s, h) in enumerate(zip(sets, hashes, strict=True))]),
                    lambda x: x.isNotNull())
    twice = part.select(F.explode(each).alias("x")).select("x.*").groupBy("i", "h").count().where("count > 1")
    found = {r.i: r.h for r in twice.groupBy("i").agg(F.min_by("h", "count").alias("h")).collect()}     # one hash of each set
    if not found:
        return {}
    same = {i: hashes[i] == h for i, h in found.items()}
    few = part.where(reduce(Column.__or__, same.values()))
    of = {i: F.when(same[i], F.struct(*sets[i])) for i in found}
    got = few.agg(*[(F.min(x) == F.max(x)).alias(f"e{i}") for i, x in of.items()]).first()
    return {sets[i]: bool(got[f"e{i}"]) for i in found}


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, most: int = 3, part_rows: int = PART_ROWS) -> list[tuple[str, ...]]:
    """All minimal sets of at most ``most`` columns whose values are unique and never null."""
    cols = list(columns or df.columns)
    # Rows, and of each column its values and about how many are distinct.
    first = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"v{i}") for i, c in enumerate(cols)],
                   *[F.approx_count_distinct(c, RSD).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    if not first.n:
        return []
    # Never null, so that sets can be compared by their distinct values alone; a constant adds nothing to a key.
    cols = {c: first[f"d{i}"] for i, c in enumerate(cols) if first[f"v{i}"] == first.n}
    bits, part, cut = min(PART_BITS, max(0, (first.n // part_rows).bit_length() - 1)), df, []
    found: list[tuple[str, ...]] = []
    for size in range(1, most + 1):
        tried = [s for s in combinations(cols, size) if not any(set(k) <= set(s) for k in found)]
        # Too few combinations of distinct values for the rows.
        tried = [s for s in tried if reduce(lambda x, c: x * cols[c] * (1 + 5 * RSD), s, 1.0) >= first.n]
        if not tried:
            continue
        widest = {s: max(s, key=cols.get) for s in tried}
        if bits and (more := sorted(set(widest.values()) - set(cut))):
            cut += more                                     # the columns of which a part is stored, all sets' columns with it
            rows = df.select(*cols).where(reduce(Column.__or__, [_in_part(c, bits) for c in cut]))
            part = stage(rows.repartition(PART_FILES), scratch_path(df.sparkSession, "key_parts"))
        equal = _equal_rows(part, tried, {s: _in_part(widest[s], bits) for s in tried})
        stand = [s for s in tried if not equal.get(s)]
        # Hashes of the whole table that all differ need no second look; equal ones of unequal rows do.
        found += [s for s in stand if (not bits and s not in equal) or df.groupBy(*s).count().where("count > 1").isEmpty()]
    return found
