"""Exact distinct counts that roll up (AGG-4 under AGG-16).

A distinct count of a month is not the sum of its days' counts.  Here the members of a
group are kept as a bitmap over their dense surrogate keys, in words of 64: one row
``(group, measure, word, bits)``, where bit k of word w stands for key 64 * w + k.  Words
of several groups, or of several loads, merge by ``bit_or``; a count is a sum of ``bit_count``.

The state is built by one scan.  ``bit_or`` of a long is combined by hash before the
shuffle, so what is shuffled is a row per word that a task has met, however many rows a
group holds.  (``bitmap_construct_agg`` would give bitmaps of 4 kB, but its buffer is
binary, and Spark sorts all rows for it, before the shuffle and after.)  Every further
level reads the level below it, not the table.

Null keys are no members; a group without members of a measure counts 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state(df: DataFrame, by: Sequence[str], members: Mapping[str, Sequence[str]]) -> DataFrame:
    """Bitmaps of each group of ``by``; ``members`` names each measure's key columns (several
    are counted as one set: an airport as origin or destination).  Keys are whole numbers."""
    keys = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(c).cast("long").alias("key")) for name, cols in members.items() for c in cols])
    rows = df.select(*by, F.inline(keys)).where("key IS NOT NULL")
    return (rows.groupBy(*by, "measure", F.shiftright("key", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 AS int))")).alias("bits")))


def roll_up(of: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same bitmaps by fewer, or coarser, columns."""
    return of.groupBy(*by, "measure", "word").agg(F.bit_or("bits").alias("bits"))


def merge(*states: DataFrame) -> DataFrame:
    """Bitmaps of several loads as one; what is stored of the earlier ones is not read from the table again."""
    every = reduce(DataFrame.unionByName, states)
    return roll_up(every, [c for c in every.columns if c not in ("measure", "word", "bits")])


def counts(of: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Exact distinct counts, a column per measure."""
    n = F.bit_count("bits").cast("long")
    return of.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("measure") == m, n)), F.lit(0)).alias(m) for m in measures])


def common(a: DataFrame, b: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Members that the groups of ``a`` share with the groups of ``b`` of the same ``by`` (groups that share none are left out)."""
    keys = [*by, "measure", "word"]
    both = a.select(*keys, F.col("bits").alias("x")).join(b.select(*keys, F.col("bits").alias("y")), keys)
    return counts(both.select(*keys, F.col("x").bitwiseAND(F.col("y")).alias("bits")).where("bits <> 0"), by, measures)
