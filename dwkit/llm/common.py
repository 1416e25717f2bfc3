"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwkit.sources.files import scratch_path, stage

SPACE = r"[ \t-\r]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder of ``spark.checkpoint.dir`` and
    read it back: cuts lineage, survives executor loss, gives file statistics."""
    return stage(df, scratch_path(df.sparkSession, name))


def hash_sample(df: DataFrame, n: int, *key: str) -> DataFrame:
    """The ``n`` rows with the smallest hashes of ``key`` (all rows if there are no more).

    Only hashes below a cut that leaves over twice as many rows are sorted, so what
    the tasks send for the final choice does not grow with their number.  Rows of equal
    keys pass or miss the cut together, so it is raised until ``n`` rows are below it."""
    total = df.count()
    if total <= n:
        return df
    h, cut = F.xxhash64(*key), int(((2 * n + 100) / total) * 2**64) - 2**63
    while cut < 2**63:
        some = df.where(h < F.lit(cut))
        if some.count() >= n:
            return some.orderBy(h, *key).limit(n)
        cut = 8 * (cut + 2**63) - 2**63
    return df.orderBy(h, *key).limit(n)


def sample_of_each(df: DataFrame, numbers: Callable[[dict], dict], by: str, *key: str) -> DataFrame:
    """Of each value of ``by`` the rows with the smallest hashes of ``key``: as many as ``numbers``
    says for it, given the rows of all values (all rows of a value that has no more).

    As in ``hash_sample``, only hashes below a cut are ranked; ``by`` is not null and has few values."""
    total = {v: n for v, n in df.groupBy(by).count().collect()}
    if not total:
        return df.limit(0)
    want, h, top = {v: min(n, total[v]) for v, n in numbers(total).items()}, F.xxhash64(*key), 2**63 - 1
    cuts = {v: min(top, int(((2 * n + 100) / total[v]) * 2**64) - 2**63) for v, n in want.items()}

    def below() -> DataFrame:
        rows = df.sparkSession.createDataFrame([(v, cuts[v], want[v]) for v in want], f"_of {df.schema[by].dataType.simpleString()}, _cut long, _n long")
        return df.join(F.broadcast(rows), F.col(by) == F.col("_of")).where(h <= F.col("_cut"))
    while True:
        got = {v: n for v, n in below().groupBy(by).count().collect()}
        short = [v for v in want if got.get(v, 0) < want[v] and cuts[v] < top]
        if not short:
            break
        cuts |= {v: min(top, 8 * (cuts[v] + 2**63) - 2**63) for v in short}
    rank = F.row_number().over(Window.partitionBy(by).orderBy(h, *key))
    return (below().withColumn("_rank", rank).where((F.col("_rank") <= max(want.values())) & (F.col("_rank") <= F.col("_n")))
            .drop("_of", "_cut", "_n", "_rank"))


BATCH_ROWS = 1_000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after making sure that the session hands texts to Python ``BATCH_ROWS``
    rows at a time at most (Spark's default of 10,000 long texts can fill an
    executor, once in each of its tasks); a smaller setting is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, BATCH_ROWS)
    return df


def per_text(of: Callable[[str | None], Any], kind: str, text: Column) -> Column:
    """``of`` applied to every text; only a few texts of a batch are Python objects at a time."""
    result = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}[kind]

    @F.arrow_udf(kind)
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in it:
            parts = [batch.slice(at, 256) for at in range(0, len(batch), 256)]
            yield pa.array([of(x) for part in parts for x in part.to_pylist()], result)
    return run(text)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list, as ``(node, component)`` with the
    smallest node of each component; nodes without an edge are not listed.

    Alternating large-star and small-star contraction: every round is two
    grouped minima and two equi-joins, and only a count and a checksum reach the
    driver.  The edges of each step and the minima are written to the shared
    folder: both sides of a join are then plain scans, so Spark can split a
    centre with very many edges over tasks.
    The number of rounds grows with the logarithm of the longest path.  Null
    ends and loops are ignored; an empty list gives an empty result.
    """
    hi, lo = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    cur = staged(edges.where(F.col(a) != F.col(b)).select(hi, lo).distinct(), "edges")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    before = mark(cur)
    while before[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "edges")
        large = staged(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "edges")
        small = (large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        cur = staged(small.distinct(), "edges")
        after = mark(cur)
        if tuple(after) == tuple(before):
            break
        before = after
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
