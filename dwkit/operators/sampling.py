"""Sort, top-n and sampling (SORT-2..SORT-4, SAMP-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """``TOP n ... ORDER BY`` (SORT-2).  Planned as TakeOrderedAndProject:
    each task keeps n rows, the driver merges at most tasks * n."""
    return df.orderBy(*order).limit(n)


def seeded_hash(cols: Sequence[str], seed: int) -> Column:
    """MD5 of the seed and the key's values as text, so any engine can repeat it
    (null as an empty text)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).cast("binary"))


def random_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Repeatable "random" n rows (``ORDER BY NEWID()``, SORT-4): the n
    smallest seeded hashes of the key, ties broken by the key."""
    return df.orderBy(seeded_hash(key, seed), *[F.col(k) for k in key]).limit(n)


def _boundary(hist: DataFrame, stratum: str, bucket: str, need: str) -> DataFrame:
    """Per stratum, the first bucket whose running count reaches ``need`` and
    the count of rows in earlier buckets.  ``hist`` has one row per
    (stratum, bucket) with ``__c``; at most 65,536 buckets per stratum, so the
    per-stratum window is bounded."""
    w = Window.partitionBy(stratum).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    h = hist.withColumn("__cum", F.sum("__c").over(w))
    return (h.where((F.col("__cum") >= F.col(need)) & (F.col("__cum") - F.col("__c") < F.col(need)))
            .select(stratum, F.col(bucket).alias(f"{bucket}_cut"), (F.col("__cum") - F.col("__c")).alias(f"{bucket}_before"),
                    need))


def stratified_sample(df: DataFrame, stratum: str, frac: float, key: Sequence[str],
                      seed: int = 42) -> DataFrame:
    """Exact per-stratum fraction sample (SAMP-1).

    Stratum ``s`` with ``n_s`` rows contributes exactly
    ``bround(frac * n_s)`` rows (half-even, like the dataframe library): the
    rows with the smallest seeded hash of ``key`` (ties by ``key``, which
    should be unique).  ``sampleBy`` is only approximate.

    No sort of the table: a histogram of the top 16 hash bits per stratum
    (which also gives the stratum sizes) locates the bucket holding each
    stratum's cut-off, a histogram of the next 16 bits inside that bucket
    narrows it further, and only the rows of the final sub-bucket (about
    n / 2^32 of a stratum) are ranked.  The per-stratum cut tables (one row per
    stratum) are checkpointed so later steps do not recompute the histograms;
    they are joined without a hint, so any number of strata is fine.  Four column-pruned scans in all; a stratum holding half the
    table is handled like any other.
    """
    from dwkit.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    key = list(key)
    x = (df.withColumn("__h", seeded_hash(key, seed))
         .withColumn("__b1", F.substring("__h", 1, 4))
         .withColumn("__b2", F.substring("__h", 5, 4)))

    def on(a: DataFrame, b: DataFrame) -> DataFrame:
        bb = b.withColumnRenamed(stratum, "__s")
        return a.join(bb, a[stratum].eqNullSafe(bb["__s"])).drop("__s")

    # scan 1; at most 65,536 rows per stratum, kept so it is not recomputed
    h1 = x.groupBy(stratum, "__b1").agg(F.count(F.lit(1)).alias("__c")).checkpoint(eager=True)
    take = (h1.groupBy(stratum).agg(F.sum("__c").alias("__n"))
            .select(stratum, F.bround(F.col("__n") * F.lit(float(frac)), 0).cast("long").alias("__take"))
            .where(F.col("__take") > 0))
    cut1 = _boundary(on(h1, take), stratum, "__b1", "__take").checkpoint(eager=True)
    edge = on(x, cut1).where(F.col("__b1") == F.col("__b1_cut"))
    h2 = edge.groupBy(stratum, "__b2").agg(F.count(F.lit(1)).alias("__c"))               # scan 2
    need = cut1.select(stratum, (F.col("__take") - F.col("__b1_before")).alias("__need"))
    cut2 = _boundary(on(h2, need), stratum, "__b2", "__need")
    cuts = on(cut1.select(stratum, "__b1_cut"), cut2).checkpoint(eager=True)
    xc = on(x, cuts)
    inside = xc.where((F.col("__b1") < F.col("__b1_cut"))                                 # scan 3
                      | ((F.col("__b1") == F.col("__b1_cut")) & (F.col("__b2") < F.col("__b2_cut"))))
    last_w = Window.partitionBy(stratum).orderBy("__h", *key)
    last = (xc.where((F.col("__b1") == F.col("__b1_cut")) & (F.col("__b2") == F.col("__b2_cut")))  # scan 4
            .withColumn("__rn", F.row_number().over(last_w))
            .where(F.col("__rn") <= F.col("__need") - F.col("__b2_before")))
    cols = list(df.columns)
    return inside.select(*cols).unionByName(last.select(*cols))
