"""Aggregations (AGG-1..AGG-17).

All aggregates here are declarative: Spark runs them as a partial aggregate
before the shuffle and a final one after, so a hot grouping key costs one
partial row per input partition, not a third of the table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.functions.expr import pearson


def status_counts(df: DataFrame, flag: str = "cancelled", by: Sequence[str] = ()) -> DataFrame:
    """Operated / cancelled / total row counts (AGG-2)."""
    g = df.groupBy(*by) if by else df
    return g.agg(
        F.count_if(F.col(flag) == 0).alias("operated"),
        F.count_if(F.col(flag) == 1).alias("cancelled"),
        F.count(F.lit(1)).alias("total"),
    )


def measure_stats(df: DataFrame, measure: str, by: Sequence[str] = (), digits: int | None = 2) -> DataFrame:
    """MIN / MAX / AVG / count of a measure (AGG-3)."""
    avg = F.avg(measure)
    if digits is not None:
        avg = F.round(avg, digits)
    g = df.groupBy(*by) if by else df
    return g.agg(F.count(measure).alias("n"), F.min(measure).alias("min_value"),
                 F.max(measure).alias("max_value"), avg.alias("avg_value"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) > 1`` (AGG-6)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def value_counts(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Value frequencies with percent of all rows; null is a value (AGG-10).

    The row total is a scalar subquery, so neither a cross join nor an
    unpartitioned window is needed.  ``pct`` rounds half-even like the
    dataframe library did.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    vc = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return vc.withColumn("pct", F.bround(F.try_divide(F.col("count") * 100.0, total), digits).cast("double"))


def profile_values(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Value counts of several columns in one frame: column, value, count, pct (DQ-3).

    One scan: the columns are unpivoted to (column, value-as-text) rows and
    grouped once.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("__kv")).select("__kv.*")
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return vc.withColumn("pct", F.bround(F.try_divide(F.col("count") * 100.0, total), digits).cast("double"))


def correlation(df: DataFrame, a: str, b: str, digits: int | None = 4) -> DataFrame:
    """Pearson correlation over rows where both values are present (AGG-11)."""
    c = pearson(a, b)
    if digits is not None:
        c = F.round(c, digits)
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .agg(c.alias("correlation"), F.count(F.lit(1)).alias("pairs")))


def component_counts(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Rows with a non-zero value per component, and their share (AGG-15).

    One aggregate of ``count_if`` per column, then unpivot to rows.
    """
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.coalesce(F.col(c), F.lit(0)) > 0).alias(c) for c in cols])
    long = row.unpivot("__n", list(cols), "component", "non_zero")
    return long.select("component", F.col("non_zero").cast("long").alias("non_zero"),
                       F.bround(F.try_divide(F.col("non_zero") * 100.0, F.col("__n")), digits)
                       .cast("double").alias("pct"))


def completion_status(fact: DataFrame, complete: str = "accm_txn_complete_time",
                      hours: str = "txn_process_time_hours") -> DataFrame:
    """Completed / pending counts and percent complete as DECIMAL(5,2) (AGG-12)."""
    n = F.count(F.lit(1))
    done = F.count_if(F.col(complete).isNotNull())
    return fact.agg(
        n.alias("total_rows"),
        done.alias("completed"),
        F.count_if(F.col(complete).isNull()).alias("pending"),
        F.count_if(F.col(hours).isNotNull()).alias("with_hours"),
        F.try_divide(done * 100.0, n).cast("decimal(5,2)").alias("pct_complete"),
    )


def process_time_by(fact: DataFrame, keys: Sequence[str], hours: str = "txn_process_time_hours") -> DataFrame:
    """Process hours by keys: count, avg/min/max as DECIMAL(10,2) (AGG-5)."""
    d = "decimal(10,2)"
    return (fact.where(F.col(hours).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("completed"),
        F.avg(hours).cast(d).alias("avg_hours"),
        F.min(hours).cast(d).alias("min_hours"),
        F.max(hours).cast(d).alias("max_hours")))


def grouped(df: DataFrame, keys: Sequence[str | Column], aggs: dict[str, Column]) -> DataFrame:
    """GROUP BY plain columns or computed expressions (AGG-7)."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def distinct_count(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """COUNT DISTINCT per column in one aggregate (AGG-4)."""
    f = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(*[f(F.col(c)).alias(f"distinct_{c}") for c in cols])


def rollup_totals(df: DataFrame, levels: Sequence[str], aggs: dict[str, Column],
                  level_col: str = "level") -> DataFrame:
    """Subtotals for every prefix of ``levels`` plus the grand total (AGG-16).

    ``level`` is the number of grouped levels (0 = grand total), from
    ``grouping_id`` so a null member is never confused with a subtotal.
    """
    depth = F.lit(0)
    for c in levels:
        depth = depth + (F.lit(1) - F.grouping(c))
    return df.rollup(*levels).agg(*[c.alias(k) for k, c in aggs.items()],
                                  depth.cast("int").alias(level_col))
