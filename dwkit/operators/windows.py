"""Window-style operators (WIN-1..WIN-5, AGG-9, SORT-5) written for skew.

* Latest/first row per key uses a grouped ``max``/``min`` of a struct whose
  leading fields are the ordering columns.  That is an ordinary aggregate, so
  Spark combines map-side before the shuffle: a key holding a third of the
  rows is reduced to one row per input partition instead of landing whole in
  one window task.
* Dense surrogate numbering never uses an unpartitioned window (which moves
  every row into one task): the frame is range-sorted across all tasks,
  checkpointed, counted per partition, and each partition adds the offset of
  the partitions before it.
* Top-k per group is ``row_number() <= k``; Spark inserts a partial
  per-task group limit before the shuffle, so a hot group ships k rows per
  task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dwkit.session import ensure_checkpoint_dir

_R = "__r"


def _pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], take_max: bool) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = [*order, *rest]
    if not fields:
        return df.select(*keys).distinct()
    if len(fields) == 1:
        # One value: a plain hash aggregate.  Nulls sort lowest, so they are the
        # smallest value where there are any and the largest only where all are.
        c = F.col(fields[0])
        least = F.when(F.count(c) == F.count(F.lit(1)), F.min(c))
        return df.groupBy(*keys).agg((F.max(c) if take_max else least).alias(fields[0])).select(*df.columns)
    s = F.struct(*[F.col(c) for c in fields])
    agg = F.max(s) if take_max else F.min(s)
    out = df.groupBy(*keys).agg(agg.alias(_R))
    return out.select(*keys, *[F.col(f"{_R}.{c}").alias(c) for c in fields]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1`` (WIN-1).

    Ties on ``order`` are broken by the remaining columns, descending; nulls
    sort lowest (``DESC NULLS LAST``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    return _pick_per_key(df, keys, order, take_max=True)


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """Distinct on ``keys`` keeping the row with the smallest ``order`` (AGG-9).

    Ties are broken by the remaining columns ascending; nulls sort first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    return _pick_per_key(df, keys, order, take_max=False)


def with_surrogate(df: DataFrame, name: str, order: Sequence[str | Column],
                   start: int | Column = 1, checkpoint: bool = True) -> DataFrame:
    """Dense ``start .. start + n - 1`` numbering by ``order`` (WIN-2).

    ``order`` should be unique for repeatable numbers.  ``start`` may be a
    column expression such as a scalar subquery (``max(sk) + 1``).  The sorted
    frame is checkpointed to the shared checkpoint folder so the count pass
    and the numbering pass see identical partitions even if an executor is
    lost in between; the offset table has one row per partition (bounded),
    so it is broadcast.
    """
    sorted_df = df.orderBy(*order)
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        sorted_df = sorted_df.checkpoint(eager=True)
    tagged = sorted_df.select("*", F.spark_partition_id().alias("__pid"),
                              F.monotonically_increasing_id().alias("__mid"))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    st = start if isinstance(start, Column) else F.lit(start)
    pos = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    out = (tagged.join(F.broadcast(offsets), "__pid")
           .withColumn(name, (F.coalesce(F.col("__off"), F.lit(0)) + pos + st).cast("long")))
    return out.select(name, *df.columns)


def placed_with(rows: DataFrame, values: DataFrame, place: Sequence[str]) -> tuple[DataFrame, WindowSpec]:
    """Rows and the values that belong to them, range-partitioned together by ``place``.

    ``values`` has the columns ``place`` and further ones, which the rows get as
    nulls.  The other columns of a row are the struct ``__own``, null on values, so that a
    value stays small where they are sorted.  The window by ``place`` that is
    returned needs no further exchange, and neither does a write by the first
    column of ``place``: where rows must get there anyway, narrow values come along
    instead of a join moving the wide rows once more.
    """
    own = F.struct(*[F.col(c) for c in rows.columns if c not in place])
    both = rows.select(*place, own.alias("__own")).unionByName(values, allowMissingColumns=True)
    return both.repartitionByRange(*place), Window.partitionBy(*place)


def surrogate_placed(df: DataFrame, name: str, period: str, key: str, start: int | Column = 1) -> DataFrame:
    """``with_surrogate(df, name, [key, period])``, placed by (``period``, ``key``) for a write by ``period``.

    Only the two columns are sorted and checkpointed; the numbers then move with the
    rows to their place.  ``df`` is read twice, so it should be stored; it has further columns.  Rows
    that agree in both columns get the group's numbers in any order.
    """
    numbers = with_surrogate(df.select(period, key), name, [key, period], start=start)
    both, group = placed_with(df, numbers, [period, key])
    # One order for both, so that the rows are sorted once.
    turn = group.orderBy(F.col("__own").isNull())
    least = F.min(name).over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (both.withColumn(name, least + F.row_number().over(turn) - 1).where("__own IS NOT NULL")
            .select(name, period, key, "__own.*").select(name, *df.columns))


def parallel_period(agg: DataFrame, year: str, keys: Sequence[str], measure: str,
                    lag: int = 1, prior: str | None = None, trend: str | None = None) -> DataFrame:
    """Same period ``lag`` years before, and ``trend = now - then`` (WIN-3).

    A self left join on ``year - lag`` rather than ``lag()``: a missing year
    must give null, not the previous present row.
    """
    prior = prior or f"{measure}_prior"
    trend = trend or f"{measure}_trend"
    keys = list(keys)
    before = agg.select(*keys, (F.col(year) + lag).alias(year), F.col(measure).alias(prior))
    out = agg.join(before, [*keys, year], "left")
    return out.withColumn(trend, F.col(measure) - F.col(prior))


def share(df: DataFrame, measure: str, part: Sequence[str] | None = None,
          out: str = "share") -> DataFrame:
    """``measure / total`` within ``part`` or over the whole frame (WIN-4).

    Without ``part`` the total is a scalar subquery (one extra aggregate job),
    not an unpartitioned window that would pull every row into one task.
    """
    if part:
        total = F.sum(measure).over(Window.partitionBy(*part))
    else:
        total = df.select(F.sum(measure)).scalar()
    return df.withColumn(out, F.try_divide(F.col(measure).cast("double"), total.cast("double")))


def ranked(df: DataFrame, measure: str, part: Sequence[str] | None = None,
           out: str = "rank", ascending: bool = False, dense: bool = False) -> DataFrame:
    """Rank within ``part`` by ``measure`` (WIN-5).

    With ``part`` this is a partitioned window.  A global rank counts the rows
    of each distinct value (a value of any number of rows is one row per
    task), range-sorts the distinct values over all tasks, and joins each
    value's rank back: one plus the rows (``dense``: the values) before it.
    Nulls rank last.
    """
    o = F.col(measure).asc_nulls_last() if ascending else F.col(measure).desc_nulls_last()
    if part:
        fn = F.dense_rank() if dense else F.rank()
        return df.withColumn(out, fn.over(Window.partitionBy(*part).orderBy(o)))
    values = df.groupBy(measure).agg((F.lit(1) if dense else F.count(F.lit(1))).cast("long").alias("__w"))
    v = running_before(values, "__w", out, o).select(F.col(measure).alias("__v"), (F.col(out) + 1).alias(out))
    return df.join(v, df[measure].eqNullSafe(v["__v"]), "left").drop("__v")


def running_before(df: DataFrame, weight: str, out: str, order: Column) -> DataFrame:
    """Sum of ``weight`` over all rows before each one by ``order`` (unique), without
    a window over the whole frame: rows are range-sorted and checkpointed, each
    partition's total gives the next one's start (one row per partition), and a
    window inside the partition does the rest."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.orderBy(order).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("__pid").agg(F.sum(weight).alias("__s")).select(
        "__pid", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("__run", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .join(F.broadcast(starts), "__pid")
            .withColumn(out, F.col("__start") + F.col("__run")).drop("__pid", "__run", "__start"))


def top_k_per_group(df: DataFrame, part: Sequence[str], k: int, order: Sequence[Column],
                    out: str | None = None) -> DataFrame:
    """Exact top ``k`` rows per group by ``order`` (SORT-5).

    ``order`` must be a total order (end it with unique columns).  Written
    as ``row_number() <= k``, which Spark plans with a partial
    ``WindowGroupLimit`` before the shuffle: every map task forwards at most
    ``k`` rows per group, so a group holding a third of the table costs
    ``k`` rows per task, not a third of the table in one task.
    """
    w = Window.partitionBy(*part).orderBy(*order)
    res = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)
    return res.withColumnRenamed("__rn", out) if out else res.drop("__rn")
