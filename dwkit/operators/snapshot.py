"""Accumulating snapshot fact (ACC-1..ACC-9, PRJ-7).

Rows open with a create time and no completion; completion feeds close them.
The update is first-write-wins (an already completed row keeps its time), so
applying the same feed twice changes nothing and an at-least-once stream
sink is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.functions.dates import hours_between, ts_lit
from dwkit.operators.windows import latest_per_key, placed_with

CREATE, COMPLETE, HOURS = "accm_txn_create_time", "accm_txn_complete_time", "txn_process_time_hours"
UNKNOWN_ID = "operation_id not found in fact table"


def _ts(v) -> Column:
    if v is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return ts_lit(v)


def open_snapshot(fact: DataFrame, date_col: str = "fl_date") -> DataFrame:
    """Create = event date (never the load clock, SURVEY Q8), complete and
    hours null (ACC-1)."""
    return fact.withColumns({
        CREATE: F.col(date_col).cast("timestamp_ntz"),
        COMPLETE: F.lit(None).cast("timestamp_ntz"),
        HOURS: F.lit(None).cast("double"),
    })


def feed_stats(feed: DataFrame, key: str = "operation_id") -> DataFrame:
    """Staged rows, distinct ids and duplicate rows of a feed (ACC-2)."""
    return feed.agg(F.count(F.lit(1)).alias("staged_rows"),
                    F.count_distinct(key).alias("distinct_ids"),
                    (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_rows"))


def latest_completion(feed: DataFrame, key: str = "operation_id", ts: str = COMPLETE) -> DataFrame:
    """Latest completion per id (ACC-3): a duplicated id keeps its newest row
    (the warehouse deleted every copy instead, SURVEY Q4)."""
    return latest_per_key(feed.select(key, ts), key, ts)


def compute_process_hours(fact: DataFrame) -> DataFrame:
    """Hours for rows that have a completion but no hours yet (PRJ-7, ACC-6)."""
    todo = F.col(COMPLETE).isNotNull() & F.col(HOURS).isNull()
    return fact.withColumn(HOURS, F.when(todo, hours_between(CREATE, COMPLETE)).otherwise(F.col(HOURS)))


def apply_completions(fact: DataFrame, feed: DataFrame, run_ts=None, key: str = "operation_id",
                      batch_id: int | None = None, stage_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Close snapshot rows from a completion feed (ACC-3..ACC-6).

    Returns ``(new_fact, errors)``.  The feed is reduced to the latest row
    per id, matched to the fact by a left join (the fact is large: no
    broadcast; the planner decides), the completion is first-write-wins and
    hours are computed for newly closed rows only.  A null id in the fact
    stays a fact row; a null id in the feed becomes an error row.  Ids not in the fact go to
    ``errors`` with a reason and the capture time (and ``batch_id`` when
    streaming, so replays can be de-duplicated).  With ``stage_path`` the
    join result is written once and both outputs are read from it.
    """
    latest = latest_completion(feed, key).withColumnRenamed(COMPLETE, "__feed")
    # One full outer join serves both outputs: fact rows (matched or not)
    # and feed ids without a fact row.
    j = fact.withColumn("__fact", F.lit(True)).join(latest, key, "full")
    if stage_path:  # both outputs split from one stored join result
        from dwkit.sources.files import stage
        j = stage(j, stage_path)
    out = (j.where(F.col("__fact").isNotNull())
           .withColumn(COMPLETE, F.coalesce(F.col(COMPLETE), F.col("__feed"))))
    out = compute_process_hours(out).select(*fact.columns)
    errors = j.where(F.col("__fact").isNull()).select(
        F.col(key), F.col("__feed").alias(COMPLETE), F.lit(UNKNOWN_ID).alias("error_reason"),
        _ts(run_ts).alias("captured_at"),
        F.lit(batch_id).cast("long").alias("batch_id"))
    return out, errors


def apply_completions_placed(fact: DataFrame, feed: DataFrame, period: str, stage_path: str, run_ts=None,
                             key: str = "operation_id") -> tuple[DataFrame, DataFrame]:
    """``apply_completions`` for a fact that is written by ``period``: same rows.

    The feed meets only the fact's (key, period) columns; what it closes is moved
    together with the fact to the place by (period, key) that the write needs
    anyway (``placed_with``).  So the fact is moved once, not once for a join and
    again for the write, and the new fact is to be written as it is.  Only the
    narrow join is staged.
    """
    from dwkit.sources.files import stage
    latest = latest_completion(feed, key).withColumnRenamed(COMPLETE, "__feed")
    ids = fact.select(key, period, F.lit(True).alias("__fact"))
    found = stage(latest.join(ids, key, "left"), stage_path)
    both, group = placed_with(fact, found.where("__fact").select(period, key, "__feed"), [period, key])
    out = (both.withColumn("__feed", F.max("__feed").over(group)).where("__own IS NOT NULL")
           .select(period, key, "__feed", "__own.*")
           .withColumn(COMPLETE, F.coalesce(F.col(COMPLETE), F.col("__feed"))))
    errors = found.where("__fact IS NULL").select(
        F.col(key), F.col("__feed").alias(COMPLETE), F.lit(UNKNOWN_ID).alias("error_reason"),
        _ts(run_ts).alias("captured_at"), F.lit(None).cast("long").alias("batch_id"))
    return compute_process_hours(out).select(*fact.columns), errors


def error_summary(errors: DataFrame, key: str = "operation_id", ts: str = "captured_at") -> DataFrame:
    """Error-table summary: count, min/max id, first/last capture (ACC-9)."""
    return errors.agg(F.count(F.lit(1)).alias("error_rows"), F.min(key).alias("min_id"),
                      F.max(key).alias("max_id"), F.min(ts).alias("first_captured"),
                      F.max(ts).alias("last_captured"))



def apply_completions_in_place(fact_path: str, feed: DataFrame, period: str, stage_dir: str, run_ts=None,
                               key: str = "operation_id") -> DataFrame:
    """Completion update that rewrites only the fact partitions it touches.

    The fact at ``fact_path`` is partitioned by ``period``.  One left join of
    the latest feed row per id with the fact's ``(key, period)`` columns (two
    columns read) is staged once; it gives the matched completions, the
    unknown ids and the list of affected periods.  Only those partitions are
    read (semi join on the period list: partition pruning), updated
    first-write-wins, staged, and swapped in with dynamic partition
    overwrite, so no job reads and overwrites the same files and untouched
    periods are never rewritten.  Returns the unknown-id error rows.
    """
    from dwkit.sources.files import stage
    spark = feed.sparkSession
    fact = spark.read.parquet(fact_path)
    latest = latest_completion(feed, key).withColumnRenamed(COMPLETE, "__feed")
    ids = fact.select(key, F.col(period).alias("__period"))
    flagged = stage(latest.join(ids, key, "left"), f"{stage_dir.rstrip('/')}/matched")
    hits = flagged.where(F.col("__period").isNotNull())
    periods = hits.select(F.col("__period").alias(period)).distinct()
    affected = fact.join(periods, period, "left_semi")
    updated = (affected.join(hits.select(key, "__feed"), key, "left")
               .withColumn(COMPLETE, F.coalesce(F.col(COMPLETE), F.col("__feed"))).drop("__feed"))
    updated = compute_process_hours(updated).select(*fact.columns)
    staged = stage(updated, f"{stage_dir.rstrip('/')}/partitions")
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(period).parquet(fact_path))
    return flagged.where(F.col("__period").isNull()).select(
        F.col(key), F.col("__feed").alias(COMPLETE), F.lit(UNKNOWN_ID).alias("error_reason"),
        _ts(run_ts).alias("captured_at"), F.lit(None).cast("long").alias("batch_id"))
