"""Incremental completion feed (STR-1).

New completion files arrive in a folder; each micro-batch is reduced to the
latest row per id (ACC-3) and written to ``log/batch_id=<n>`` (the completion
log).  Ids are compared with the fact when the log is read or compacted.

Each batch overwrites only its own ``batch_id`` folder, so a replay after a
failure (``foreachBatch`` is at-least-once) rewrites the same rows: the
effect is exactly once.  The fact itself is never rewritten per batch (at
100 TB that would be a full rewrite every few seconds).  Readers see the
accumulated state through ``completed_view`` (merge on read: the first
batch that completed an id wins, as in the batch update), and ``compact``
folds the log into a new fact version with the batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.operators.snapshot import COMPLETE, apply_completions, compute_process_hours, latest_completion
from dwkit.operators.windows import first_per_key
from dwkit.sources.reference import COMPLETION_SCHEMA


def _process_batch(log_path: str, key: str):
    """Log the batch's latest completion per id: work and writes grow with the
    batch, never with the fact.  A replayed batch overwrites its own folder."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        (latest_completion(batch, key).select(key, COMPLETE, F.lit(batch_id).cast("long").alias("batch_id"))
         .write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/batch_id={batch_id}"))
    return fn


def stream_completions(spark: SparkSession, source_dir: str, log_path: str, checkpoint: str,
                       key: str = "operation_id", schema=COMPLETION_SCHEMA,
                       max_files_per_trigger: int | None = None, available_now: bool = True,
                       timestamp_format: str = "yyyy-MM-dd HH:mm:ss"):
    """Start (and with ``available_now`` run to completion) the completion
    stream.  Returns the ``StreamingQuery``.

    Every id goes to the log; ids that are not in the fact never show in
    ``completed_view``, and ``compact``, which passes over the fact anyway,
    returns them as error rows.
    """
    r = (spark.readStream.schema(schema).option("header", True).option("mode", "FAILFAST")
         .option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    w = (r.csv(source_dir).writeStream
         .foreachBatch(_process_batch(log_path, key))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def completion_log(spark: SparkSession, log_path: str, key: str = "operation_id") -> DataFrame:
    """Effective completion per id: the one from the earliest batch."""
    log = spark.read.parquet(log_path)
    return first_per_key(log.select(key, "batch_id", COMPLETE), key, ["batch_id"]).select(key, COMPLETE)


def completed_view(fact: DataFrame, log: DataFrame, key: str = "operation_id") -> DataFrame:
    """Fact with completions applied at read time (first write wins)."""
    j = fact.join(log.withColumnRenamed(COMPLETE, "__log"), key, "left")
    j = j.withColumn(COMPLETE, F.coalesce(F.col(COMPLETE), F.col("__log"))).drop("__log")
    return compute_process_hours(j).select(*fact.columns)


def compact(fact: DataFrame, log: DataFrame, run_ts=None, key: str = "operation_id",
            stage_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Fold the (first-batch-wins) log into the next fact version with the
    batch operator (ACC-4); returns ``(new_fact, unknown_id_errors)``."""
    return apply_completions(fact, log, run_ts, key, stage_path=stage_path)
