"""Completions that come before their operation (STR-1).

Operations and completions arrive in any order.  One record of state per operation id
holds what has come: an operation waits for its completion, a completion for its operation.

* Both are there: the pair goes out as ``closed``, once.  Of several completions in a
  micro-batch the latest counts, of several micro-batches the first, as in the batch update.
* A completion whose operation has not come ``wait`` after it was seen goes out as
  ``expired``: that is the quarantine.
* Whatever else has not been touched for ``wait`` is forgotten: operations that stay open
  (they are in the fact) and ids that are closed (kept until then, so that repeated completions find them).

So state holds the ids of the last ``wait`` and does not grow with the fact.  Time is that of
``seen``, the moment a record arrived, not of the events: timers run on its watermark.  A record
seen more than ``delay`` before the latest one may be dropped, as with any watermark.

``run`` takes a micro-batch as a set.  The stream reduces it to a row per id and arrival (``arrived``; Spark's
store holds these for about ``wait``), and one full outer join with the ids remembered gives the outcomes and
the new state of all ids (``step``), which are written beside the checkpoint.  ``match`` keeps the same
rules as an operator of one stream with a Python call per id and micro-batch: for few ids.

Results are written a folder per micro-batch, which a replay overwrites, and state is
restored from the checkpoint, so a restart gives the same rows.  ``closed`` has the columns that
``completions.completed_view`` and ``compact`` read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dwkit.operators.snapshot import COMPLETE, CREATE

OPERATION, COMPLETION = "operation", "completion"
CLOSED, EXPIRED = "closed", "expired"
_BEGUN, _CAME, _NEITHER = range(3)
_STATE = "created long, waiting long, closed boolean, seen long"              # microseconds
_REMEMBERED = ("created", "waiting", "closed", "seen", "until")
_WHOLE = 16                   # micro-batches after which all state is written, not only its changes


def _millis(wait: timedelta) -> int:
    return int(wait.total_seconds() * 1000)


def arrivals(operations: DataFrame, completions: DataFrame, key: str = "operation_id", created: str = CREATE, completed: str = COMPLETE,
             seen: str = "seen") -> DataFrame:
    """Both streams as one: ``(key, kind, at, seen)``."""
    def of(df: DataFrame, kind: str, at: str) -> DataFrame:
        return df.select(key, F.lit(kind).alias("kind"), F.col(at).cast("timestamp").alias("at"), F.col(seen).cast("timestamp").alias("seen"))
    return of(operations, OPERATION, created).unionByName(of(completions, COMPLETION, completed))


def _matcher(key: str, wait_ms: int):
    """Called once per id and micro-batch, so it works on plain numbers: what it costs is making frames, not matching."""
    def on(name: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        created, waiting, closed, seen = state.get if state.exists else (None, None, False, None)
        out = None
        if state.hasTimedOut:
            state.remove()
            if waiting is not None:
                out = (EXPIRED, None, waiting, seen)
        else:
            rows = [tuple(map(int, r)) for part in parts for r in part["record"].array]
            came = [at for kind, at, _ in rows if kind == _CAME]
            begun = [at for kind, at, _ in rows if kind == _BEGUN]
            arrived = [at for _, _, at in rows]
            first, last = min(arrived), max(arrived)
            created = min(begun) if created is None and begun else created
            if not closed and waiting is None and came:
                waiting, seen = max(came), first
            if not closed and created is not None and waiting is not None:
                out, closed, waiting = (CLOSED, created, waiting, last), True, None
            touched = last if waiting is None else seen           # a completion waits from when it was first seen
            state.update((created, waiting, closed, touched))
            state.setTimeoutTimestamp(max(touched // 1000 + wait_ms, state.getCurrentWatermarkMs() + 1))
        if out is not None:
            yield pd.DataFrame({key: [name[0]], "outcome": [out[0]], CREATE: [out[1]], COMPLETE: [out[2]], "seen": [out[3]]})
    return on


def match(records: DataFrame, wait: timedelta, delay: str = "0 seconds", key: str = "operation_id") -> DataFrame:
    """``(key, outcome, created, completed, seen)`` of a stream of ``arrivals``.

    The matcher reads one array of numbers a record, ``[kind, at, seen]`` in microseconds: each further column costs every
    call its conversion, a timestamp most of all (``seen`` stays as one, since the watermark needs it)."""
    kind = records.schema[key].dataType.simpleString()
    wait_ms = _millis(wait)
    at = F.unix_micros("at")
    code = F.when(at.isNull(), _NEITHER).when(F.col("kind") == COMPLETION, _CAME).when(F.col("kind") == OPERATION, _BEGUN).otherwise(_NEITHER)
    record = F.array(code.cast("long"), F.coalesce(at, F.lit(0).cast("long")), F.unix_micros("seen")).alias("record")
    matched = (records.where(F.col(key).isNotNull() & F.col("seen").isNotNull()).withWatermark("seen", delay).select(key, record, "seen").groupBy(key)
               .applyInPandasWithState(_matcher(key, wait_ms), f"{key} {kind}, outcome string, {CREATE} long, {COMPLETE} long, seen long",
                                       _STATE, "append", GroupStateTimeout.EventTimeTimeout))
    return matched.select(key, "outcome", *[F.timestamp_micros(c).alias(c) for c in (CREATE, COMPLETE, "seen")])


def arrived(records: DataFrame, wait: timedelta, delay: str = "0 seconds", key: str = "operation_id") -> DataFrame:
    """``(key, arrived, begun, came)`` of a stream of ``arrivals``: per id and moment of arrival its earliest operation and
    its latest completion, in microseconds.  A row seen again at the same moment comes with those before it, which changes
    nothing, as the first micro-batch counts."""
    at = F.unix_micros("at")
    rows = records.where(F.col(key).isNotNull() & F.col("seen").isNotNull()).select(
        key, "seen", F.unix_micros("seen").alias("arrived"), F.when(F.col("kind") == OPERATION, at).alias("begun"),
        F.when(F.col("kind") == COMPLETION, at).alias("came"))
    return (rows.withWatermark("seen", delay).groupBy(key, F.window("seen", f"{max(_millis(wait), 1)} milliseconds"), "arrived")
            .agg(F.min("begun").alias("begun"), F.max("came").alias("came")).select(key, "arrived", "begun", "came"))


def step(state: DataFrame, came: DataFrame, watermark: int, wait: timedelta, key: str = "operation_id") -> DataFrame:
    """The ids remembered (``state``) after a micro-batch of ``arrived`` rows, each with the outcome that it has now.

    ``touched`` rows are those that the micro-batch changed; an id without ``until`` is forgotten.  ``watermark`` and ``until`` are in milliseconds."""
    new = came.groupBy(key).agg(F.min("begun").alias("begun"), F.max("came").alias("came"), F.min("arrived").alias("first"), F.max("arrived").alias("last"))
    now, over = F.col("last").isNotNull(), F.col("last").isNull() & (F.col("until") < watermark)
    shut = F.coalesce("closed", F.lit(False))
    begins = ~shut & F.col("waiting").isNull() & F.col("came").isNotNull()
    j = state.join(new, key, "full").select(
        key, "last", "until", now.alias("now"), over.alias("over"), shut.alias("shut"), F.coalesce("created", "begun").alias("created"),
        F.when(begins, F.col("came")).otherwise(F.col("waiting")).alias("waiting"), F.when(begins, F.col("first")).otherwise(F.col("seen")).alias("seen"))
    waits = F.col("waiting").isNotNull()
    closes, expires = F.col("now") & ~F.col("shut") & F.col("created").isNotNull() & waits, F.col("over") & waits
    # A completion waits from when it was first seen; all else is kept from when it was last touched.
    seen = F.when(F.col("now") & (closes | ~waits), F.col("last")).otherwise(F.col("seen"))
    due = F.greatest(F.floor(seen.cast("decimal(20,0)") / 1000).cast("long") + _millis(wait), F.lit(watermark + 1))
    return j.select(
        key, (F.col("now") | F.col("over")).alias("touched"), F.when(closes, CLOSED).when(expires, EXPIRED).alias("outcome"),
        *[F.timestamp_micros(c).alias(name) for name, c in (("o_created", F.when(closes, F.col("created"))), ("o_completed", F.when(closes | expires, F.col("waiting"))),
                                                             ("o_seen", F.when(closes, F.col("last")).when(expires, F.col("seen"))))],
        "created", F.when(~closes, F.col("waiting")).alias("waiting"), (F.col("shut") | closes).alias("closed"), seen.alias("seen"),
        F.when(F.col("now"), due).when(~F.col("over"), F.col("until")).alias("until"))


def _slot(checkpoint: str, batch_id: int) -> str:
    """Folder of a micro-batch's changes of state; it is used again when nothing reads it any more."""
    return f"{checkpoint.rstrip('/')}/waiting/{batch_id % (2 * _WHOLE)}"


def _remembered(spark: SparkSession, checkpoint: str, batch_id: int, schema: str, key: str) -> DataFrame:
    """State before a micro-batch: of each id the last change since all ids were written."""
    since = (batch_id - 1) // _WHOLE * _WHOLE
    paths = [_slot(checkpoint, n) for n in range(since, batch_id)] if batch_id else []
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.range(0).select(F.lit(None).cast(f"struct<{schema}>").alias("r")).select("r.*")
    last = F.max_by(F.struct(*_REMEMBERED), "batch").alias("s")
    return rows.groupBy(key).agg(last).select(key, "s.*").where("until IS NOT NULL")


def _watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark of a micro-batch, from the checkpoint's log, so that a replay has the same."""
    if batch_id < 0:
        return 0
    log = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}").select(F.get_json_object("value", "$.batchWatermarkMs").cast("long").alias("ms"))
    return log.where("ms IS NOT NULL").first().ms


def run(records: DataFrame, wait: timedelta, out_path: str, checkpoint: str, delay: str = "0 seconds", key: str = "operation_id", available_now: bool = True):
    """Start (and with ``available_now`` run to the end) the stream; outcomes go to ``out_path/batch_id=<n>``.

    The changes of state go to a folder per micro-batch beside the checkpoint, and each ``_WHOLE`` micro-batches all of it does, so writes
    grow with the micro-batch.  Every read of it passes over the ids remembered, as looking for timers that are due does anyway."""
    kind = records.schema[key].dataType.simpleString()
    schema = ", ".join((f"{key} {kind}", "batch long", _STATE, "until long"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, slot = batch.sparkSession, _slot(checkpoint, batch_id)
        late, now = (_watermark(spark, checkpoint, n) for n in (batch_id - 1, batch_id))
        state = _remembered(spark, checkpoint, batch_id, schema, key)
        after = step(state, batch.where(F.col("arrived") > late * 1000), now, wait, key)
        kept = after if batch_id % _WHOLE == 0 else after.where("touched")
        kept.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(slot)
        names = {"o_created": CREATE, "o_completed": COMPLETE, "o_seen": "seen"}
        out = spark.read.parquet(slot).where("outcome IS NOT NULL").select(key, "outcome", *[F.col(c).alias(n) for c, n in names.items()])
        out.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
    w = arrived(records, wait, delay, key).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q


def outcomes(spark: SparkSession, out_path: str, outcome: str, key: str = "operation_id") -> DataFrame:
    """``closed`` pairs, or ``expired`` completions, of all micro-batches so far."""
    read = spark.read.parquet(out_path).where(F.col("outcome") == outcome)
    return read.select(key, F.col(CREATE).cast("timestamp_ntz").alias(CREATE), F.col(COMPLETE).cast("timestamp_ntz").alias(COMPLETE),
                       F.col("seen").cast("timestamp_ntz").alias("seen"), F.col("batch_id").cast("long").alias("batch_id"))
