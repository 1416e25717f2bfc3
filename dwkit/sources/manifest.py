"""Partitioned tables whose updates switch by a manifest (ACC-4, SRC-7, SRC-8).

The rows of a table lie in segments, ``base/segment=<id>/<period>=<value>``; a manifest
says which segments hold which period.  An update writes a new segment with the periods that it
changes and then the next manifest; readers take the newest one whose ``_SUCCESS`` marker
exists.  So a reader sees a table before an update or after it, never between; an update that fails
leaves the old manifest and a segment that nobody reads; and nothing that is read is overwritten.

``append`` adds rows to periods, ``replace`` puts rows in the place of whole periods.  One writer
at a time: of two, the one that comes second finds its manifest's number taken and fails.  A manifest
has a row per (period, segment).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.functions.dates import ts_lit
from dwkit.operators.snapshot import COMPLETE, UNKNOWN_ID, compute_process_hours, latest_completion
from dwkit.sources.files import is_complete, scratch_path, stage


class ManifestTable:
    """The table under ``base``, in folders by ``period`` (a column of whole numbers or dates, without nulls)."""

    def __init__(self, spark: SparkSession, base: str, period: str) -> None:
        self.spark, self.base, self.period = spark, base.rstrip("/"), period

    def _manifest(self, n: int) -> str:
        return f"{self.base}/_manifests/{n:06d}"

    def version(self) -> int:
        """The newest manifest's number; 0 if there is none."""
        lo = 0
        step = 1
        while is_complete(self.spark, self._manifest(lo + step)):          # doubling, then halving: manifests are numbered without gaps
            lo, step = lo + step, 2 * step
        while step > 1:
            step //= 2
            if is_complete(self.spark, self._manifest(lo + step)):
                lo += step
        return lo

    def entries(self, version: int | None = None) -> DataFrame:
        """``(period, segment)`` of a manifest: which folders make up the table."""
        return self.spark.read.parquet(self._manifest(version or self.version()))

    def read(self, version: int | None = None, periods: Sequence | None = None) -> DataFrame:
        """The table as its newest manifest, or an earlier one, has it; ``periods`` reads only theirs."""
        rows = self.entries(version)
        if periods is not None:
            rows = rows.where(F.col("period").isin(*map(str, periods)))
        found = [f"{self.base}/segment={r.segment}/{self.period}={r.period}" for r in rows.collect()]
        schema = self.spark.read.parquet(f"{self.base}/_schema").schema
        if not found:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.option("basePath", self.base).schema(schema).parquet(*found)
        return stored.select(*schema.names)

    def _segment(self, df: DataFrame) -> DataFrame:
        """Write rows as a segment; its entries.  Rows are dealt by period and their own hash, so a large period is many files' work."""
        if not is_complete(self.spark, f"{self.base}/_schema"):
            df.limit(0).write.mode("overwrite").parquet(f"{self.base}/_schema")
        name = uuid.uuid4().hex[:12]
        df.repartitionByRange(self.period, F.xxhash64(*df.columns)).write.partitionBy(self.period).parquet(f"{self.base}/segment={name}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.base}/segment={name}")
        return written.select(F.col(self.period).cast("string").alias("period")).distinct().withColumn("segment", F.lit(name))

    def _switch(self, entries: DataFrame, version: int) -> None:
        entries.coalesce(1).write.mode("errorifexists").parquet(self._manifest(version))

    def append(self, df: DataFrame) -> int:
        """Add rows; the new version."""
        n = self.version()
        new = self._segment(df)
        self._switch(self.entries(n).unionByName(new) if n else new, n + 1)
        return n + 1

    def replace(self, df: DataFrame) -> int:
        """Put rows in the place of all rows of the periods that occur in them; the new version."""
        n = self.version()
        new = stage(self._segment(df), scratch_path(self.spark, "entries"))
        kept = self.entries(n).join(new.select("period"), "period", "left_anti") if n else new.limit(0)
        self._switch(kept.select("period", "segment").unionByName(new), n + 1)
        return n + 1


def apply_completions(table: ManifestTable, feed: DataFrame, run_ts=None, key: str = "operation_id") -> DataFrame:
    """Close rows of a stored snapshot from a feed, rewriting only the periods that it touches (ACC-4).

    One join of the feed's latest rows with the table's (id, period) columns gives the touched
    periods and the unknown ids; only those periods are read, and their new rows take their
    place by the next manifest.  A feed that closes nothing changes nothing.  Returns the error rows."""
    spark = table.spark
    latest = latest_completion(feed, key).withColumnRenamed(COMPLETE, "__feed")
    ids = table.read().select(key, F.col(table.period).alias("__period"), F.col(COMPLETE).isNull().alias("__open"), F.lit(True).alias("__fact"))
    found = stage(latest.join(ids, key, "left"), scratch_path(spark, "matched"))
    closing = found.where("__open")
    periods = [r[0] for r in closing.select("__period").distinct().collect()]          # at most the table's periods
    if periods:
        rows = table.read(periods=periods)
        new = rows.join(closing.select(key, "__feed"), key, "left").withColumn(COMPLETE, F.coalesce(COMPLETE, "__feed")).drop("__feed")
        table.replace(compute_process_hours(new).select(*rows.columns))
    return found.where("__fact IS NULL").select(key, F.col("__feed").alias(COMPLETE), F.lit(UNKNOWN_ID).alias("error_reason"),
                                                ts_lit(run_ts).alias("captured_at"), F.lit(None).cast("long").alias("batch_id"))
