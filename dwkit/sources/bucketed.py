"""An accumulating snapshot in buckets by id (ACC-4, JOIN-2).

The fact is stored in ``buckets`` buckets by its id, each one sorted file.  A feed that is
dealt to as many buckets joins it without an exchange, or a sort, of the fact.  An update
does not rewrite the fact: it writes the rows that it closes, (id, completion), in the same
buckets beside it, and readers join those in, again bucket by bucket.  ``compact`` folds
them into a next version of the fact, for which nothing is shuffled either.

Tables are external ones under ``path`` (a shared folder) and known to the session's catalog
under a name made from it; a later session finds them by their folders.  A folder without a
``_SUCCESS`` marker is no table, so a job that fails leaves what there was.

An id closes once (first feed wins; of a feed's rows for one id the latest), a feed that is applied
again closes nothing, and ids that the fact does not hold are returned as error rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.functions.dates import ts_lit
from dwkit.operators.snapshot import COMPLETE, UNKNOWN_ID, compute_process_hours, latest_completion
from dwkit.sources.files import is_complete, scratch_path, stage


ROWS_PER_BUCKET = 100_000


def buckets_for(fact: DataFrame, rows: int = ROWS_PER_BUCKET, least: int = 8) -> int:
    """How many buckets hold about ``rows`` rows each: a task joins and sorts whole buckets, so their number has to grow with the fact."""
    return max(least, -(-fact.count() // rows))


class BucketedSnapshot:
    """The snapshot under ``path``; ``buckets`` is fixed when it is created."""

    def __init__(self, spark: SparkSession, path: str, key: str = "operation_id", buckets: int = 512) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _folder(self, kind: str, version: int, n: int = 0) -> str:
        return f"{self.path}/fact-{version:06d}" if kind == "fact" else f"{self.path}/closed-{version:06d}-{n:06d}"

    def _version(self) -> int:
        v = 0
        while is_complete(self.spark, self._folder("fact", v + 1)):
            v += 1
        return v

    def _updates(self, version: int) -> Iterator[str]:
        n = 1
        while is_complete(self.spark, folder := self._folder("closed", version, n)):
            yield folder
            n += 1

    def _table(self, folder: str) -> DataFrame:
        """The table of a folder, which is made known to the catalog if it is not."""
        name = f"dwkit_{hashlib.sha1(folder.encode()).hexdigest()[:20]}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(folder).schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name)

    def _write(self, df: DataFrame, folder: str, dealt: bool = False) -> None:
        name = f"dwkit_{hashlib.sha1(folder.encode()).hexdigest()[:20]}"
        rows = df if dealt else df.repartition(self.buckets, self.key)          # one file per bucket
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (rows.write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", folder).format("parquet").saveAsTable(name))

    def create(self, fact: DataFrame) -> None:
        """The first version, or, if there is one, the next."""
        self._write(fact, self._folder("fact", self._version() + 1))

    def stored(self) -> DataFrame:
        """The fact as it was last written whole."""
        return self._table(self._folder("fact", self._version()))

    def _closed(self) -> DataFrame:
        """The fact with the completions of all updates, hours not computed yet."""
        version = self._version()
        out = self._table(self._folder("fact", version))
        columns = out.columns
        for folder in self._updates(version):
            new = self._table(folder).select(self.key, F.col(COMPLETE).alias("__new"))
            out = out.join(new, self.key, "left").withColumn(COMPLETE, F.coalesce(COMPLETE, "__new")).select(*columns)
        return out

    def view(self) -> DataFrame:
        """The fact as it is now."""
        return compute_process_hours(self._closed())

    def apply(self, feed: DataFrame, run_ts=None) -> DataFrame:
        """Close rows from a feed; returns the error rows of ids that the fact does not hold."""
        latest = latest_completion(feed, self.key).withColumnRenamed(COMPLETE, "__feed").repartition(self.buckets, self.key)
        state = self._closed().select(self.key, F.lit(True).alias("__fact"), F.col(COMPLETE).isNull().alias("__open"))
        found = stage(latest.join(state, self.key, "left"), scratch_path(self.spark, "bucketed"))
        closing = found.where("__open").select(self.key, F.col("__feed").alias(COMPLETE))
        version = self._version()
        self._write(closing, self._folder("closed", version, 1 + sum(1 for _ in self._updates(version))))
        return found.where("__fact IS NULL").select(self.key, F.col("__feed").alias(COMPLETE), F.lit(UNKNOWN_ID).alias("error_reason"),
                                                    ts_lit(run_ts).alias("captured_at"), F.lit(None).cast("long").alias("batch_id"))

    def compact(self) -> None:
        """Fold all updates into the next version of the fact; its buckets stay where they are."""
        self._write(self.view(), self._folder("fact", self._version() + 1), dealt=True)
