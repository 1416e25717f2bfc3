"""Rows that do not fit: capture, reasons, replay (SRC-1, SRC-9, ERR-1).

``read_checked`` reads a CSV source once, permissively: a row that does not fit the declared
schema keeps its raw text, its file and the start of the block it was read from.  All rows are written
once, partitioned by whether they fit, so the good rows and the others are scans of their own,
and no load stops for one row.  What is wrong with a row is found by parsing its raw text as
texts, and then each field alone with the reader's own options.

``Quarantine`` is a table of rejects that are tried again.  Each attempt writes a folder of its own
with a row for every reject it tried, and earlier ones are never rewritten; what holds for a
reject is its last row, so it counts once: ``open``, ``recovered`` or ``given up`` (after
``most`` attempts).  An attempt that fails midway leaves a folder without a marker, which the next one
overwrites.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwkit.functions.dates import ts_lit
from dwkit.operators.windows import latest_per_key
from dwkit.sources.files import is_complete, scratch_path, write_routed

RAW, FILE, BLOCK, FITS = "raw_row", "file", "block_start", "fits"
OPEN, RECOVERED, GIVEN_UP = "open", "recovered", "given up"
_ONE_FIELD = "\x01"                        # no separator of a field that is parsed alone


def read_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True, timestamp_format: str | None = None,
                 date_format: str | None = None, stage_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: typed rows, and ``(raw_row, reason, file, block_start)`` of the others."""
    formats = {k: v for k, v in (("timestampFormat", timestamp_format), ("timestampNTZFormat", timestamp_format), ("dateFormat", date_format)) if v}
    line = {"sep": sep, "escape": '"'}
    wide = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    rows = (spark.read.schema(wide).options(**line, **formats, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, columnPruning=False)
            .csv(path).select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))
            .withColumn(FITS, F.col(RAW).isNull()))
    to = stage_path or scratch_path(spark, "checked")
    write_routed(rows, FITS, to)
    stored = spark.read.schema(rows.schema).parquet(to)                       # no files to infer it from if the source is empty
    good, bad = (stored.where(F.col(FITS) == F.lit(fits)) for fits in (True, False))
    return good.select(*schema.names), bad.select(RAW, _reason(schema, line, formats).alias("reason"), FILE, BLOCK)


def _reason(schema: T.StructType, line: dict[str, str], formats: dict[str, str]) -> Column:
    texts = ", ".join(f"f{i} string" for i in range(len(schema.fields)))
    parsed = F.from_csv(F.col(RAW), f"{texts}, lost string", {**line, "columnNameOfCorruptRecord": "lost"})
    wrong = []
    for i, f in enumerate(schema.fields):
        value = parsed[f"f{i}"]
        alone = F.from_csv(value, f"v {f.dataType.simpleString()}", {**formats, "sep": _ONE_FIELD})["v"]
        if not isinstance(f.dataType, T.StringType):
            wrong.append(F.when(value.isNotNull() & alone.isNull(), F.concat(F.lit(f"{f.name}: '"), value, F.lit(f"' is no {f.dataType.simpleString()}"))))
    told = F.concat_ws("; ", F.when(parsed["lost"].isNotNull(), F.lit(f"not {len(schema.fields)} fields")), *wrong)
    return F.when(told == "", F.lit("does not fit the schema")).otherwise(told)


@dataclass
class Quarantine:
    """Rejects under ``path``: ``(reject_id, raw_row, reason, state, tries, attempted_at)`` and the attempt."""
    spark: SparkSession
    path: str
    most: int = 3

    def _folder(self, attempt: int) -> str:
        return f"{self.path.rstrip('/')}/attempt={attempt}"

    def attempts(self) -> int:
        n = 0
        while is_complete(self.spark, self._folder(n)):
            n += 1
        return n

    def _write(self, rows: DataFrame, attempt: int, run_ts) -> None:
        cols = ["reject_id", RAW, "reason", "state", "tries"]
        rows.select(*cols, ts_lit(run_ts).alias("attempted_at")).write.mode("overwrite").parquet(self._folder(attempt))

    def put(self, rejects: DataFrame, run_ts) -> None:
        """The rejects of a load, ``(reject_id, raw_row, reason)``; an id that is there already is left alone."""
        n = self.attempts()
        new = rejects.select("reject_id", RAW, "reason", F.lit(OPEN).alias("state"), F.lit(0).alias("tries"))
        if n:
            new = new.join(self.state().select("reject_id"), "reject_id", "left_anti")
        self._write(new, n, run_ts)

    def state(self) -> DataFrame:
        """The last row of every reject."""
        folders = [self._folder(i) for i in range(self.attempts())]
        log = self.spark.read.option("basePath", self.path).parquet(*folders)
        return latest_per_key(log, "reject_id", ["attempt"])

    def replay(self, load: Callable[[DataFrame], tuple[DataFrame, DataFrame]], run_ts) -> DataFrame:
        """Try the open rejects again and return the rows that loaded.

        ``load`` takes ``(reject_id, raw_row)`` and gives the loaded rows, with their ``reject_id``, and
        ``(reject_id, reason)`` of the others.  A reject in neither has failed for an unknown reason.
        The loaded rows are written before the attempt is logged."""
        n = self.attempts()
        waiting = self.state().where(F.col("state") == OPEN).select("reject_id", RAW, "tries")
        loaded, failed = load(waiting.select("reject_id", RAW))
        to = scratch_path(self.spark, "replayed")
        loaded.write.parquet(to)
        loaded = self.spark.read.parquet(to)
        again = (waiting.join(loaded.select("reject_id").distinct().withColumn("ok", F.lit(True)), "reject_id", "left")
                 .join(failed.groupBy("reject_id").agg(F.min("reason").alias("reason")), "reject_id", "left").withColumn("tries", F.col("tries") + 1))
        state = F.when(F.col("ok"), RECOVERED).when(F.col("tries") >= self.most, GIVEN_UP).otherwise(OPEN)
        self._write(again.select("reject_id", RAW, F.when(F.col("ok"), F.lit(None)).otherwise(F.coalesce("reason", F.lit("not loaded"))).alias("reason"),
                                 state.alias("state"), "tries"), n, run_ts)
        return loaded
