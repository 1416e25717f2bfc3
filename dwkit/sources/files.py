"""Scans and sinks (SRC-1..SRC-10).

Reads always take a declared schema (no inference; malformed rows fail the
job).  Writes never replace the folder they read from (but for the in-place
completion update, which repairs itself when repeated): a table is a base
folder holding numbered version folders, each completed version marked by a
``_SUCCESS`` file, and readers take the newest complete version.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             columns: Sequence[str] | None = None, timestamp_format: str | None = None,
             date_format: str | None = None, header: bool = True, sep: str = ",",
             mode: str = "FAILFAST") -> DataFrame:
    """Typed CSV scan (SRC-1..SRC-3); ``columns`` projects (pruned by the reader)."""
    r = (spark.read.schema(schema).option("header", header).option("sep", sep)
         .option("mode", mode).option("multiLine", False).option("escape", '"'))
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if date_format:
        r = r.option("dateFormat", date_format)
    df = r.csv(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, path_or_view: str, sql: str | None = None) -> DataFrame:
    """Whole table (Parquet folder, newest version, or a view) or a SQL command (SRC-4)."""
    if sql is not None:
        return spark.sql(sql)
    if "/" in path_or_view or path_or_view.endswith(".parquet"):
        v = latest_version(path_or_view, spark)
        return spark.read.parquet(v or path_or_view)
    return spark.table(path_or_view)


def convert_types(df: DataFrame, spec: Mapping[str, tuple[str, int | None]]) -> DataFrame:
    """Cast with length limits; a value longer than its limit fails the job
    (SRC-6: the conversions were set to fail, not to truncate)."""
    out = {}
    for c, (dtype, max_len) in spec.items():
        v = F.col(c).cast(dtype)
        if max_len is not None:
            v = F.when(F.length(v) > max_len,
                       F.raise_error(F.concat(F.lit(f"{c} longer than {max_len}: "), v))).otherwise(v)
        out[c] = v.cast(dtype)
    return df.withColumns(out)


def refresh(df: DataFrame, path: str) -> None:
    """Full refresh of a staging table: truncate then load (SRC-7)."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Bulk append (SRC-8)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def quarantine(errors: DataFrame, path: str) -> None:
    """Append reject rows to an error table (SRC-9)."""
    append(errors, path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with header (SRC-10); one file per task, written in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)


_V = re.compile(r"/v(\d{6})/")


def exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists, on any filesystem Spark can read (local,
    HDFS, object stores).  Readers check paths while the plan is analysed,
    so no job runs."""
    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise            # no permission, no network: not the same as not there


def is_complete(spark: SparkSession, path: str) -> bool:
    """A written table folder whose ``_SUCCESS`` marker exists."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the complete version folders under ``base``: one glob
    listing through Spark's file source (any filesystem), of which only the
    numbers reach the driver, then a direct check of each one's ``_SUCCESS``
    marker (hidden files are not listed by globs).  Only a folder that is not there means no version; any other error is raised."""
    try:
        files = spark.read.format("binaryFile").load(base.rstrip("/") + "/v*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    numbers = files.select(F.regexp_extract("path", _V.pattern, 1).alias("v")).where("v <> ''").distinct()
    found = sorted(int(r.v) for r in numbers.collect())
    return [v for v in found if is_complete(spark, f"{base.rstrip('/')}/v{v:06d}")]


def latest_version(base: str, spark: SparkSession | None = None) -> str | None:
    """Newest complete version folder of a table, or None."""
    spark = spark or SparkSession.getActiveSession()
    v = _versions(spark, base)
    return f"{base.rstrip('/')}/v{v[-1]:06d}" if v else None


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the next version of a table and return its folder.

    Merges (SCD, snapshot) read the current version and write the next one,
    so a failed job never leaves a half-replaced table; readers switch when
    the ``_SUCCESS`` marker appears.  Not atomic across several tables.
    """
    v = _versions(df.sparkSession, base)
    nxt = (v[-1] + 1) if v else 1
    path = f"{base.rstrip('/')}/v{nxt:06d}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh folder name under the shared checkpoint folder (created by the
    first write; never a machine-local temp folder)."""
    import uuid
    from dwkit.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back.  Used where one computed frame
    feeds several outputs (e.g. loaded rows and reject rows of a lookup
    chain), so the expensive joins run once, not once per output."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_routed(df: DataFrame, flag: str, path: str) -> None:
    """Write both outputs of a routing (FLT-6, JOIN-2) in one pass,
    partitioned by the boolean ``flag`` column; read a branch back with
    ``read_branch`` (partition pruning, no scan of the other branch)."""
    df.write.mode("overwrite").partitionBy(flag).parquet(path)


def read_branch(spark: SparkSession, path: str, flag: str, value: bool) -> DataFrame:
    """One branch of a routed table.  Partition discovery reads the flag
    back as text (``true``/``false``), so it is cast before comparing; the
    predicate is still a partition filter."""
    df = spark.read.parquet(path)
    return df.where(F.col(flag).cast("boolean") == F.lit(value)).withColumn(flag, F.col(flag).cast("boolean"))
