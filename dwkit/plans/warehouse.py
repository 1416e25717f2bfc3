"""The warehouse built from the driver's tables (fixture roles).

``build`` feeds the fixture flat table, completion feed and region
reference to ``pipeline.run``.  Every output table is written once as
Parquet under the session's checkpoint folder (the shared folder named by
``spark.checkpoint.dir`` on a cluster) and read back, which cuts lineage and
lets report queries read stored warehouse tables, as a BI tool would.
Region misses are loaded with the default region (and quarantined), so the
only fact rejects are orders without lines (FIXTURES.md part B).
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession

from dwkit.plans import fixtures as fx
from dwkit.plans.pipeline import current_load, run
from dwkit.session import ensure_checkpoint_dir

def _code_version() -> str:
    """Hash of the library source: stored tables of an older build are never reused."""
    h = hashlib.sha1()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for d, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:12]


BUILD_VERSION = _code_version()

FACT_PARTITION = "month"

_lock = threading.RLock()
_memo: dict[tuple[str, str], dict[str, DataFrame]] = {}          # by application, not by the session's address
_roots: dict[tuple[str, str], str] = {}


def table_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a stored warehouse table (after ``build``)."""
    build(spark, sf_dir)
    return f"{current_load(spark, _roots[(spark.sparkContext.applicationId, os.path.abspath(sf_dir))])}/{name}"


def build(spark: SparkSession, sf_dir: str, run_ts=fx.RUN_TS) -> dict[str, DataFrame]:
    with _lock:
        return _build(spark, sf_dir, run_ts)


def _build(spark: SparkSession, sf_dir: str, run_ts) -> dict[str, DataFrame]:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key in _memo:
        return _memo[key]
    tag = hashlib.sha1(f"{BUILD_VERSION}|{os.path.abspath(sf_dir)}|{run_ts}".encode()).hexdigest()[:12]
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse-{tag}"
    _roots[key] = root
    out = run(spark, fx.flat_operations(spark, sf_dir), fx.completion_feed(spark, sf_dir),
              fx.region_reference(spark, sf_dir), root, run_ts, unmatched_airports="default",
              fact_partition=FACT_PARTITION)
    _memo[key] = out
    return out
