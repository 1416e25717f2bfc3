"""Session helpers.

Operators never create or look up a session themselves; they take and return
DataFrames.  These helpers exist for tests, ``bench.py`` and the pipeline
``main``: a local session with the settings the library assumes, and the
shared checkpoint folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library is written against.  On a cluster the submitter sets
# these (plus executor sizing); locally they make small runs fast.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "dwkit", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("DWKIT_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf:
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="dwkit-ckpt-", dir="/tmp")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is; if it
    is missing there, this fails rather than fall back to a folder local to
    one machine.  Only a local-mode session (tests) without the setting gets
    a private scratch folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder (HDFS, object store, NFS)")
        d = tempfile.mkdtemp(prefix="dwkit-ckpt-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def cluster_conf(input_bytes: float, cores: int, target_partition_bytes: float = 256 * 1024 ** 2,
                 max_broadcast_bytes: float = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    * shuffle partitions: enough that a partition of the largest shuffle
      (about the input size after projection) is ~``target_partition_bytes``,
      and at least 3 waves of ``cores`` tasks; AQE coalesces small ones.
    * file splits of 256 MB (large sequential Parquet reads, few tasks).
    * AQE advisory size = the same target, skew splitting on: a partition
      five times the median and over 1 GB is split.
    * broadcast thresholds: the planner and AQE may broadcast tables up to
      ``max_broadcast_bytes`` (bounded, checked from file statistics and
      run-time sizes); everything larger stays a shuffle join.
    """
    parts = max(int(input_bytes / target_partition_bytes), 3 * cores)
    mb = int(target_partition_bytes // (1024 ** 2))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mb}m",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.autoBroadcastJoinThreshold": str(int(max_broadcast_bytes)),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(int(max_broadcast_bytes)),
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
