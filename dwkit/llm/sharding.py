"""Contiguous shards of nearly equal bytes, from global prefix sums.

Rows are put into one global order (text digest, id), range-partitioned and
written once.  Each partition's totals give its offset (one row per partition);
a running sum inside the partition completes the global prefix sum.  The order is
then cut at equal byte targets, so every shard is a contiguous run of it.  Equal
texts stand side by side and stay in one shard, except a group of more than
``1 / whole`` of a shard's target: its rows are cut one by one, which keeps the
sizes near equal however large a group of copies is.

``place`` returns the documents, all columns kept, with their shard and slot;
``write`` stores them as one folder a shard, in the order of the slots; ``shard``
is the short form of ``place`` without texts.  The order is that of the texts' MD5,
so runs are contiguous in that order, not in the table's.

Only DataFrame functions are used.  The documents are written once with a row
number; sizes and digests are placed without the texts and joined back by that number.

Edge cases: a null text has no bytes (size 1, CRC 0) and stands with the empty
texts; repeated rows each get their own slot; null ids come first among equal
texts; an empty table gives no rows; a column of the documents that is named
``shard`` or ``slot`` is replaced, whatever other columns are named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwkit.llm.common import staged


def place(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", whole: int = 64) -> DataFrame:
    """The rows of ``docs`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in the shard).

    A row weighs its text's UTF-8 bytes plus 1.  A shard differs from the target
    (total / ``shards``) by at most ``1 / whole`` of it plus one row at each end.
    """
    held = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid")), "documents")
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    rows = staged(held.select(
        F.col("row")[id_col].alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.md5(text.cast("binary")).alias("digest"), "rid"), "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 1
    # No more than shards * whole groups can exceed that share of the total.
    large = (rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
             .where(F.col("bytes") * (shards * whole) > F.lit(total)).select("digest", F.lit(True).alias("split")))
    marked = rows.join(F.broadcast(large), "digest", "left").withColumn("split", F.coalesce("split", F.lit(False)))
    runs = staged(marked.repartitionByRange("digest", F.when(F.col("split"), F.col("id")),
                                            F.when(F.col("split"), F.col("rid")))
                  .withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (runs.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
               .select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")))
    inside = Window.partitionBy("part").orderBy("digest", "id", "rid")
    group = Window.partitionBy("part", "digest")
    start = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (runs.withColumns({"start": start, "pos": F.row_number().over(inside) - 1})
              .withColumn("start", F.when(F.col("split"), F.col("start")).otherwise(F.min("start").over(group)))
              .join(F.broadcast(offsets), "part"))
    at = (F.col("start") + F.col("bytes_before")).cast("decimal(38,0)")
    placed = staged(placed.select(
        "rid", (F.col("pos") + F.col("rows_before")).alias("at"),
        F.least(F.floor(at * shards / F.lit(total).cast("decimal(20,0)")), F.lit(shards - 1)).cast("int").alias("shard")), "shards")
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))
    slots = (placed.join(F.broadcast(first), "shard")
             .select("rid", F.col("shard").alias("_shard"), (F.col("at") - F.col("first")).cast("long").alias("_slot")))
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return (held.join(slots, "rid")
            .select(*[F.col("row")[c].alias(c) for c in own], F.col("_shard").alias("shard"), F.col("_slot").alias("slot")))


def write(docs: DataFrame, path: str, **how) -> None:
    """Store the placed documents under ``path``, one folder ``shard=N`` a shard; its files hold runs of slots in order."""
    (place(docs, **how).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", whole: int = 64) -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` per row of ``place``; ``size`` is what the row weighs."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return place(docs, shards, id_col, text_col, whole).select(
        id_col, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
