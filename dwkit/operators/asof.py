"""Point-in-time join by merging events with versions (JOIN-12).

An interval join puts all events of a code into one task and pairs each with every version of
its code before it drops most pairs.  Here events and versions are one frame, ordered by time
within (key, part), and each event takes the last version before it by a running
``last_value``: one shuffle and one sort, whatever the number of versions.

A key with more than ``rows_per_task`` events is dealt to so many parts, each with a copy of the key's
versions.  There are at most (all events / ``rows_per_task``) such keys, so their table
is broadcast; counting them is a grouped sum that is combined before its shuffle.

A version holds from its start (that moment included) to its end (not included; null is
open).  Of versions of one key with the same start the one that ends last counts.  Events
without a key or a time match nothing; with ``how="left"`` they and all others without a version
stay, with nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwkit.operators.scd import EFF, EXP

ROWS_PER_TASK = 4_000_000


def merge_as_of(events: DataFrame, versions: DataFrame, key: str, ts: str, bring: Sequence[str], eff: str = EFF, exp: str | None = EXP,
                how: str = "left", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``events`` with the columns ``bring`` of the version that held at ``ts``."""
    if how not in ("left", "inner"):
        raise ValueError(f"how is 'left' or 'inner', not {how!r}")
    kind = "timestamp_ntz"
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    hot = (events.where(usable).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_task)
           .select("__key", F.ceil(F.col("__n") / rows_per_task).cast("long").alias("__parts")))
    parts = F.coalesce("__parts", F.lit(1).cast("long"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), F.col(key) == F.col("__key"), "left").withColumn("__parts", parts).drop("__key")

    own = F.struct(*[F.col(c) for c in events.columns])
    # Events without a key are their own parts, so that they do not meet in one task.
    e = dealt(events.withColumn("__any", F.xxhash64(*events.columns, F.monotonically_increasing_id()))).select(
        F.col(key).alias("__k"), F.when(usable, F.pmod("__any", "__parts")).otherwise(F.col("__any")).cast("long").alias("__part"),
        F.col(ts).cast(kind).alias("__t"), F.lit(1).alias("__kind"), F.lit(None).cast(kind).alias("__end"), own.alias("__event"))
    end = F.col(exp).cast(kind) if exp else F.lit(None).cast(kind)
    far = F.lit("9999-12-31 23:59:59").cast(kind)
    of = versions.where(F.col(key).isNotNull() & F.col(eff).isNotNull())
    v = dealt(of).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))).select(
        F.col(key).alias("__k"), "__part", F.col(eff).cast(kind).alias("__t"), F.lit(0).alias("__kind"), F.coalesce(end, far).alias("__end"),
        F.struct(*[F.col(c).alias(f"b_{i}") for i, c in enumerate(bring)], F.coalesce(end, far).alias("end")).alias("__version"))
    both = e.unionByName(v, allowMissingColumns=True)
    running = Window.partitionBy("__k", "__part").orderBy("__t", "__kind", "__end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (both.withColumn("__found", F.last("__version", ignorenulls=True).over(running)).where("__kind = 1")
             .withColumn("__found", F.when(F.col("__k").isNotNull() & (F.col("__t") < F.col("__found.end")), F.col("__found"))))
    if how == "inner":
        found = found.where("__found IS NOT NULL")
    return found.select("__event.*", *[F.col(f"__found.b_{i}").alias(c) for i, c in enumerate(bring)])
