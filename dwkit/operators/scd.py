"""Slowly changing dimensions (SCD-1..SCD-7).

A merge returns the complete new version of the dimension as a DataFrame;
the caller writes it to a new version folder (``sources.sinks.write_version``)
and never overwrites the folder it read from.  Both merges are one join of
the (small) dimension with the incoming batch; no per-row statements.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.functions.dates import ts_lit
from dwkit.operators.windows import first_per_key, with_surrogate
from dwkit.sources.files import scratch_path, stage

# Fixed values of the warehouse's SCD2 tracking columns.
OPEN_END = _dt.datetime(9999, 12, 31)
FIRST_EFFECTIVE = _dt.datetime(1900, 1, 1)
EFF, EXP, CUR = "scd_effective_date", "scd_expiry_date", "is_current_record"


def _ts(v) -> Column:
    return ts_lit(v)


def _same(cols: Sequence[str], a: str, b: str) -> Column:
    if not cols:
        return F.lit(True)
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def _key_match(keys: Sequence[str], a: str, b: str) -> Column:
    """Null-safe equality of business keys between aliases ``a`` and ``b``."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def _unique_batch(incoming: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                  order: Sequence[str] | None) -> DataFrame:
    """Reduce the batch to one row per key; the smallest ``order`` wins."""
    cols = [*keys, *attrs]
    if order:
        return first_per_key(incoming.select(*dict.fromkeys([*cols, *order])), keys, order).select(*cols)
    return first_per_key(incoming.select(*cols), keys, list(attrs))


def _staged_join(dim: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of a dimension (columns ``d_*``) with a batch (``i_*`` and
    the marker ``i___in``), written once: each output of a merge reads it, none
    joins again."""
    spark = dim.sparkSession
    d = dim.select(*[F.col(c).alias(f"d_{c}") for c in dim.columns])
    i = incoming.withColumn("__in", F.lit(True))
    i = i.select(*[F.col(c).alias(f"i_{c}") for c in i.columns])
    match = reduce(lambda x, y: x & y, [F.col(f"d_{k}").eqNullSafe(F.col(f"i_{k}")) for k in keys])
    return stage(d.join(i, match, "full"), scratch_path(spark, "merge"))


def current(dim: DataFrame, flag: str = CUR) -> DataFrame:
    """Current versions only (SCD-6)."""
    return dim.where(F.col(flag))


def history_of(dim: DataFrame, key: str, value) -> DataFrame:
    """All versions of one business key (FLT-5)."""
    return dim.where(F.col(key) == F.lit(value))


def scd1_merge(dim: DataFrame | None, incoming: DataFrame, key: Sequence[str] | str,
               attrs: Sequence[str], sk: str, order: Sequence[str] | None = None) -> DataFrame:
    """Type 1 upsert (SCD-1..SCD-3): matched keys take the incoming values,
    new keys are inserted with surrogate keys after ``max(sk)``, keys absent
    from the batch are left alone.  A re-run with the same batch is a no-op.
    """
    keys = [key] if isinstance(key, str) else list(key)
    attrs = list(attrs)
    inc = _unique_batch(incoming, keys, attrs, order)
    if dim is None:
        return with_surrogate(inc, sk, keys, start=1).select(sk, *keys, *attrs)
    # Null-safe key match: a null key part matches a null key part, as in
    # the composite-key lookup (JOIN-8).  The incoming side carries a marker
    # so a null attribute in the batch still overwrites (type 1 takes the
    # batch row as it is).
    j = _staged_join(dim.select(sk, *keys, *attrs), inc, keys)
    has = F.col(f"d_{sk}").isNotNull()
    kept = j.where(has).select(
        F.col(f"d_{sk}").alias(sk), *[F.col(f"d_{k}").alias(k) for k in keys],
        *[F.when(F.col("i___in"), F.col(f"i_{c}")).otherwise(F.col(f"d_{c}")).alias(c) for c in attrs])
    new = j.where(~has).select(*[F.col(f"i_{c}").alias(c) for c in [*keys, *attrs]])
    start = dim.select(F.coalesce(F.max(sk), F.lit(0)) + 1).scalar()
    inserted = with_surrogate(new, sk, [F.col(k).asc_nulls_first() for k in keys], start=start)
    return kept.unionByName(inserted.select(sk, *keys, *attrs))


def scd2_classify(dim: DataFrame, incoming: DataFrame, key: Sequence[str] | str,
                  tracked: Sequence[str], flag: str = CUR, order: Sequence[str] | None = None) -> DataFrame:
    """Per incoming key: ``new`` / ``changed`` / ``unchanged`` (SCD-5)."""
    keys = [key] if isinstance(key, str) else list(key)
    inc = _unique_batch(incoming, keys, tracked, order).alias("i")
    cur = current(dim, flag).select(*keys, *tracked).withColumn("__cur", F.lit(True)).alias("c")
    j = inc.join(cur, _key_match(keys, "i", "c"), "left")
    status = (F.when(F.col("c.__cur").isNull(), F.lit("new"))
              .when(_same(tracked, "i", "c"), F.lit("unchanged"))
              .otherwise(F.lit("changed")))
    return j.select(*[F.col(f"i.{k}").alias(k) for k in keys], *[F.col(f"i.{c}").alias(c) for c in tracked],
                    status.alias("scd_status"))


def scd2_merge(dim: DataFrame | None, incoming: DataFrame, key: Sequence[str] | str,
               tracked: Sequence[str], sk: str, run_ts,
               first_effective=FIRST_EFFECTIVE, open_end=OPEN_END,
               order: Sequence[str] | None = None) -> DataFrame:
    """Type 2 merge (SCD-4).

    * unchanged current rows (null-safe compare) and all history: kept;
    * changed: the current row is expired (``expiry = run_ts``, flag off) and
      a new version starts at ``run_ts``;
    * a key never seen before starts at ``first_effective`` (default
      1900-01-01) so point-in-time lookups of older events still resolve;
    * keys missing from the batch are left alone (no delete path).

    Current rows are found by the flag, never by a null expiry (SURVEY Q1),
    so a re-run with the same batch adds no rows.  All six tracking columns
    are written explicitly (Q21).
    """
    keys = [key] if isinstance(key, str) else list(key)
    tracked = list(tracked)
    cols = [sk, *keys, *tracked, EFF, EXP, CUR]
    run = _ts(run_ts)
    inc = _unique_batch(incoming, keys, tracked, order)
    if dim is None:
        first = inc.select(*keys, *tracked, _ts(first_effective).alias(EFF),
                           _ts(open_end).alias(EXP), F.lit(True).alias(CUR))
        return with_surrogate(first, sk, keys, start=1).select(*cols)

    hist = dim.where(~F.col(CUR))
    j = _staged_join(current(dim).select(*cols), inc.select(*keys, *tracked), keys)   # null-safe business keys
    has_cur = F.col(f"d_{sk}").isNotNull()
    has_in = F.col("i___in").isNotNull()
    same = reduce(lambda x, y: x & y, [F.col(f"d_{t}").eqNullSafe(F.col(f"i_{t}")) for t in tracked], F.lit(True))
    changed = has_cur & has_in & ~same

    c_cols = [F.col(f"d_{c}").alias(c) for c in [sk, *keys, *tracked, EFF]]
    untouched = j.where(has_cur & ~changed).select(*c_cols, F.col(f"d_{EXP}").alias(EXP), F.col(f"d_{CUR}").alias(CUR))
    expired = j.where(changed).select(*c_cols, run.alias(EXP), F.lit(False).alias(CUR))
    # A brand-new key may still have closed history (a key that was expired
    # and not re-opened is impossible here, but guard anyway): it starts at
    # first_effective only when no version of it exists.
    known = dim.select(*keys).distinct().withColumn("__known", F.lit(True)).alias("k")
    i_cols = [F.col(f"i_{c}").alias(c) for c in [*keys, *tracked]]
    fresh = j.where(~has_cur & has_in).select(*i_cols).alias("f")
    fresh = fresh.join(known, _key_match(keys, "f", "k"), "left").select(
        *[F.col(f"f.{k}").alias(k) for k in keys], *[F.col(f"f.{t}").alias(t) for t in tracked],
        F.when(F.col("k.__known").isNull(), _ts(first_effective)).otherwise(run).alias(EFF))
    reopened = j.where(changed).select(*i_cols, run.alias(EFF))
    inserts = fresh.unionByName(reopened).select(*keys, *tracked, EFF,
                                                 _ts(open_end).alias(EXP), F.lit(True).alias(CUR))
    start = dim.select(F.coalesce(F.max(sk), F.lit(0)) + 1).scalar()
    inserted = with_surrogate(inserts, sk, [F.col(k).asc_nulls_first() for k in keys], start=start).select(*cols)
    return (hist.select(*cols).unionByName(untouched.select(*cols))
            .unionByName(expired.select(*cols)).unionByName(inserted))


def with_default_member(dim: DataFrame, row: dict) -> DataFrame:
    """Add a "not applicable" member (e.g. key 0) unless its key exists (SCD-7)."""
    spark = dim.sparkSession
    types = dict(dim.dtypes)
    one = spark.range(0, 1, 1, 1).select(*[F.lit(row.get(c)).cast(types[c]).alias(c) for c in dim.columns])
    key = next(iter(row))
    return dim.unionByName(one.join(dim.select(key), key, "left_anti"))
