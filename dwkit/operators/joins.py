"""Joins (JOIN-1..JOIN-13).

Broadcast policy: a side is hinted for broadcast only when its size is
proven bounded by construction (seed rows, a calendar of a bounded date
range).  Everything else is a plain equi join: the planner broadcasts only under ``autoBroadcastJoinThreshold`` (from
table statistics), AQE re-checks real sizes at run time, and AQE splits
skewed partitions of a hot key in sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.operators.windows import first_per_key

MATCH_FLAG = "__matched"


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def broadcast_if_small(df: DataFrame, decision: bool | None = None) -> DataFrame:
    """Broadcast only a side of a proven bound.

    * ``decision=True``: the side is bounded by construction (seed rows, a
      calendar of a bounded range): hint a broadcast.
    * ``decision=False``: never broadcast.
    * otherwise no hint: the planner broadcasts only when the estimated
      size (file statistics of a stored table) is under
      ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks the real
      size at run time (``spark.sql.adaptive.autoBroadcastJoinThreshold``);
      beyond either bound the join stays a shuffle join.
    """
    if decision is None:
        return df
    return F.broadcast(df) if decision else df


def prepare_operations(ops: DataFrame, delays: DataFrame, key: str = "operation_id",
                       parts: Sequence[str] = ()) -> DataFrame:
    """Operations left-joined to their 0..1 delay record (JOIN-1).

    Both sides are large and share the key, so this is a co-partitioned
    shuffle join; ``parts`` are null-filled to 0 afterwards (no delay record =
    no delay minutes).
    """
    d = delays.drop(*[c for c in delays.columns if c in ops.columns and c != key])
    out = ops.join(d, key, "left")
    return out.withColumns({p: F.coalesce(F.col(p), F.lit(0).cast(dict(out.dtypes)[p]))
                            for p in parts})


def reduce_reference(ref: DataFrame, on, take: Sequence[str],
                     order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` wins (Q2).

    The lookup cache of the warehouse keeps an arbitrary row of a duplicated
    key; here the choice is explicit and deterministic.
    """
    keys = _keys(on)
    cols = list(dict.fromkeys([*keys, *(order or []), *take]))
    return first_per_key(ref.select(*cols), keys, list(order or take)).select(*keys, *take)


def lookup_flagged(df: DataFrame, ref: DataFrame, on, take: Sequence[str],
                   order: Sequence[str] | None = None, ref_on=None,
                   broadcast: bool | None = None, flag: str = "matched") -> DataFrame:
    """Lookup as one frame with a boolean ``flag`` column (FLT-6): written
    once with ``sources.write_routed``, both branches come from one pass."""
    keys = _keys(on)
    rkeys = _keys(ref_on) if ref_on is not None else keys
    r = ref.select(*[F.col(a).alias(b) for a, b in zip(rkeys, keys)],
                   *[c for c in list(dict.fromkeys([*(order or []), *take])) if c not in rkeys])
    r = reduce_reference(r, keys, take, order).withColumn(MATCH_FLAG, F.lit(True))
    r = broadcast_if_small(r, broadcast)
    flagged = df.drop(*[c for c in take if c in df.columns]).join(r, keys, "left")
    return flagged.withColumn(flag, F.col(MATCH_FLAG).isNotNull()).drop(MATCH_FLAG)


def lookup(df: DataFrame, ref: DataFrame, on, take: Sequence[str],
           order: Sequence[str] | None = None, ref_on=None,
           broadcast: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Lookup with match / no-match outputs (JOIN-2).

    ``on`` names the key columns of ``df``; ``ref_on`` those of ``ref`` when
    they differ.  The reference is reduced to one row per key first, so a
    duplicated reference key never fans rows out.  A null key never matches.
    Returns ``(matched, unmatched)``: matched rows carry the ``take``
    columns, unmatched rows keep only the input columns.
    """
    flagged = lookup_flagged(df, ref, on, take, order, ref_on, broadcast, MATCH_FLAG)
    matched = flagged.where(F.col(MATCH_FLAG)).drop(MATCH_FLAG)
    unmatched = flagged.where(~F.col(MATCH_FLAG)).select(*df.columns)
    return matched, unmatched


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]],
         broadcast: bool | None = None) -> DataFrame:
    """Inner star join of the fact with each ``(dim, key)`` (JOIN-4)."""
    out = fact
    for dim, key in dims:
        out = out.join(broadcast_if_small(dim, decision=broadcast), key, "inner")
    return out


def join_role(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str, prefix: str,
              columns: Sequence[str] | None = None, how: str = "left",
              broadcast: bool | None = None) -> DataFrame:
    """Role-playing join: the same dimension under a column prefix (JOIN-11)."""
    cols = [c for c in (columns or dim.columns) if c != dim_key]
    d = dim.select(F.col(dim_key).alias(f"__{prefix}key"),
                   *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    d = broadcast_if_small(d, decision=broadcast)
    return (fact.join(d, fact[fk] == d[f"__{prefix}key"], how)
            .drop(f"__{prefix}key"))


def lookup_as_of(df: DataFrame, dim: DataFrame, key: str, ts: str,
                 take: Sequence[str], eff: str = "scd_effective_date",
                 exp: str = "scd_expiry_date", dim_key: str | None = None,
                 how: str = "left", broadcast: bool | None = None) -> DataFrame:
    """Point-in-time SCD2 lookup (JOIN-12): the version with
    ``eff <= ts < exp`` for the row's business key.

    The equi key makes this a hash/sort-merge join; the interval test is a
    join condition on the matching versions only (no range join needed, since
    versions of one key are few).
    """
    dk = dim_key or key
    d = dim.select(F.col(dk).alias("__asof_key"), F.col(eff).alias("__eff"),
                   F.col(exp).alias("__exp"), *take)
    d = broadcast_if_small(d, decision=broadcast)
    t = F.col(ts).cast("timestamp_ntz")
    cond = ((df[key] == d["__asof_key"]) & (d["__eff"].cast("timestamp_ntz") <= t)
            & (t < d["__exp"].cast("timestamp_ntz")))
    return df.join(d, cond, how).drop("__asof_key", "__eff", "__exp")


def assign_fk(df: DataFrame, dim: DataFrame, keys: Sequence[str], id_col: str,
              dim_keys: Sequence[str] | None = None) -> DataFrame:
    """Composite-key surrogate lookup with null-safe equality (JOIN-8).

    A null key part matches a null key part, as the text-joined key of the
    dataframe version did (``<NA>`` equals ``<NA>``).
    """
    dks = list(dim_keys or keys)
    d = dim.select(F.col(id_col), *[F.col(a).alias(f"__fk{i}") for i, a in enumerate(dks)])
    cond = reduce(lambda a, b: a & b,
                  [df[k].eqNullSafe(d[f"__fk{i}"]) for i, k in enumerate(keys)])
    return df.join(d, cond, "left").drop(*[f"__fk{i}" for i in range(len(dks))])


def map_values(df: DataFrame, col: str, ref: DataFrame, ref_key: str, ref_value: str,
               out: str, default: str | None = "Unknown",
               broadcast: bool | None = None) -> DataFrame:
    """Dictionary mapping with a default for unmapped values (JOIN-9)."""
    r = reduce_reference(ref.select(F.col(ref_key).alias("__mk"), F.col(ref_value).alias("__mv")),
                         "__mk", ["__mv"])
    r = broadcast_if_small(r, decision=broadcast)
    j = df.join(r, df[col] == r["__mk"], "left")
    val = F.col("__mv") if default is None else F.coalesce(F.col("__mv"), F.lit(default))
    return j.withColumn(out, val).drop("__mk", "__mv")


def orphans(child: DataFrame, key: str, parent: DataFrame, pkey: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent (JOIN-6)."""
    p = parent.select(F.col(pkey or key).alias("__pk")).distinct()
    c = child.where(F.col(key).isNotNull())
    return c.join(p, c[key] == p["__pk"], "left_anti")


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows whose key is in ``other`` (JOIN-7).  The keys of ``other`` are made
    distinct first, map-side: a hot key is one row per task, not all its rows."""
    return df.join(other.select(*_keys(on)).distinct(), _keys(on), "left_semi")


def bring(df: DataFrame, parent: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Left merge that copies measures from the parent (JOIN-10)."""
    return df.join(parent.select(key, *measures), key, "left")


def fk_spot_check(fact: DataFrame, links: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Chain of left joins bringing display columns for a spot check (JOIN-5)."""
    out = fact
    for dim, key, cols in links:
        out = out.join(dim.select(key, *cols), key, "left")
    return out


def check_lookup(src: DataFrame, code: Column | str, dim: DataFrame, dim_code: str) -> DataFrame:
    """Pre-load lookup validation: per distinct code, rows and PASS/FAIL (JOIN-13)."""
    c = F.col(code) if isinstance(code, str) else code
    agg = src.groupBy(c.alias("code")).agg(F.count(F.lit(1)).alias("row_count"))
    d = dim.select(F.col(dim_code).alias("code")).distinct().withColumn("__hit", F.lit(True))
    return (agg.join(d, "code", "left")
            .withColumn("status", F.when(F.col("__hit"), F.lit("PASS")).otherwise(F.lit("FAIL")))
            .drop("__hit"))
