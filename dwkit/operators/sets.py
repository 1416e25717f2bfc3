"""Set operations (SET-1..SET-3, AGG-8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.operators.windows import first_per_key


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name (SET-1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def entity_from_roles(df: DataFrame, roles: Sequence[Mapping[str, str]], key: str,
                      order: Sequence[str] | None = None) -> DataFrame:
    """One entity from columns playing several roles (SET-2).

    Each role maps entity column -> source column (e.g. origin and
    destination airport).  The roles are stacked with UNION ALL, null keys
    dropped, and one row per key is kept: the smallest ``order`` (default:
    the other entity columns) wins.  The de-duplication is a grouped
    aggregate, combined map-side.
    """
    cols = list(roles[0].keys())
    parts = [df.select(*[F.col(src).alias(dst) for dst, src in r.items()]) for r in roles]
    stacked = union_all(parts).where(F.col(key).isNotNull())
    return first_per_key(stacked, key, list(order or [c for c in cols if c != key]))


def dedup(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """DISTINCT on all or some columns (AGG-8)."""
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def missing_values(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Distinct values of ``col`` absent from ``ref`` (SET-3); nulls excluded."""
    vals = df.select(col).where(F.col(col).isNotNull()).distinct()
    return vals.join(ref.select(F.col(ref_col).alias(col)).distinct(), col, "left_anti")
