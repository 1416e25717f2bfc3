"""Dimensions whose attributes change in different ways (SCD-4, SCD-5).

Each attribute of a dimension is of one change type:

* **fixed**: it never changes.  A batch row that changes one is rejected as a whole
  (nothing of it is applied), or the load stops (``fail_on_fixed``);
* **changing** (type 1): the new value overwrites the old one, in the current version
  or in all versions (``update_history``);
* **historical** (type 2): the current version is closed and a new one starts.

A row may change attributes of both kinds: the old version then takes the type 1 values
before it is closed.  An **inferred member** is a version that was inserted for a fact
whose dimension row had not come yet (``add_inferred``): keys only, marked by the column
``inferred``.  When its row comes, that version is completed in place: all attributes are
taken, whatever their type, the mark goes, and no new version starts.

``component`` classifies a batch into the six outputs of the dimension component from one
staged join of the current versions with the batch; ``merge`` applies them.  Comparisons
are null-safe, keys included; a repeated load changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.operators.scd import CUR, EFF, EXP, FIRST_EFFECTIVE, OPEN_END, _key_match, _staged_join, _ts, _unique_batch, current
from dwkit.operators.windows import with_surrogate

OUTPUTS = ("unchanged", "new", "fixed", "changing", "historical", "inferred")


class FixedAttributeChanged(ValueError):
    """A batch changes a fixed attribute and the dimension is set to stop there."""


@dataclass(frozen=True)
class ChangeTypes:
    """Business keys and the attributes by change type."""
    keys: Sequence[str]
    fixed: Sequence[str] = ()
    changing: Sequence[str] = ()
    historical: Sequence[str] = ()
    inferred: str | None = None          # boolean column that marks inferred members
    update_history: bool = False
    fail_on_fixed: bool = True

    @property
    def attrs(self) -> list[str]:
        return [*self.fixed, *self.changing, *self.historical]

    def columns(self, sk: str) -> list[str]:
        return [sk, *self.keys, *self.attrs, *([self.inferred] if self.inferred else []), EFF, EXP, CUR]


@dataclass
class Component:
    """The staged join, and the six outputs as DataFrames of the batch's rows with the names of
    the attributes that differ (``changed``).  A row that changes attributes of type 1 and 2 is in both outputs."""
    joined: DataFrame
    outputs: dict[str, DataFrame] = field(default_factory=dict)


def _differ(names: Sequence[str]) -> Column:
    return F.filter(F.array(*[F.when(~F.col(f"d_{c}").eqNullSafe(F.col(f"i_{c}")), F.lit(c)) for c in names]) if names
                    else F.array().cast("array<string>"), lambda c: c.isNotNull())


def component(dim: DataFrame, incoming: DataFrame, types: ChangeTypes, sk: str, order: Sequence[str] | None = None) -> Component:
    """Rows of a batch by what they mean for the dimension (SCD-5, all six outputs)."""
    keys, attrs = list(types.keys), types.attrs
    batch = _unique_batch(incoming, keys, attrs, order)
    joined = _staged_join(current(dim).select(*types.columns(sk)), batch.select(*keys, *attrs), keys)
    came, has = F.coalesce("i___in", F.lit(False)), F.col(f"d_{sk}").isNotNull()
    guess = F.coalesce(F.col(f"d_{types.inferred}"), F.lit(False)) if types.inferred else F.lit(False)
    judged = (joined.withColumns({"__fixed": _differ(types.fixed), "__changing": _differ(types.changing), "__historical": _differ(types.historical)})
              .withColumns({"__new": came & ~has, "__guess": came & has & guess, "__seen": came & has & ~guess})
              .withColumn("__rejected", F.col("__seen") & (F.size("__fixed") > 0)))
    open_ = F.col("__seen") & ~F.col("__rejected")
    judged = judged.withColumns({"__over": open_ & (F.size("__changing") > 0), "__version": open_ & (F.size("__historical") > 0)})
    when = {"unchanged": open_ & ~F.col("__over") & ~F.col("__version"), "new": F.col("__new"), "fixed": F.col("__rejected"),
            "changing": F.col("__over"), "historical": F.col("__version"), "inferred": F.col("__guess")}
    differ = {"fixed": F.col("__fixed"), "changing": F.col("__changing"), "historical": F.col("__historical"),
              "inferred": F.concat("__fixed", "__changing", "__historical")}
    none = F.array().cast("array<string>")
    return Component(judged, {name: judged.where(when[name]).select(*[F.col(f"i_{c}").alias(c) for c in [*keys, *attrs]],
                                                                    differ.get(name, none).alias("changed")) for name in OUTPUTS})


def merge(dim: DataFrame | None, incoming: DataFrame, types: ChangeTypes, sk: str, run_ts, first_effective=FIRST_EFFECTIVE,
          open_end=OPEN_END, order: Sequence[str] | None = None) -> tuple[DataFrame, Component | None]:
    """The new version of the dimension, and the outputs it was made from (None for the first load)."""
    keys, attrs, cols, run = list(types.keys), types.attrs, types.columns(sk), _ts(run_ts)
    known = [F.lit(False).alias(types.inferred)] if types.inferred else []
    if dim is None:
        first = _unique_batch(incoming, keys, attrs, order).select(*keys, *attrs, *known, _ts(first_effective).alias(EFF), _ts(open_end).alias(EXP),
                                                                   F.lit(True).alias(CUR))
        return with_surrogate(first, sk, [F.col(k).asc_nulls_first() for k in keys]).select(*cols), None

    found = component(dim, incoming, types, sk, order)
    if types.fail_on_fixed and (bad := found.outputs["fixed"].head(1)):
        raise FixedAttributeChanged(f"{bad[0].changed} of {[bad[0][k] for k in keys]} changed; the load stops")
    j, took = found.joined, F.col("__guess")

    def value(c: str) -> Column:
        new = took | F.col("__over") if c in types.changing else took
        return F.when(new, F.col(f"i_{c}")).otherwise(F.col(f"d_{c}")).alias(c)

    kept = j.where(F.col(f"d_{sk}").isNotNull()).select(
        F.col(f"d_{sk}").alias(sk), *[F.col(f"d_{k}").alias(k) for k in keys], *[value(c) for c in attrs],
        *([(F.col(f"d_{types.inferred}") & ~took).alias(types.inferred)] if types.inferred else []), F.col(f"d_{EFF}").alias(EFF),
        F.when(F.col("__version"), run).otherwise(F.col(f"d_{EXP}")).alias(EXP), (~F.col("__version")).alias(CUR))

    closed = dim.where(~F.col(CUR)).select(*cols)
    if types.update_history and types.changing:
        news = j.where("__over").select(*[F.col(f"i_{c}").alias(c) for c in [*keys, *types.changing]]).withColumn("__over", F.lit(True))
        both = closed.alias("h").join(news.alias("n"), _key_match(keys, "h", "n"), "left")
        closed = both.select(*[(F.when(F.col("n.__over"), F.col(f"n.{c}")).otherwise(F.col(f"h.{c}")) if c in types.changing else F.col(f"h.{c}")).alias(c)
                               for c in cols])

    # A key without a current version may have closed ones; only one never seen starts at the beginning.
    old = dim.where(~F.col(CUR)).select(*keys).distinct().withColumn("__old", F.lit(True))
    batch = [F.col(f"i_{c}").alias(c) for c in [*keys, *attrs]]
    fresh = j.where("__new").select(*batch).alias("f").join(old.alias("o"), _key_match(keys, "f", "o"), "left").select(
        *[F.col(f"f.{c}").alias(c) for c in [*keys, *attrs]], F.when(F.col("o.__old"), run).otherwise(_ts(first_effective)).alias(EFF))
    opened = fresh.unionByName(j.where("__version").select(*batch, run.alias(EFF)))
    opened = opened.select(*keys, *attrs, *known, EFF, _ts(open_end).alias(EXP), F.lit(True).alias(CUR))
    start = dim.select(F.coalesce(F.max(sk), F.lit(0)) + 1).scalar()
    inserted = with_surrogate(opened, sk, [F.col(k).asc_nulls_first() for k in keys], start=start).select(*cols)
    return closed.unionByName(kept.select(*cols)).unionByName(inserted), found


def add_inferred(dim: DataFrame, keys_seen: DataFrame, types: ChangeTypes, sk: str, first_effective=FIRST_EFFECTIVE, open_end=OPEN_END) -> DataFrame:
    """The dimension with an inferred member for every key of ``keys_seen`` that it has no version of."""
    if types.inferred is None:
        raise ValueError("inferred members need a column that marks them")
    keys, kinds = list(types.keys), dict(dim.dtypes)
    seen, have = keys_seen.select(*keys).distinct(), dim.select(*keys).distinct()
    lost = seen.alias("s").join(have.alias("d"), _key_match(keys, "s", "d"), "left_anti")
    empty = lost.select(*keys, *[F.lit(None).cast(kinds[c]).alias(c) for c in types.attrs], F.lit(True).alias(types.inferred),
                        _ts(first_effective).alias(EFF), _ts(open_end).alias(EXP), F.lit(True).alias(CUR))
    start = dim.select(F.coalesce(F.max(sk), F.lit(0)) + 1).scalar()
    return dim.select(*types.columns(sk)).unionByName(with_surrogate(empty, sk, [F.col(k).asc_nulls_first() for k in keys], start=start)
                                                      .select(*types.columns(sk)))
