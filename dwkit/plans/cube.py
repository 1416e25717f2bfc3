"""Declarative cube model compiled to DataFrame plans (OLAP-1..OLAP-13).

A cube is a fact table, dimensions (each possibly playing several roles),
attributes, hierarchies and measures.  A query names attributes as
``"role.attribute"``; only the dimensions it touches are joined, each
filtered *before* the join (so a slice shrinks the broadcast side and,
with a date-partitioned fact, enables dynamic partition pruning).  Base
measures are additive aggregates; derived measures (ratios) are computed
after aggregation, so subtotals are never averages of averages.

Hierarchy levels group by the full key path (year, quarter, month), never
by a display name alone, so "January" of two years stays two members and
months sort by number (SURVEY Q13, Q14).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.operators.joins import broadcast_if_small
from dwkit.operators.windows import parallel_period


@dataclass(frozen=True)
class Attribute:
    """A dimension attribute: grouping ``key``, display ``name`` column,
    sort ``order`` column (OLAP-12)."""
    name: str
    key: str
    display: str | None = None
    order: str | None = None
    visible: bool = True


@dataclass(frozen=True)
class Hierarchy:
    """Ordered levels from coarse to fine (OLAP-2, OLAP-3)."""
    name: str
    levels: tuple[str, ...]


@dataclass(frozen=True)
class Dimension:
    name: str
    table: DataFrame
    key: str
    attributes: tuple[Attribute, ...]
    hierarchies: tuple[Hierarchy, ...] = ()
    bounded: bool | None = None  # True: size bounded by construction, broadcast freely
    grows: bool = False          # grows with the fact: facts are grouped by its key before it is joined

    def attribute(self, name: str) -> Attribute:
        for a in self.attributes:
            if a.name == name:
                return a
        raise KeyError(f"{self.name} has no attribute {name}")


@dataclass(frozen=True)
class Role:
    """A dimension used through one fact foreign key (role-playing, JOIN-11)."""
    name: str
    dimension: Dimension
    fact_key: str
    # extra (fact column, dimension column) equi keys, e.g. the fact's
    # partition column, so the join can prune fact partitions dynamically
    also: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Measure:
    """Additive base measure: ``sum`` of a column, ``count`` of rows,
    ``count_if`` of a condition, ``min``/``max`` (AGG-13, AGG-14)."""
    name: str
    kind: str = "sum"
    column: str | None = None
    condition: Column | None = None

    def agg(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1)).alias(self.name)
        if self.kind == "count_if":
            return F.count_if(self.condition).alias(self.name)
        if self.kind == "count_nonnull":
            return F.count(F.col(self.column)).alias(self.name)
        fn = {"sum": F.sum, "min": F.min, "max": F.max}[self.kind]
        return fn(F.col(self.column)).alias(self.name)


@dataclass(frozen=True)
class Derived:
    """Measure computed from aggregated base measures (ratios, averages)."""
    name: str
    needs: tuple[str, ...]
    expr: Callable[[], Column]


@dataclass(frozen=True)
class Kpi:
    """Value, goal, status and trend (OLAP-10).  ``value`` names a measure;
    ``goal`` names a measure or is a constant."""
    name: str
    value: str
    goal: str | float
    year_attr: str = "date.year"


@dataclass
class CubeModel:
    fact: DataFrame
    roles: Sequence[Role]
    measures: Sequence[Measure]
    derived: Sequence[Derived] = field(default_factory=tuple)
    kpis: Sequence[Kpi] = field(default_factory=tuple)

    # -- resolution -------------------------------------------------------------
    def role(self, name: str) -> Role:
        for r in self.roles:
            if r.name == name:
                return r
        raise KeyError(f"no role {name}")

    def _attr(self, ref: str) -> tuple[Role, Attribute]:
        role, attr = ref.split(".", 1)
        r = self.role(role)
        return r, r.dimension.attribute(attr)

    @staticmethod
    def col_name(ref: str) -> str:
        return ref.replace(".", "_")

    def hierarchy(self, role: str, name: str) -> list[str]:
        r = self.role(role)
        for h in r.dimension.hierarchies:
            if h.name == name:
                return [f"{role}.{lvl}" for lvl in h.levels]
        raise KeyError(f"{role} has no hierarchy {name}")

    # -- plan -------------------------------------------------------------------
    def frame(self, attrs: Sequence[str], filters: Mapping[str, object] | None = None) -> DataFrame:
        """Fact joined to the dimensions the attributes and filters need.

        Each dimension is filtered first, projected to the needed columns
        under the role prefix, and joined inner on its key.
        """
        filters = dict(filters or {})
        need: dict[str, set[str]] = {}
        for ref in [*attrs, *filters]:
            r, a = self._attr(ref)
            cols = need.setdefault(r.name, set())
            cols.add(a.key)
        out = self.fact
        for role_name, cols in need.items():
            r = self.role(role_name)
            d = r.dimension.table
            for ref, v in filters.items():
                rr, a = self._attr(ref)
                if rr.name == role_name:
                    d = d.where(F.col(a.key).isin(*v) if isinstance(v, (list, tuple, set))
                                else F.col(a.key) == F.lit(v))
            extra = [(fc, dc) for fc, dc in r.also if fc in out.columns]
            d = d.select(F.col(r.dimension.key).alias(f"__k_{role_name}"),
                         *[F.col(dc).alias(f"__k_{role_name}_{i}") for i, (_, dc) in enumerate(extra)],
                         *[F.col(c).alias(f"{role_name}_{c}") for c in sorted(cols)])
            d = broadcast_if_small(d, decision=True if r.dimension.bounded else None)
            cond = out[r.fact_key] == d[f"__k_{role_name}"]
            for i, (fc, _) in enumerate(extra):
                cond = cond & (out[fc] == d[f"__k_{role_name}_{i}"])
            out = out.join(d, cond, "inner").drop(f"__k_{role_name}",
                                                  *[f"__k_{role_name}_{i}" for i in range(len(extra))])
        return out

    def _group_cols(self, f: DataFrame, attrs: Sequence[str]) -> tuple[DataFrame, list[str], list]:
        """Add one column per attribute named ``role_attr`` (the key) and
        return (frame, key names, [])."""
        names, add = [], {}
        for ref in attrs:
            r, a = self._attr(ref)
            n = self.col_name(ref)
            if n != f"{r.name}_{a.key}":
                add[n] = F.col(f"{r.name}_{a.key}")
            names.append(n)
        return (f.withColumns(add) if add else f), names, []

    def _measures(self, names: Sequence[str]) -> tuple[list[Column], list[tuple[str, Column]]]:
        base = {m.name: m for m in self.measures}
        der = {d.name: d for d in self.derived}
        wanted_base: list[str] = []
        post: list[tuple[str, Column]] = []
        for n in names:
            if n in base:
                wanted_base.append(n)
            elif n in der:
                wanted_base.extend(x for x in der[n].needs if x not in wanted_base)
                post.append((n, der[n].expr()))
            else:
                raise KeyError(f"no measure {n}")
        return [base[n].agg() for n in dict.fromkeys(wanted_base)], post

    def _merge(self, cells: DataFrame, names: Sequence[str]) -> list[Column]:
        kinds = {m.name: m.kind for m in self.measures}
        return [{"min": F.min, "max": F.max}.get(kinds[c], F.sum)(c).alias(c) for c in cells.columns if c not in names]

    def _cells(self, rows: Sequence[str], aggs: Sequence[Column], filters: Mapping[str, object] | None) -> DataFrame:
        """Base measures by attributes.  A dimension that grows with the fact is joined
        to facts grouped by its key, not to the facts (unless it is filtered: then it comes
        first, to leave facts out)."""
        filtered = {ref.split(".", 1)[0] for ref in filters or {}}
        late = {r.name: r for ref in rows if (r := self._attr(ref)[0]).dimension.grows and r.name not in filtered}
        early = [ref for ref in rows if ref.split(".", 1)[0] not in late]
        f, names, _ = self._group_cols(self.frame(early, filters), early)
        if not late:
            return f.groupBy(*names).agg(*aggs)
        keys = list(dict.fromkeys(r.fact_key for r in late.values()))
        cells = CubeModel(f.groupBy(*names, *keys).agg(*aggs), list(late.values()), ())
        joined, others, _ = cells._group_cols(cells.frame([ref for ref in rows if ref not in early]), [ref for ref in rows if ref not in early])
        measures = [c for c in cells.fact.columns if c not in (*names, *keys)]
        order = [self.col_name(ref) for ref in rows]
        return joined.select(*names, *others, *measures).groupBy(*order).agg(*self._merge(joined.select(*measures), ()))

    def query(self, rows: Sequence[str], measures: Sequence[str], filters: Mapping[str, object] | None = None,
              totals: str | None = None, sort: bool = False) -> DataFrame:
        """Measures by attributes.  ``totals``: None (plain GROUP BY),
        ``"rollup"`` (hierarchy prefixes, AGG-16) or ``"cube"`` (all
        combinations, AGG-17); subtotal rows carry ``grouping_id``.  With
        ``sort`` the (small) result is ordered by the attributes' keys, so
        months come in calendar order, not by name (OLAP-12, SURVEY Q14)."""
        names = [self.col_name(ref) for ref in rows]
        aggs, post = self._measures(measures)
        out = self._cells(rows, aggs, filters)
        if totals is not None:
            # Base measures are additive: group the fact to the finest members
            # once, then expand that small result, not the fact's rows.
            g = out.rollup(*names) if totals == "rollup" else out.cube(*names)
            out = g.agg(*self._merge(out, names), F.grouping_id().alias("grouping_id"))
        out = self._with_display(out, rows)
        for n, e in post:
            out = out.withColumn(n, e)
        return out.orderBy(*[F.col(n).asc_nulls_last() for n in names]) if sort else out

    def _with_display(self, out: DataFrame, rows: Sequence[str]) -> DataFrame:
        """Display names joined after aggregation from the dimension (one
        row per key, dimension sized), so the aggregate groups by keys only
        and stays a hash aggregate.  Subtotal rows (null key) get no name."""
        for ref in rows:
            r, a = self._attr(ref)
            if not a.display or a.display == a.key:
                continue
            n = self.col_name(ref)
            names = r.dimension.table.groupBy(F.col(a.key).alias("__dk")).agg(
                F.max(a.display).alias(f"{n}_name"))
            names = broadcast_if_small(names, decision=True if r.dimension.bounded else None)
            out = out.join(names, out[n].eqNullSafe(names["__dk"]) & out[n].isNotNull(), "left").drop("__dk")
        return out

    # -- OLAP operations ----------------------------------------------------------
    def roll_up(self, role: str, hierarchy: str, to_level: str, measures: Sequence[str],
                filters: Mapping[str, object] | None = None) -> DataFrame:
        """Aggregate up to ``to_level`` of a hierarchy (OLAP-4)."""
        levels = self.hierarchy(role, hierarchy)
        upto = levels[: levels.index(f"{role}.{to_level}") + 1]
        return self.query(upto, measures, filters)

    def drill_down(self, role: str, hierarchy: str, from_level: str, measures: Sequence[str],
                   member: Mapping[str, object] | None = None, across: Sequence[str] = ()) -> DataFrame:
        """One level below ``from_level``, optionally under one member path,
        optionally crossed with other attributes (OLAP-5, RPT-4)."""
        levels = self.hierarchy(role, hierarchy)
        i = levels.index(f"{role}.{from_level}")
        rows = [*across, *levels[: i + 2]]
        return self.query(rows, measures, member)

    def slice_(self, ref: str, value, rows: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """Fix one member (OLAP-6)."""
        return self.query(rows, measures, {ref: value})

    def dice(self, members: Mapping[str, Sequence], rows: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """Constrain several dimensions at once (OLAP-7)."""
        return self.query(rows, measures, {k: list(v) for k, v in members.items()})

    def pivot(self, rows: Sequence[str], col: str, measure: str, values: Sequence | None = None,
              filters: Mapping[str, object] | None = None) -> DataFrame:
        """Rows x column members of one base measure (OLAP-8); swapping
        ``rows`` and ``col`` swaps the axes.  Without ``values`` the column
        members are those of the dimension (the fact is not scanned for them);
        an axis too long for columns is what ``query`` in long form is for."""
        f, names, _ = self._group_cols(self.frame([*rows, col], filters), [*rows, col])
        m = {x.name: x for x in self.measures}[measure]
        g = f.groupBy(*names[:-1])
        if values is None:
            values = [r[0] for r in self.members(col).orderBy(self.col_name(col)).collect()]
        return g.pivot(names[-1], list(values)).agg(m.agg())

    def summary(self, measures: Sequence[str], filters: Mapping[str, object] | None = None) -> DataFrame:
        """All headline measures in one row (OLAP-9)."""
        f = self.frame([], filters)
        aggs, post = self._measures(measures)
        out = f.agg(*aggs)
        for n, e in post:
            out = out.withColumn(n, e)
        return out

    def kpi(self, name: str, filters: Mapping[str, object] | None = None) -> DataFrame:
        """KPI per year: value, goal, status = value / goal (null when the
        goal is 0) and trend = value - value of the previous year (null
        when that year is missing) (OLAP-10, WIN-3, FN-14)."""
        k = {x.name: x for x in self.kpis}[name]
        goal_is_measure = isinstance(k.goal, str)
        by = self.query([k.year_attr], [k.value, *([k.goal] if goal_is_measure else [])], filters)
        y = self.col_name(k.year_attr)
        goal = F.col(k.goal) if goal_is_measure else F.lit(float(k.goal))
        by = by.select(y, F.col(k.value).cast("double").alias("value"), goal.cast("double").alias("goal"))
        out = parallel_period(by, y, [], "value", prior="prior_value", trend="trend")
        return out.select(y, "value", "goal",
                          F.round(F.try_divide(F.col("value"), F.col("goal")), 4).alias("status"),
                          F.round("trend", 4).alias("trend"))

    def members(self, ref: str, filters: Mapping[str, object] | None = None) -> DataFrame:
        """Members of an attribute under other filters (OLAP-13, RPT-2): from
        the dimension alone if all filters are on it, else those that have
        facts under the filters."""
        r, a = self._attr(ref)
        if any(self._attr(f)[0].dimension.name != r.dimension.name for f in filters or {}):
            f, names, _ = self._group_cols(self.frame([ref], filters), [ref])
            return f.select(names[0]).where(F.col(names[0]).isNotNull()).distinct()
        d = r.dimension.table
        for fref, v in (filters or {}).items():
            rr, fa = self._attr(fref)
            d = d.where(F.col(fa.key).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(fa.key) == v)
        return d.select(F.col(a.key).alias(self.col_name(ref))).where(F.col(a.key).isNotNull()).distinct()


def check_dimensions(fact: DataFrame, relations: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Dimension integrity at process time (OLAP-11), one row per foreign key of
    ``(fk, dimension, key)``: null keys on the fact, fact keys not found in the
    dimension, duplicated dimension keys.  The fact is scanned once: its rows
    are counted by their foreign keys first, and those counts meet the keys."""
    x = fact.groupBy(*[F.col(fk) for fk, _, _ in relations]).agg(F.count(F.lit(1)).alias("__n"))
    for i, (fk, dim, key) in enumerate(relations):
        d = dim.select(F.col(key).alias(f"__k{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
        x = x.join(d, x[fk] == d[f"__k{i}"], "left").drop(f"__k{i}")
    n = F.col("__n")
    one = x.agg(*[F.coalesce(F.sum(F.when(c, n)), F.lit(0)).cast("long").alias(f"__{name}{i}")
                  for i, (fk, _, _) in enumerate(relations)
                  for name, c in (("null", F.col(fk).isNull()), ("miss", F.col(fk).isNotNull() & F.col(f"__hit{i}").isNull()))])
    rows = []
    for i, (fk, dim, key) in enumerate(relations):
        dups = dim.groupBy(key).count().where(F.col("count") > 1).select(F.count(F.lit(1))).scalar()
        rows.append(F.struct(F.lit(fk).alias("fk"), F.col(f"__null{i}").alias("null_keys"), F.col(f"__miss{i}").alias("not_found"),
                             dups.alias("duplicate_keys")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_dimension(fact: DataFrame, fk: str, dim: DataFrame, key: str) -> DataFrame:
    """``check_dimensions`` of one foreign key; ``assert_dimension`` raises on
    any non-zero count."""
    return check_dimensions(fact, [(fk, dim, key)]).drop("fk")


def assert_dimension(fact: DataFrame, fk: str, dim: DataFrame, key: str) -> None:
    r = check_dimension(fact, fk, dim, key).first()
    if r.null_keys or r.not_found or r.duplicate_keys:
        raise AssertionError(f"dimension check failed for {fk}: {r.asDict()}")
