"""Profiling, rule checks and reconciliation (DQ-1..DQ-14, ERR-1).

Checks return small DataFrames (one row per check or per column) computed in
as few passes as possible: the column profile and the rule checks are each a
single aggregate over the input, unpivoted afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwkit.functions.dates import ts_lit
from dwkit.functions.expr import pearson
from dwkit.operators.aggregates import duplicate_keys
from dwkit.sources.reference import CHECK_NAMES

SAMPLES = 5


def _orderable(dtype: str) -> bool:
    return not (dtype.startswith("array") or dtype.startswith("map") or dtype.startswith("struct")
                or dtype == "binary")


def profile(df: DataFrame, exact: bool = True, samples: bool = True, digits: int = 2) -> DataFrame:
    """Column profile (DQ-1): type, rows, nulls, null %, completeness text,
    distinct values, min, max (as text) and up to five sample values.

    Two aggregates, no row expansion of the wide input:

    * one typed one-row aggregate: row count, non-null count, min and max
      per column (columns become rows with ``explode`` of an array of
      structs);
    * with ``exact``, the columns are unpivoted to narrow
      (column, value-as-text) pairs and grouped by both, so duplicates are
      removed map-side before the shuffle; a second group by column counts
      distinct values, and a row number of at most five picks the samples.  (``count(DISTINCT)`` over many
      columns would instead replicate every wide row once per column.)
      ``exact=False`` uses HyperLogLog inside the first aggregate.

    Samples are the five smallest distinct values as text (fewer only where
    there are fewer).
    """
    dtypes = dict(df.dtypes)
    cols = list(df.columns)
    orderable = {c: _orderable(dtypes[c]) for c in cols}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs.append(F.count(x).alias(f"__nn{i}"))
        if not exact:
            aggs.append(F.approx_count_distinct(x).alias(f"__nd{i}"))
        if orderable[c]:
            aggs.append(F.min(x).cast("string").alias(f"__mn{i}"))
            aggs.append(F.max(x).cast("string").alias(f"__mx{i}"))
    one = df.agg(*aggs)
    none = F.lit(None).cast("string")
    rows = [F.struct(
        F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
        F.col("__rows").alias("total_rows"),
        (F.col("__rows") - F.col(f"__nn{i}")).alias("null_count"),
        (F.lit(None).cast("long") if exact else F.col(f"__nd{i}").cast("long")).alias("unique_values"),
        (F.col(f"__mn{i}") if orderable[c] else none).alias("min"),
        (F.col(f"__mx{i}") if orderable[c] else none).alias("max"))
        for i, c in enumerate(cols)]
    out = one.select(F.explode(F.array(*rows)).alias("__p")).select("__p.*")

    if exact or samples:
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
            .alias("__kv")).select("__kv.*").where(F.col("value").isNotNull())
        distinct = pairs.distinct()
        per_col = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("__distinct"))
        if samples:
            # Row number at most 5 is cut down inside each task before the shuffle.
            first = Window.partitionBy("column").orderBy("value")
            few = (distinct.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") <= SAMPLES)
                   .groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("__few")))
            per_col = per_col.join(few, "column", "left")
        else:
            per_col = per_col.withColumn("__few", F.array().cast("array<string>"))
        per_col = per_col.select("column", "__distinct", F.concat(F.lit("["), F.array_join("__few", ", "), F.lit("]")).alias("__smp"))
        # both sides have one row per column: a small join
        out = out.join(per_col, "column", "left")
        if exact:
            out = out.withColumn("unique_values", F.coalesce(F.col("__distinct"), F.lit(0)).cast("long"))
        sample_col = F.coalesce(F.col("__smp"), F.lit("[]")) if samples else none
        out = out.withColumn("sample_values", sample_col).drop("__distinct", "__smp")
    else:
        out = out.withColumn("sample_values", none)
    pct = F.bround(F.try_divide(F.col("null_count") * 100.0, F.col("total_rows")), digits).cast("double")
    return (out.withColumn("null_pct", F.coalesce(pct, F.lit(0.0)))
            .withColumn("completeness", F.concat(F.format_number(100 - F.col("null_pct"), 2), F.lit("%")))
            .select("column", "dtype", "total_rows", "null_count", "null_pct", "completeness",
                    "unique_values", "min", "max", "sample_values"))


@dataclass(frozen=True)
class Rule:
    """A named check: an aggregate ``value`` and a severity rule.

    ``severity`` maps the value column to a label, e.g.
    ``lambda v: F.when(v > 0, "HIGH").otherwise("OK")``.
    """
    name: str
    value: Column
    severity: object  # Callable[[Column], Column] or a fixed label


def count_rule(name: str, cond: Column, bad: str = "HIGH", good: str = "OK") -> Rule:
    """Rows where ``cond`` holds; ``bad`` when any, else ``good``."""
    return Rule(name, F.count_if(cond),
                lambda v: F.when(v > 0, F.lit(bad)).otherwise(F.lit(good)))


def run_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate all rules in one aggregate; one row per rule (DQ-2):
    ``check``, ``value`` (as text, as in the report), ``severity``."""
    one = df.agg(*[r.value.alias(f"__v{i}") for i, r in enumerate(rules)])
    rows = []
    for i, r in enumerate(rules):
        v = F.col(f"__v{i}")
        sev = r.severity(v) if callable(r.severity) else F.lit(r.severity)
        rows.append(F.struct(F.lit(i).alias("check_no"), F.lit(r.name).alias("check"),
                             v.cast("string").alias("value"), sev.cast("string").alias("severity")))
    return one.select(F.explode(F.array(*rows)).alias("__r")).select("__r.*")


def flight_rules(cancelled: str = "cancelled", dep_time: str = "dep_time",
                 parts: Sequence[str] = (), a: str = "dep_delay", b: str = "arr_delay",
                 elapsed: str | None = "actual_elapsed_time", date: str = "fl_date",
                 month: str = "month", threshold: float = 0.8) -> list[Rule]:
    """The warehouse's eight source checks, parameterised by column names."""
    c1 = F.col(cancelled) == 1
    c0 = F.col(cancelled) == 0
    corr = F.round(pearson(a, b), 4)
    any_part = reduce(lambda x, y: x + y, [F.coalesce(F.col(p), F.lit(0)) for p in parts]) > 0 \
        if parts else F.lit(False)
    names = CHECK_NAMES
    day = F.col(date).cast("timestamp_ntz")
    rules = [
        count_rule(names[0], c1 & F.col(dep_time).isNotNull()),
        count_rule(names[1], c0 & F.col(dep_time).isNull(), bad="MEDIUM"),
        Rule(names[2], F.count_if(c1 & any_part), "LOW"),
        Rule(names[3], corr, lambda v: F.when(v > threshold, F.lit("OK")).otherwise(F.lit("REVIEW"))),
    ]
    if elapsed:
        rules.append(count_rule(names[4], c1 & F.col(elapsed).isNotNull()))
    return [*rules, Rule(names[5], F.min(day), "INFO"), Rule(names[6], F.max(day), "INFO"),
            Rule(names[7], F.count_distinct(month), "INFO")]


def check_references(relations: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Referential integrity report (DQ-4): per relationship the number of
    child rows whose non-null key has no parent, and PASS/FAIL.

    Relationships of the same child table are checked in **one** scan of
    it: each parent contributes its distinct keys with a hit flag through a
    left join (dimension-sized, so usually broadcast), and one aggregate
    counts the misses of every relationship.
    """
    groups: dict[int, list[tuple[int, str, DataFrame, str, DataFrame, str]]] = {}
    for i, (name, child, key, parent, pkey) in enumerate(relations):
        groups.setdefault(id(child), []).append((i, name, child, key, parent, pkey))
    parts = []
    for rels in groups.values():
        child = rels[0][2]
        x = child.select(*dict.fromkeys(r[3] for r in rels))
        for i, _, _, key, parent, pkey in rels:
            p = parent.select(F.col(pkey).alias(f"__pk{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
            x = x.join(p, x[key] == p[f"__pk{i}"], "left").drop(f"__pk{i}")
        counts = x.agg(*[F.count_if(F.col(key).isNotNull() & F.col(f"__hit{i}").isNull()).alias(f"__o{i}")
                         for i, _, _, key, _, _ in rels])
        rows = [F.struct(F.lit(i).alias("__n"), F.lit(name).alias("relationship"),
                         F.col(f"__o{i}").alias("orphans")) for i, name, *_ in rels]
        parts.append(counts.select(F.explode(F.array(*rows)).alias("__r")).select("__r.*"))
    out = reduce(DataFrame.unionByName, parts).orderBy("__n").drop("__n")
    return out.withColumn("status", F.when(F.col("orphans") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key appears twice (DQ-5).  One aggregate job."""
    dup = duplicate_keys(df, keys).limit(1).count()
    if dup:
        raise AssertionError(f"duplicate keys on {list(keys)}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table (DQ-6)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls per column in one aggregate (DQ-7, DQ-12)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def reconcile(source: DataFrame, loaded: DataFrame, rejected: DataFrame,
              flag: str = "cancelled") -> DataFrame:
    """Row accounting (DQ-8): input = loaded + rejected, and operated +
    cancelled = loaded.  One row; each side is a single aggregate."""
    # Scalar subqueries over the same input are merged by the optimizer, so
    # each table is scanned once; no join of the one-row results is needed.
    n = F.count(F.lit(1))
    one = source.agg(n.alias("source_rows")).select(
        "source_rows",
        loaded.select(n).scalar().alias("loaded_rows"),
        loaded.select(F.count_if(F.col(flag) == 0)).scalar().alias("operated_rows"),
        loaded.select(F.count_if(F.col(flag) == 1)).scalar().alias("cancelled_rows"),
        rejected.select(n).scalar().alias("rejected_rows"))
    return one.withColumns({
        "balanced": F.col("source_rows") == F.col("loaded_rows") + F.col("rejected_rows"),
        "status_balanced": F.col("loaded_rows") == F.col("operated_rows") + F.col("cancelled_rows"),
    })


def check_total(df: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """Rows whose stored total differs from the sum of its parts (DQ-9)."""
    s = reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0)) for p in parts])
    return df.where(~F.coalesce(F.col(total), F.lit(0)).eqNullSafe(s))


def check_recompute(df: DataFrame, stored: str, recomputed: Column, eps: float = 0.01) -> DataFrame:
    """Rows where a stored value and its recomputation differ by more than
    ``eps`` (DQ-10); adds ``recomputed`` and ``discrepancy``."""
    return (df.withColumn("recomputed", recomputed)
            .withColumn("discrepancy", F.abs(F.col(stored) - F.col("recomputed")))
            .where(F.col("discrepancy") > eps))


def check_timeline(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows completed at or before creation (DQ-11)."""
    return df.where(F.col(end).isNotNull() & (F.col(end) <= F.col(start)))


def check_padding(df: DataFrame, col: str) -> DataFrame:
    """Values with trailing blanks (stored length <> logical length) (DQ-13)."""
    return df.where(F.length(F.rtrim(F.col(col))) != F.length(F.col(col)))


def check_reason(fact: DataFrame, flag: str = "cancelled", reason_key: str = "cancellation_key",
                 not_applicable: int = 0) -> DataFrame:
    """Cancelled rows without a real reason key (DQ-14)."""
    return fact.where((F.col(flag) == 1) & (F.col(reason_key).isNull()
                                            | (F.col(reason_key) == not_applicable)))


def as_error_rows(df: DataFrame, source: str, code: int, text: str | Column,
                  raw_cols: Sequence[str], run_ts=None, sep: str = "|") -> DataFrame:
    """Quarantine row shape (ERR-1): source table, error code, text, the raw
    row joined by ``sep`` (nulls kept as empty fields) and the capture time."""
    ts = (F.current_timestamp() if run_ts is None else
          ts_lit(run_ts)).cast("timestamp_ntz")
    raw = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw_cols])
    return df.select(F.lit(source).alias("source_table"), F.lit(code).cast("int").alias("error_code"),
                     (text if isinstance(text, Column) else F.lit(text)).alias("error_description"),
                     raw.alias("raw_row"), ts.alias("captured_at"))
