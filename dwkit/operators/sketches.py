"""Column profiles that merge over loads (DQ-1).

The profile of a load is kept as state, one row per column: rows, non-null values, least
and greatest value, and three sketches: HyperLogLog for the number of distinct values, KLL for
quantiles of numbers, and the most frequent values with their counts.  State is made by
one aggregate over the load's rows (no value is shuffled, a task sends its sketches);
state of several loads merges without reading any load again.

Bounds, as documented for the sketches: with ``2 ** lg_k`` registers the distinct count is
within ``distinct_bound(lg_k)`` of the exact one (three standard deviations of 1.04 / sqrt(registers));
a quantile's rank is within ``QUANTILE_BOUND`` (1.33 % with the default 200 items, doubled here
for merging and for ranks inside a run of equal values); a frequent value's count is within
``rows / tracked`` and no value of more rows than that is missing.

Least and greatest values are exact: whole numbers as such, fractional ones as doubles, all
others by their text (dates and timestamps sort as text).  Nulls count only as nulls.  A column
without a value has 0 distinct values and no least, greatest or frequent ones.  Columns of arrays, maps or
structs are profiled by their JSON text, binary ones by their hexadecimal text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K, TRACKED = 14, 10_000
QUANTILE_BOUND = 2 * 0.0133
_MERGED = ["rows", "values", "low_whole", "high_whole", "low_double", "high_double", "low_text", "high_text", "distinct", "quantiles", "frequent"]


def distinct_bound(lg_k: int = LG_K) -> float:
    return 3 * 1.04 / 2 ** (lg_k / 2)


def frequent_bound(rows: Column, tracked: int = TRACKED) -> Column:
    return F.ceil(rows / tracked)


def _text(c: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(F.col(c).alias("v")))
    return F.hex(c) if isinstance(kind, T.BinaryType) else F.col(c).cast("string")


def _column_state(c: str, kind: T.DataType, lg_k: int, tracked: int) -> list[Column]:
    whole, number = isinstance(kind, T.IntegralType), isinstance(kind, T.NumericType)
    text, some = _text(c, kind), F.col(c).isNotNull()
    as_whole = F.col(c).cast("long") if whole else F.lit(None).cast("long")
    as_double = F.col(c).cast("double") if number and not whole else F.lit(None).cast("double")
    as_text = F.lit(None).cast("string") if number else text
    # A frequent-value state per column, of values as text; nulls are no value.
    top = F.call_function("approx_top_k_accumulate", F.when(some, text), F.lit(tracked))
    return [F.count(F.lit(1)).alias("rows"), F.count(c).alias("values"), F.min(as_whole).alias("low_whole"), F.max(as_whole).alias("high_whole"),
            F.min(as_double).alias("low_double"), F.max(as_double).alias("high_double"), F.min(as_text).alias("low_text"), F.max(as_text).alias("high_text"),
            F.hll_sketch_agg(as_whole if whole else F.when(some, text), F.lit(lg_k)).alias("distinct"),
            F.kll_sketch_agg_double(F.col(c).cast("double") if number else F.lit(None).cast("double")).alias("quantiles"), top.alias("frequent")]


def sketch(df: DataFrame, columns: Sequence[str] | None = None, lg_k: int = LG_K, tracked: int = TRACKED) -> DataFrame:
    """State of the rows of ``df``: ``(column, dtype, position, ...)``, a row per column, in one aggregate."""
    fields = [df.schema[c] for c in columns or df.columns]
    one = df.agg(*[c.alias(f"s{i}_{name}") for i, f in enumerate(fields)
                   for name, c in zip(_MERGED, _column_state(f.name, f.dataType, lg_k, tracked), strict=True)])
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.lit(i).alias("position"),
                     *[F.col(f"s{i}_{name}").alias(name) for name in _MERGED]) for i, f in enumerate(fields)]
    return one.select(F.inline(F.array(*rows)))


def merge(states: DataFrame | Sequence[DataFrame], tracked: int = TRACKED) -> DataFrame:
    """State of all loads together; columns of the same name and type are one column."""
    every = states if isinstance(states, DataFrame) else reduce(DataFrame.unionByName, states)
    least, most = ("low_whole", "low_double", "low_text"), ("high_whole", "high_double", "high_text")
    return every.groupBy("column", "dtype").agg(
        F.min("position").alias("position"), F.sum("rows").alias("rows"), F.sum("values").alias("values"),
        *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in most],
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"),
    ).select("column", "dtype", "position", *_MERGED)


def report(state: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75), top: int = 5) -> DataFrame:
    """The profile that a state stands for: ``unique_values``, ``quantiles`` (at ``ranks``) and ``frequent``
    (value, count; most frequent first) are estimates, everything else is exact."""
    def end(which: str) -> Column:
        return F.coalesce(F.col(f"{which}_whole").cast("string"), F.col(f"{which}_double").cast("string"), F.col(f"{which}_text"))
    counted = F.kll_sketch_get_n_double("quantiles") > 0
    found = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top + 1))      # nulls may be one of them
    values = F.slice(F.filter(F.transform(found, lambda x: F.struct(x["item"].alias("value"), x["count"].alias("count"))),
                              lambda x: x["value"].isNotNull()), 1, top)
    pct = F.bround(F.try_divide((F.col("rows") - F.col("values")) * 100.0, F.col("rows")), 2).cast("double")
    return state.select("column", "dtype", "position", F.col("rows").alias("total_rows"), (F.col("rows") - F.col("values")).alias("null_count"),
                        F.coalesce(pct, F.lit(0.0)).alias("null_pct"), F.hll_sketch_estimate("distinct").alias("unique_values"),
                        end("low").alias("min"), end("high").alias("max"),
                        F.when(counted, F.kll_sketch_get_quantile_double("quantiles", F.array(*map(F.lit, ranks)))).alias("quantiles"),
                        values.alias("frequent"))
