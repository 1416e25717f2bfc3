"""Row expressions: bands, code cleaning, null handling, safe division."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must match the warehouse: route distance bands.
# Short < 500, Medium 500..1500, Long > 1500 (miles).
DISTANCE_BAND_EDGES = (500, 1500)
DISTANCE_BAND_LABELS = ("Short", "Medium", "Long")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(c, edges: Sequence[float] = DISTANCE_BAND_EDGES,
         labels: Sequence[str] = DISTANCE_BAND_LABELS,
         null_label: str | None = None) -> Column:
    """Label a number by ascending ``edges`` (PRJ-3).

    The first band is ``x < edges[0]``; each later band includes its upper
    edge, so with the defaults 500 and 1500 are Medium and 1501 is Long.  A
    null input gets ``null_label`` instead of falling into the last band.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    x = col_of(c)
    expr = F.when(x.isNull(), F.lit(null_label)).when(x < edges[0], F.lit(labels[0]))
    for e, lab in zip(edges[1:], labels[1:-1]):
        expr = expr.when(x <= e, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def trim_code(c) -> Column:
    """Both-side trim; codes stored padded (CHAR(n)) never match otherwise (Q9)."""
    return F.trim(col_of(c))


def logical_length(c) -> Column:
    """Length ignoring trailing blanks, as T-SQL ``LEN`` does (FN-6)."""
    return F.length(F.rtrim(col_of(c)))


def clean_code(cancelled, code, not_cancelled: str = "N/A",
               missing: str = "A") -> Column:
    """Cancellation code cleaning (PRJ-4).

    Not cancelled -> ``not_cancelled``; else the first character of the
    trimmed code; a null or blank code on a cancelled row -> ``missing`` (Q10).
    """
    first = F.substring(trim_code(code), 1, 1)
    return (F.when(col_of(cancelled) == 0, F.lit(not_cancelled))
            .otherwise(F.coalesce(F.nullif(first, F.lit("")), F.lit(missing))))


def total_of(*cols) -> Column:
    """Sum of null-as-zero parts (PRJ-5)."""
    parts = [F.coalesce(col_of(c), F.lit(0)) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def any_positive(*cols) -> Column:
    """True when any null-as-zero part is > 0 (FLT-4)."""
    return F.greatest(*[F.coalesce(col_of(c), F.lit(0)) for c in cols], F.lit(0)) > 0 \
        if len(cols) else F.lit(False)


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Null-to-default per column (PRJ-6), types preserved."""
    types = dict(df.dtypes)
    return df.withColumns({
        k: F.coalesce(F.col(k), F.lit(v).cast(types[k])) for k, v in defaults.items()
    })


def safe_divide(a, b, alternate=None) -> Column:
    """``DIVIDE(a, b, alternate)``: a zero or null denominator gives ``alternate``
    (FN-14).  ANSI mode is on, so plain ``/`` would raise on zero."""
    q = F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))
    return q if alternate is None else F.coalesce(q, F.lit(alternate).cast("double"))


def typed_null(dtype: str) -> Column:
    """Typed NULL column (FN-15)."""
    return F.lit(None).cast(dtype)


def text_or_null(c, null_texts: Sequence[str] = ("nan", "NaN", "None", "<NA>", "")) -> Column:
    """Text cast where the placeholder strings of a dataframe export become null (FN-11)."""
    s = col_of(c).cast("string")
    return F.when(s.isin(*null_texts), F.lit(None).cast("string")).otherwise(s)


def pearson(a, b) -> Column:
    """Pearson correlation aggregate that is null (not an error) when either
    side has zero variance.  Under ANSI mode the built-in ``corr`` raises a
    division by zero there; covariance over the product of the standard
    deviations (same streaming co-moment algorithm) with ``try_divide`` does
    not."""
    x, y = col_of(a).cast("double"), col_of(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))
