"""Column expressions (FN-*, PRJ-3..6, FLT-4).

Every function returns a native Spark ``Column``: no Python UDF anywhere, so
the expressions stay inside whole-stage code generation.
"""

from dwkit.functions.dates import (  # noqa: F401
    date_key, date_parts, date_names, minutes_between, hours_between, to_ts, ts_lit, add_days, add_hours,
)
from dwkit.functions.expr import (  # noqa: F401
    band, clean_code, total_of, fill_defaults, any_positive, safe_divide,
    trim_code, logical_length, typed_null, text_or_null, col_of, pearson,
    DISTANCE_BAND_EDGES, DISTANCE_BAND_LABELS,
)
