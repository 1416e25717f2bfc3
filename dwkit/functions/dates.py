"""Calendar expressions (FN-1..FN-5, FN-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwkit.functions.expr import col_of


def date_key(d) -> Column:
    """``yyyyMMdd`` as an int, e.g. 20240115 (FN-1)."""
    d = col_of(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_parts(d) -> dict[str, Column]:
    """Year, quarter, month, ISO week, day of month, weekday (FN-2).

    ``day_of_week`` is 1 = Sunday ... 7 = Saturday, the numbering the
    warehouse code uses (the DDL comment claiming ISO is wrong, SURVEY Q5).
    ``week_of_year`` is the ISO week, so 30 Dec 2024 is week 1 (Q20).
    """
    d = col_of(d)
    dow = F.dayofweek(d)
    return {
        "year": F.year(d).cast("short"),
        "quarter": F.quarter(d).cast("short"),
        "month": F.month(d).cast("short"),
        "week_of_year": F.weekofyear(d).cast("short"),
        "day_of_month": F.dayofmonth(d).cast("short"),
        "day_of_week": dow.cast("short"),
        "is_weekend": dow.isin(1, 7),
    }


def date_names(d) -> dict[str, Column]:
    """Month name, weekday name, ``Q<n>`` and ``Mon yyyy`` labels (FN-3)."""
    d = col_of(d)
    return {
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "month_name": F.date_format(d, "MMMM"),
        "month_year": F.concat(F.date_format(d, "MMM"), F.lit(" "), F.year(d).cast("string")),
        "day_name": F.date_format(d, "EEEE"),
    }


def to_ts(c) -> Column:
    """Date or timestamp to a zone-less timestamp."""
    return col_of(c).cast("timestamp_ntz")


# Whole minutes since this anchor floor a zone-less timestamp to its minute
# (every real date is after it, so truncation toward zero is a floor).
_MINUTE_ANCHOR = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def minute_number(c) -> Column:
    """Minutes from a fixed zone-less anchor to ``c`` (floored)."""
    return F.timestamp_diff("MINUTE", F.expr(_MINUTE_ANCHOR), to_ts(c))


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (FN-5).

    The warehouse measure counts boundaries, not elapsed minutes: 00:00:59 to
    00:01:01 is 1.  Both ends are floored to the minute on zone-less
    timestamps, so the session time zone (and daylight saving) never enters.
    """
    return minute_number(end) - minute_number(start)


def hours_between(start, end) -> Column:
    """``minutes_between / 60.0`` as a double (process-hours measure)."""
    return (minutes_between(start, end) / F.lit(60.0)).cast("double")


def ts_lit(v) -> Column:
    """A zone-less timestamp constant from a ``datetime``/``date``/text/Column.

    A Python ``datetime`` passed to ``F.lit`` becomes a zone-aware value and
    shifts when cast under a session zone other than the driver's; going
    through its text form keeps the wall-clock value whatever the zone.
    """
    import datetime as _dt
    if isinstance(v, Column):
        return v.cast("timestamp_ntz")
    if v is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(v, _dt.datetime):
        v = v.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(v, _dt.date):
        v = v.isoformat() + " 00:00:00"
    return F.lit(str(v)).cast("timestamp_ntz")


def add_days(d, n) -> Column:
    """``DATEADD(day, n, d)`` (FN-4)."""
    return F.date_add(col_of(d), n if isinstance(n, Column) else F.lit(n))


def add_hours(ts, hours) -> Column:
    """Timestamp plus ``hours`` (may be fractional) as a zone-less timestamp (FN-4)."""
    h = hours if isinstance(hours, Column) else F.lit(float(hours))
    return to_ts(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), h * F.lit(3600.0))
