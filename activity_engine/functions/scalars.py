"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
# Fixed value: end of validity of a current version.
OPEN_END = "9999-12-31"

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over the dash-joined text of the columns.

    Text of a timestamp differs between engines, so pass it through `timestamp_text` first.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def timestamp_text(ts: ColumnOrName) -> Column:
    """Warehouse text form of an instant: seconds, 3 or 6 fraction digits if any, `+00`."""
    c = _c(ts)
    micros = F.unix_micros(c.cast("timestamp")) % 1_000_000
    fraction = (
        F.when(micros == 0, F.lit(""))
        .when(micros % 1000 == 0, F.date_format(c, ".SSS"))
        .otherwise(F.date_format(c, ".SSSSSS"))
    )
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), fraction, F.lit("+00"))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole minutes, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole hours, truncated toward zero: 48 h 59 m is 48."""
    return F.timestamp_diff("HOUR", _c(start), _c(end))


def plus_seconds(ts: ColumnOrName, seconds: ColumnOrName) -> Column:
    """`ts` plus a possibly fractional number of seconds, to the microsecond."""
    micros = F.round(_c(seconds).cast("double") * 1_000_000).cast("bigint")
    return F.timestamp_micros(F.unix_micros(_c(ts)) + micros)


def week_of_year_sunday(day: ColumnOrName) -> Column:
    """Week 0-53, weeks start on Sunday, days before the first Sunday are week 0."""
    d = _c(day)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("bigint")


def ratio_change(current: Column, previous: Column) -> Column:
    """(current - previous) / previous; NULL where previous is NULL or zero."""
    return F.try_divide(current - previous, F.nullif(previous, F.lit(0)))


def or_zero(col: ColumnOrName) -> Column:
    return F.coalesce(_c(col), F.lit(0))
