"""Row predicates. Each returns a boolean column that is never null.

Text is expected without padding (the readers' column functions strip it). Each predicate evaluates its
argument as few times as it can, since the argument is often a parsed expression.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse import schemas as S
from zonepulse.functions.text import strip_padding

_ISO_DATE_TIME = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)(Z|[+-]\d{2}:\d{2}(:\d{2})?(\[[^\]]+\])?)?$"
_STATION_ID = r"^\d+(\.\d+)?$"


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_null_text(c: Column) -> Column:
    """Null, empty, or the text ``null``."""
    return c.isNull() | c.cast("string").isin("", "null")


def local_iso(c: Column) -> Column:
    """Local date-time of an ISO text with ``T``; the offset is read over. Null when it does not parse."""
    return F.regexp_extract(c.cast("string"), _ISO_DATE_TIME, 1).try_cast("timestamp_ntz")


def valid_datetime(c: Column) -> Column:
    """ISO date-time text whose year is accepted."""
    first, last = S.VALID_YEARS
    return _sure(F.year(local_iso(c)).isin(*range(first, last + 1)))


def valid_number(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Parses as a number (not NaN) inside the inclusive bounds that are given."""
    value = c.cast("string").try_cast("double")
    # NaN is greater than every number, so an upper bound rejects it
    bounds = [value >= low] if low is not None else []
    bounds.append(value <= high if high is not None else ~F.isnan(value) & value.isNotNull())
    return _sure(reduce(and_, bounds))


def valid_whole_number(c: Column, low: float, high: float) -> Column:
    """A number in bounds without a fractional part, so ``2.0`` counts and ``1.5`` does not."""
    value = c.cast("string").try_cast("double")
    return _sure(valid_number(c, low, high) & (value == F.floor(value)))


def valid_location_id(c: Column) -> Column:
    """Integer text inside the zone id range."""
    text = c.cast("string")
    return _sure(text.rlike(r"^[+-]?\d+$") & text.try_cast("int").between(S.ZONE_ID_MIN, S.ZONE_ID_MAX))


def number_ok(df: DataFrame, name: str, low: float, high: float) -> Column:
    """``valid_number`` for a column of any type; stored numbers are compared as numbers."""
    c = F.col(name)
    return valid_number(c, low, high) if _is_text(df, name) else c.between(low, high)


def whole_ok(df: DataFrame, name: str, low: float, high: float) -> Column:
    """``valid_whole_number`` for a column of any type."""
    c = F.col(name)
    if _is_text(df, name):
        return valid_whole_number(c, low, high)
    bounds = c.between(int(low), int(high))
    return bounds & (c == F.floor(c)) if isinstance(df.schema[name].dataType, T.FractionalType) else bounds


def zone_ok(df: DataFrame, name: str) -> Column:
    """``valid_location_id`` for a column of any type."""
    if _is_text(df, name):
        return valid_location_id(F.col(name))
    return whole_ok(df, name, S.ZONE_ID_MIN, S.ZONE_ID_MAX)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def dropoff_after_pickup(pickup: Column, dropoff: Column) -> Column:
    """Strictly later; false when either side is missing or did not parse."""
    return _sure(dropoff > pickup)


def full_time_text(c: Column) -> Column:
    """Time text brought to 23 characters; null for any other length."""
    return F.when(F.length(c) == 19, F.concat(c, F.lit(".000"))).when(F.length(c) == 23, c)


def valid_time_text(c: Column) -> Column:
    """Time text of an accepted length inside the accepted period, compared as text."""
    return _sure(full_time_text(c).between(S.BIKE_TIME_MIN, S.BIKE_TIME_MAX))


def finite_number(c: Column) -> Column:
    """The text as a finite double, otherwise null."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def valid_lat(c: Column) -> Column:
    return _sure(c.try_cast("double").between(*S.LAT_RANGE))


def valid_lng(c: Column) -> Column:
    return _sure(c.try_cast("double").between(*S.LNG_RANGE))


def valid_station_id(c: Column) -> Column:
    return _sure(c.rlike(_STATION_ID))


def is_missing(c: Column) -> Column:
    """Null, blank, or one of the missing-value markers in any case."""
    text = strip_padding(c)
    return F.coalesce((text == "") | F.upper(text).isin(*S.MISSING_MARKERS), F.lit(True))


def in_curated_period(year: Column, month: Column) -> Column:
    """Year and month belong to the curated period."""
    spans = [(year == y) & month.between(lo, hi) for y, (lo, hi) in S.CURATED_PERIOD.items()]
    return _sure(reduce(or_, spans))
