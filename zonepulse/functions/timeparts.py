"""Time arithmetic on zone-less timestamps; independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def second_of_day(t: Column) -> Column:
    """Whole seconds since midnight, as bigint."""
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("bigint")


def epoch_day(t: Column) -> Column:
    """Days since 1970-01-01, as bigint."""
    return F.date_diff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")


def epoch_second(t: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of the same clock, as bigint."""
    return epoch_day(t) * DAY_SECONDS + second_of_day(t)


def epoch_micro(t: Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of the same clock, as bigint."""
    fraction = F.extract(F.lit("SECOND"), t) - F.second(t)
    return epoch_second(t) * 1_000_000 + F.round(fraction * 1_000_000).cast("bigint")


def from_epoch_micros(us: Column) -> Column:
    """Zone-less timestamp of an epoch value in microseconds; keeps the sub-second part."""
    seconds = (us.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' MINUTE")


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' HOUR")


def days(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' DAY")
