"""Parsers from raw text, without padding or quotes, to zone-less timestamps. Impossible dates give null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.plan import evaluate_once

_STRICT_EVENT_TIME = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AaPp][Mm]$"


def number_parts(c: Column) -> Column:
    """The runs of digits in a text, as an array of strings."""
    return F.split(F.btrim(F.regexp_replace(c, r"[^0-9]+", " ")), " ")


def half_day_mark(c: Column) -> Column:
    """``a`` or ``p`` when the text ends in AM or PM, otherwise empty."""
    return F.lower(F.regexp_extract(c, r"([AaPp])[Mm]\s*$", 1))


def _part(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def _clock_hour(text: Column, mark: Column) -> Column:
    """Hour text on the 24-hour clock; an AM/PM mark only applies to 1..12."""
    hour = text.try_cast("int")
    shifted = (hour % 12 + F.when(mark == "p", 12).otherwise(0)).cast("string")
    return F.when((mark != "") & hour.between(1, 12), shifted).otherwise(text)


def _date(year: Column, month: Column, day: Column) -> Column:
    """Date text, null when a part is missing."""
    return F.concat(year, F.lit("-"), month, F.lit("-"), day)


def _timestamp(date: Column, clock: Column) -> Column:
    """Zone-less timestamp from date and clock text, null for impossible parts.

    Casting text reports bad parts as null; building from numbers would throw and catch an exception
    for each bad row.
    """
    return F.concat(date, F.lit(" "), clock).try_cast("timestamp_ntz")


def multi_ts(parts: Column, mark: Column) -> Column:
    """Timestamp from number parts and AM/PM mark.

    A four-digit first number means year-month-day, anything else month-day-year (a two-digit year is
    20xx). Six numbers give a full time, five give hour and minute, with or without an AM/PM mark, fewer
    give midnight.
    """
    first, second, third = (_part(parts, i) for i in range(3))
    year_first = F.length(first) == 4
    digits = F.length(third)
    year = F.when(digits <= 2, F.concat(F.lit("20"), F.lpad(third, 2, "0"))).when(digits <= 4, third)
    has_seconds = F.size(parts) >= 6
    has_clock = F.size(parts) >= 5
    second_text = F.when(has_seconds, _part(parts, 5)).otherwise("0")
    clock = F.when(
        has_clock, F.concat_ws(":", _clock_hour(_part(parts, 3), mark), _part(parts, 4), second_text)
    ).otherwise("0:0:0")
    return _timestamp(F.when(year_first, _date(first, second, third)).otherwise(_date(year, first, second)), clock)


def strict_event_ts(parts: Column, mark: Column, text: Column) -> Column:
    """``MM/dd/yyyy hh:mm:ss a`` only; one-digit parts are accepted, out-of-range parts are not."""
    month, day, year, hour, minute, second = (_part(parts, i) for i in range(6))
    clock = F.concat_ws(":", _clock_hour(hour, mark), minute, second)
    fits = text.rlike(_STRICT_EVENT_TIME) & hour.try_cast("int").between(1, 12)
    return F.when(fits, _timestamp(_date(year, month, day), clock))


def parse_multi_ts(c: Column) -> Column:
    """Date-time text in any of the known layouts (see ``multi_ts``)."""
    return multi_ts(number_parts(c), half_day_mark(c))


def parse_event_ts(c: Column) -> Column:
    """Date-time text in the one strict layout (see ``strict_event_ts``)."""
    return strict_event_ts(number_parts(c), half_day_mark(c), c)


def with_timestamps(df: DataFrame, columns: dict[str, str], strict: bool) -> DataFrame:
    """``df`` with the text columns (values) parsed into new columns (keys).

    The number parts become columns of a projection of their own, so each text is cut up once; inside
    one expression Spark would repeat the cut for every use under a condition. One column is done at a
    time, which keeps the generated methods short enough for the JVM to compile.
    """
    for out, text in columns.items():
        cut = df.select(
            "*", number_parts(F.col(text)).alias(f"{out}:parts"), half_day_mark(F.col(text)).alias(f"{out}:mark"))
        parts, mark = F.col(f"`{out}:parts`"), F.col(f"`{out}:mark`")
        made = strict_event_ts(parts, mark, F.col(text)) if strict else multi_ts(parts, mark)
        df = evaluate_once(cut.select(*df.columns, made.alias(out)))
    return df


def parse_iso_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with or without a fraction; also accepts ``T`` between date and time."""
    full = c.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$")
    return F.when(full, c.try_cast("timestamp_ntz"))
