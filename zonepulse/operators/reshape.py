"""From cleaned records to typed, partition-ready fact rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse import schemas as S
from zonepulse.functions.parsing import parse_iso_text
from zonepulse.functions.timeparts import from_epoch_micros
from zonepulse.functions.validators import in_curated_period


def _as_time(df: DataFrame, name: str) -> Column:
    """A time column as zone-less timestamp: epoch microseconds, ISO text or timestamp."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return from_epoch_micros(F.col(name))
    if isinstance(kind, T.StringType):
        return parse_iso_text(F.col(name))
    return F.col(name).cast("timestamp_ntz")


def normalize_trips(cleaned: DataFrame, kind: str) -> DataFrame:
    """The common seven trip columns; for-hire trips count one passenger."""
    layout = S.TRIP_LAYOUTS[kind]
    passengers = F.col(layout.passengers) if layout.passengers else F.lit(1)
    return cleaned.select(
        _as_time(cleaned, layout.pickup).alias("pickup_ts"),
        _as_time(cleaned, layout.dropoff).alias("dropoff_ts"),
        F.col(layout.pickup_zone).alias("start_location_id"),
        F.col(layout.dropoff_zone).alias("end_location_id"),
        F.col(layout.distance).alias("trip_distance"),
        passengers.alias("passenger_count"),
        "taxi_type",
    )


def type_and_partition_trips(trips: DataFrame) -> DataFrame:
    """Typed trip columns with year and month of the pickup; rows outside the curated period drop out."""
    typed = trips.select(
        _as_time(trips, "pickup_ts").alias("pickup_ts"),
        _as_time(trips, "dropoff_ts").alias("dropoff_ts"),
        *[F.col(n).try_cast(k).alias(n) for n, k in S.TRIP_COLUMNS.items() if not n.endswith("_ts")],
    )
    # the same period as a plain time range, which typed sources can push into the scan
    first, last = min(S.CURATED_PERIOD), max(S.CURATED_PERIOD)
    begin = F.lit(f"{first}-{S.CURATED_PERIOD[first][0]:02d}-01 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{last + 1}-01-01 00:00:00").cast("timestamp_ntz")
    in_span = typed.filter((F.col("pickup_ts") >= begin) & (F.col("pickup_ts") < end))
    dated = in_span.withColumns({"year": F.year("pickup_ts"), "month": F.month("pickup_ts")})
    return dated.filter(in_curated_period(F.col("year"), F.col("month")))


def type_and_partition_events(events: DataFrame) -> DataFrame:
    """Event text columns typed, with year and month of the start."""
    typed = events.select(
        "event_id", "event_name",
        _as_time(events, "start_time").alias("start_time"), _as_time(events, "end_time").alias("end_time"),
        "event_type",
        F.col("start_location_id").try_cast("int").alias("start_location_id"),
        F.col("end_location_id").try_cast("int").alias("end_location_id"),
    )
    return typed.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})


def type_and_partition_bikes(rides: DataFrame) -> DataFrame:
    """Ride text columns typed, one passenger each, with year and month of the ride's start."""
    names = {"member_type": "member_casual"} if "member_casual" in rides.columns else {}
    made = {
        "started_at": _as_time(rides, "started_at"),
        "ended_at": _as_time(rides, "ended_at"),
        "passenger_count": F.lit(1),
    }
    typed = rides.select(*[
        made.get(n, F.col(names.get(n, n)).try_cast(k)).alias(n) for n, k in S.BIKE_FACT_COLUMNS.items()
    ])
    return typed.withColumns({"year": F.year("started_at"), "month": F.month("started_at")})


def combine_trips(*tables: DataFrame) -> DataFrame:
    """All trip tables as one, columns matched by name, duplicates kept."""
    return reduce(DataFrame.unionByName, tables)
