"""Schemas, column layouts and fixed domain values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the domain: id range, accepted years, limits and periods.
ZONE_ID_MIN, ZONE_ID_MAX = 1, 263
VALID_YEARS = (2024, 2025)
PASSENGERS = (1.0, 6.0)
TRIP_MILES = (0.0, 100.0)
BIKE_TIME_MIN, BIKE_TIME_MAX = "2024-01-01 00:00:00.000", "2025-11-01 00:00:00.000"
LAT_RANGE = (40.49, 40.92)
LNG_RANGE = (-74.26, -73.68)
CURATED_PERIOD = {2024: (1, 12), 2025: (1, 9)}
MISSING_MARKERS = ("N/A", "NULL", "NA")

BIKE_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at",
    "start_station_name", "start_station_id", "end_station_name", "end_station_id",
    "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
]

# Field positions in the raw subway origin-destination file (16 fields or more).
SUBWAY_FIELD_COUNT = 16
SUBWAY_FIELDS = {
    "timestamp": 4,
    "origin_station_complex_name": 6,
    "origin_latitude": 7,
    "origin_longitude": 8,
    "destination_station_complex_name": 10,
    "destination_latitude": 11,
    "destination_longitude": 12,
    "estimated_average_ridership": 13,
}

# Field positions in the raw permitted-event file (12 fields).
EVENT_FIELD_COUNT = 12
EVENT_FIELDS = {
    "event_id": 0,
    "event_name": 1,
    "start_time": 2,
    "end_time": 3,
    "event_type": 5,
    "event_location": 7,
}


@dataclass(frozen=True)
class TripLayout:
    """Raw column names of one taxi kind; ``passengers`` is None when the source has none."""

    pickup: str
    dropoff: str
    distance: str
    label: str
    passengers: str | None = "passenger_count"
    pickup_zone: str = "PULocationID"
    dropoff_zone: str = "DOLocationID"

    @property
    def columns(self) -> list[str]:
        names = [self.pickup, self.dropoff, self.passengers, self.distance, self.pickup_zone, self.dropoff_zone]
        return [n for n in names if n]


TRIP_LAYOUTS = {
    "yellow": TripLayout("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "yellow"),
    "green": TripLayout("lpep_pickup_datetime", "lpep_dropoff_datetime", "trip_distance", "green"),
    "fhv": TripLayout("pickup_datetime", "dropoff_datetime", "trip_miles", "fhv", passengers=None),
}


@dataclass(frozen=True)
class Mode:
    """Where one transport mode keeps its times, zones and passenger weight."""

    name: str
    start_time: str
    end_time: str
    start_zone: str
    end_zone: str
    weight: str
    weight_type: str
    # The time whose date counts as a service day and places the row in a year/month partition.
    day_time: str = ""
    # The time that must lie in the analysed year in the sampled event analysis.
    period_time: str = ""


TAXI = Mode("taxi", "pickup_ts", "dropoff_ts", "start_location_id", "end_location_id",
            "passenger_count", "bigint", day_time="pickup_ts", period_time="dropoff_ts")
SUBWAY = Mode("subway", "transit_timestamp", "transit_timestamp", "origin_location_id",
              "destination_location_id", "estimated_average_ridership", "double",
              day_time="transit_timestamp", period_time="transit_timestamp")
CITIBIKE = Mode("citibike", "started_at", "ended_at", "start_location_id", "end_location_id",
                "passenger_count", "bigint", day_time="started_at", period_time="started_at")
MODES = {m.name: m for m in (TAXI, SUBWAY, CITIBIKE)}


def struct_of(columns: dict[str, str]) -> T.StructType:
    """``{"a": "int"}`` as a nullable StructType."""
    return T._parse_datatype_string(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))


TRIP_COLUMNS = {
    "pickup_ts": "timestamp_ntz", "dropoff_ts": "timestamp_ntz",
    "start_location_id": "int", "end_location_id": "int",
    "trip_distance": "double", "passenger_count": "int", "taxi_type": "string",
}
BIKE_FACT_COLUMNS = {
    "ride_id": "string", "rideable_type": "string",
    "started_at": "timestamp_ntz", "ended_at": "timestamp_ntz",
    "start_station_name": "string", "start_station_id": "string",
    "end_station_name": "string", "end_station_id": "string",
    "start_lat": "double", "start_lng": "double", "end_lat": "double", "end_lng": "double",
    "member_type": "string", "passenger_count": "int",
    "start_location_id": "int", "end_location_id": "int",
}
EVENT_FACT_COLUMNS = {
    "event_id": "string", "event_name": "string",
    "start_time": "timestamp_ntz", "end_time": "timestamp_ntz",
    "event_type": "string", "start_location_id": "int", "end_location_id": "int",
}
SUBWAY_FACT_COLUMNS = {
    "transit_timestamp": "timestamp_ntz",
    "origin_station_complex_name": "string", "origin_latitude": "double", "origin_longitude": "double",
    "destination_station_complex_name": "string", "destination_latitude": "double",
    "destination_longitude": "double", "estimated_average_ridership": "double",
    "origin_location_id": "int", "destination_location_id": "int",
}
CURATED = {
    "trips": TRIP_COLUMNS, "bikes": BIKE_FACT_COLUMNS,
    "events": EVENT_FACT_COLUMNS, "subway": SUBWAY_FACT_COLUMNS,
}
