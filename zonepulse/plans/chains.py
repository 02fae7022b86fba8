"""Whole chains of steps on the given tables: raw records, cleaned, typed, written by month, read back, analysed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.operators import cleaning as C
from zonepulse.operators import profiling as P
from zonepulse.operators import reshape as X
from zonepulse.operators import temporal as T
from zonepulse.operators import volume as A
from zonepulse.plans.cleaning import CLEAN_EVENTS, TYPED_BIKES, clean_trips_sql, event_rows, typed_bikes
from zonepulse.plans.impact import IMPACT, impact_of
from zonepulse.plans.registry import query
from zonepulse.plans.traffic import profile_sql
from zonepulse.plans.views import Views
from zonepulse.sources import lookups, readers, writers
from zonepulse.sources.scratch import scratch_path

_KINDS = ("yellow", "green", "fhv")
_FULL_TIME = r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?"


def _typed_sql(kind: str) -> str:
    layout = S.TRIP_LAYOUTS[kind]
    riders = layout.passengers or "1"
    return f"""
    SELECT CASE WHEN regexp_full_match({layout.pickup}, '{_FULL_TIME}') THEN TRY_CAST({layout.pickup} AS TIMESTAMP) END AS pickup_ts, "PULocationID" AS a, "DOLocationID" AS b, {riders} AS w
    FROM ({clean_trips_sql(kind)}) c"""


_IN_PERIOD = "year(pickup_ts) = 2024 OR (year(pickup_ts) = 2025 AND month(pickup_ts) <= 9)"


@query("chain_trips_to_zone_volume", f"""
WITH trips AS (SELECT * FROM ({" UNION ALL ".join(map(_typed_sql, _KINDS))}) t WHERE {_IN_PERIOD})
SELECT zone_id, CAST(sum(w) AS BIGINT) AS taxi_passengers FROM (SELECT a AS zone_id, w FROM trips UNION ALL SELECT b, w FROM trips) m
GROUP BY 1""")
def chain_trips(v: Views) -> DataFrame:
    """Clean each kind (C1-C3), bring to common columns (X4), type (X5), combine (X8), insert (K2), zone volume (A1)."""
    cleaned = {"yellow": C.clean_yellow, "green": C.clean_green, "fhv": C.clean_fhv}
    typed = [X.type_and_partition_trips(X.normalize_trips(cleaned[k](v[f"raw_{k}"]), k)) for k in _KINDS]
    path = scratch_path(v.spark, "chain-trips")
    writers.insert_curated(X.combine_trips(*typed), path)
    return A.zone_volume(readers.read_curated(v.spark, path, "trips"), S.TAXI)


@query("chain_events_to_partition_counts", f"""
SELECT CAST(year(start_ts) AS INT) AS year, CAST(month(start_ts) AS INT) AS month, count(*) AS n
FROM ({CLEAN_EVENTS}) e GROUP BY 1, 2""")
def chain_events(v: Views) -> DataFrame:
    """Clean events with zones (C7, J2), type (X6), insert (K2), count by month (P15)."""
    return P.partition_counts(_stored_events(v))


def _stored_events(v: Views) -> DataFrame:
    clean = C.clean_events_multiformat(event_rows(v), lookups.load_zones(v["raw_zone_lookup"]))
    times = {"start_time": F.col("start_ts"), "end_time": F.col("end_ts")}
    typed = X.type_and_partition_events(clean.withColumns(times))
    path = scratch_path(v.spark, "chain-events")
    writers.insert_curated(typed, path)
    return readers.read_curated(v.spark, path, "events")


@query("chain_events_to_impact", f"""
WITH stored AS (SELECT *, start_ts AS start_time, end_ts AS end_time FROM ({CLEAN_EVENTS}) e)
{IMPACT.replace("permits", "stored")}""")
def chain_impact(v: Views) -> DataFrame:
    """Raw event lines, cleaned, typed and stored as before, read back and joined with all three modes (E8)."""
    return impact_of(v, _stored_events(v))


@query("chain_bikes_to_profile", profile_sql(f"({TYPED_BIKES})", S.CITIBIKE, "citibike", "count(*)", weeks=True))
def chain_bikes(v: Views) -> DataFrame:
    """Clean rides (C4), zones by point (J3), type (X7), write by month (K1), weekday and hour profile (A7)."""
    path = scratch_path(v.spark, "chain-bikes")
    writers.write_curated(typed_bikes(v), path)
    return T.zone_temporal_profile(readers.read_curated(v.spark, path, "bikes"), S.CITIBIKE, "citibike", T.valid_weeks(v["subway_rides"]))
