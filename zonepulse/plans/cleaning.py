"""Validators, cleaning jobs, parsing, reshaping and enrichment on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.functions import parsing as P
from zonepulse.functions import text as TX
from zonepulse.functions import validators as V
from zonepulse.operators import cleaning as C
from zonepulse.operators import enrich as J
from zonepulse.operators import reshape as X
from zonepulse.plans.ingest import CLEAN_SUBWAY, LOADED_ZONES, STANDARD_NAME, TYPED_TRIPS, parsed_subway
from zonepulse.plans.registry import query
from zonepulse.plans.views import Views
from zonepulse.sources import lookups, readers

# -- validators

SQL_DATETIME = r"""(coalesce(regexp_full_match({0}, '\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\dZ?')
  AND year(try_cast(replace(replace({0}, 'Z', ''), 'T', ' ') AS TIMESTAMP)) BETWEEN 2024 AND 2025, false))"""
SQL_NUMBER = "(coalesce(try_cast({0} AS DOUBLE) BETWEEN {1} AND {2}, false))"
SQL_WHOLE = "(coalesce(try_cast({0} AS DOUBLE) BETWEEN {1} AND {2} AND try_cast({0} AS DOUBLE) % 1 = 0, false))"
SQL_ZONE = r"(coalesce(regexp_full_match({0}, '[+-]?\d+') AND try_cast({0} AS INT) BETWEEN 1 AND 263, false))"
SQL_TIME_TEXT = """(CASE length({0}) WHEN 19 THEN {0} || '.000' WHEN 23 THEN {0} ELSE '' END
  BETWEEN '2024-01-01 00:00:00.000' AND '2025-11-01 00:00:00.000')"""
SQL_LAT = "(coalesce(try_cast({0} AS DOUBLE) BETWEEN 40.49 AND 40.92, false))"
SQL_LNG = "(coalesce(try_cast({0} AS DOUBLE) BETWEEN -74.26 AND -73.68, false))"
SQL_STATION = r"(coalesce(regexp_full_match({0}, '\d+(\.\d+)?'), false))"


@query("v01_valid_datetime", f"""
SELECT tpep_pickup_datetime, {SQL_DATETIME.format('tpep_pickup_datetime')} AS valid FROM raw_yellow""")
def v01(v: Views) -> DataFrame:
    c = F.col("tpep_pickup_datetime")
    return v["raw_yellow"].select(c, V.valid_datetime(c).alias("valid"))


@query("v02_valid_number", f"""
SELECT trip_distance, {SQL_NUMBER.format('trip_distance', 0, 100)} AS in_bounds,
       coalesce(try_cast(trip_distance AS DOUBLE) >= 0 AND NOT isnan(try_cast(trip_distance AS DOUBLE)), false)
         AS at_least_zero
FROM raw_yellow""")
def v02(v: Views) -> DataFrame:
    c = F.col("trip_distance")
    return v["raw_yellow"].select(
        c, V.valid_number(c, 0.0, 100.0).alias("in_bounds"), V.valid_number(c, low=0.0).alias("at_least_zero"))


@query("v03_valid_location_id", f"""
SELECT "PULocationID" AS location_id, {SQL_ZONE.format('"PULocationID"')} AS valid FROM raw_yellow""")
def v03(v: Views) -> DataFrame:
    c = F.col("PULocationID")
    return v["raw_yellow"].select(c.alias("location_id"), V.valid_location_id(c).alias("valid"))


@query("v04_dropoff_after_pickup", """
SELECT o_orderkey, l_linenumber, coalesce(dropoff_ts > pickup_ts, false) AS valid FROM trips_all""")
def v04(v: Views) -> DataFrame:
    ok = V.dropoff_after_pickup(F.col("pickup_ts"), F.col("dropoff_ts"))
    return v["trips_all"].select("o_orderkey", "l_linenumber", ok.alias("valid"))


@query("v05_valid_time_text", f"""
SELECT event_id, {SQL_TIME_TEXT.format('started_at')} AS start_ok, {SQL_TIME_TEXT.format('ended_at')} AS end_ok
FROM raw_bikes""")
def v05(v: Views) -> DataFrame:
    return v["raw_bikes"].select(
        "event_id", V.valid_time_text(F.col("started_at")).alias("start_ok"),
        V.valid_time_text(F.col("ended_at")).alias("end_ok"))


@query("v06_valid_coordinates", f"""
SELECT event_id, {SQL_LAT.format('start_lat')} AS lat_ok, {SQL_LNG.format('end_lng')} AS lng_ok FROM raw_bikes""")
def v06(v: Views) -> DataFrame:
    return v["raw_bikes"].select(
        "event_id", V.valid_lat(F.col("start_lat")).alias("lat_ok"), V.valid_lng(F.col("end_lng")).alias("lng_ok"))


@query("v07_valid_station_id", f"""
SELECT event_id, {SQL_STATION.format('start_station_id')} AS start_ok,
       {SQL_STATION.format('end_station_id')} AS end_ok FROM raw_bikes""")
def v07(v: Views) -> DataFrame:
    return v["raw_bikes"].select(
        "event_id", V.valid_station_id(F.col("start_station_id")).alias("start_ok"),
        V.valid_station_id(F.col("end_station_id")).alias("end_ok"))


@query("v08_is_missing", """
SELECT event_id, trim(origin_text) IN ('', 'n/a', 'N/A', 'NA', 'NULL') AS origin_missing,
       trim(lat_text) IN ('', 'n/a', 'N/A', 'NA', 'NULL') AS lat_missing,
       trim(dest_text) IN ('', 'n/a', 'N/A', 'NA', 'NULL') AS dest_missing
FROM raw_subway""")
def v08(v: Views) -> DataFrame:
    return v["raw_subway"].select("event_id", *[
        V.is_missing(F.col(f"{n}_text")).alias(f"{n}_missing") for n in ("origin", "lat", "dest")])


@query("v09_period_filter", """
SELECT substr(pickup_ts, 1, 7) AS month_text, count(*) AS trips FROM text_trips
WHERE substr(pickup_ts, 1, 7) BETWEEN '2024-01' AND '2025-09' GROUP BY 1""")
def v09(v: Views) -> DataFrame:
    dated = v["text_trips"].withColumn("t", P.parse_iso_text(F.col("pickup_ts")))
    kept = dated.filter(V.in_curated_period(F.year("t"), F.month("t")))
    return kept.groupBy(F.substring("pickup_ts", 1, 7).alias("month_text")).agg(F.count(F.lit(1)).alias("trips"))


# -- cleaning


def clean_trips_sql(kind: str) -> str:
    layout = S.TRIP_LAYOUTS[kind]
    count = "CAST(CAST(passenger_count AS DOUBLE) AS INT) AS passenger_count," if layout.passengers else ""
    count_ok = SQL_WHOLE.format("passenger_count", 1, 6) + " AND" if layout.passengers else ""
    return f"""
SELECT {layout.pickup}, {layout.dropoff}, {count} CAST({layout.distance} AS DOUBLE) AS {layout.distance},
       CAST("PULocationID" AS INT) AS "PULocationID", CAST("DOLocationID" AS INT) AS "DOLocationID",
       '{layout.label}' AS taxi_type
FROM raw_{kind}
WHERE {count_ok} {SQL_NUMBER.format(layout.distance, 0, 100)}
  AND {SQL_ZONE.format('"PULocationID"')} AND {SQL_ZONE.format('"DOLocationID"')}"""


query("c01_clean_yellow", clean_trips_sql("yellow"))(lambda v: C.clean_yellow(v["raw_yellow"]))
query("c02_clean_green", clean_trips_sql("green"))(lambda v: C.clean_green(v["raw_green"]))
query("c03_clean_fhv", clean_trips_sql("fhv"))(lambda v: C.clean_fhv(v["raw_fhv"]))


def bike_pieces(v: Views) -> DataFrame:
    return v["bike_lines"].select(
        F.col("value").alias("line"), readers.split_line(F.col("value")).alias("fields"))


def event_pieces(v: Views) -> DataFrame:
    return v["event_lines"].select(
        F.col("value").alias("line"), readers.split_line(F.col("value"), keep_trailing=False).alias("fields"))


def event_rows(v: Views) -> DataFrame:
    return readers.parse_quoted(v["event_lines"], C.EVENT_RAW_COLUMNS)


# Bike lines cut at commas and trimmed, for the checking SQL.
BIKE_FIELDS = "SELECT value AS line, len(string_split(value, ',')) AS n_fields, " + ", ".join(
    f"trim(string_split(value, ',')[{i + 1}]) AS {n}" for i, n in enumerate(S.BIKE_COLUMNS)
) + " FROM bike_lines"

BIKE_OK = f"""ride_id <> '' AND rideable_type <> '' AND member_casual <> ''
  AND {SQL_TIME_TEXT.format('started_at')} AND {SQL_TIME_TEXT.format('ended_at')} AND ended_at > started_at
  AND {SQL_LAT.format('start_lat')} AND {SQL_LAT.format('end_lat')}
  AND {SQL_LNG.format('start_lng')} AND {SQL_LNG.format('end_lng')}
  AND start_station_name <> '' AND end_station_name <> ''
  AND {SQL_STATION.format('start_station_id')} AND {SQL_STATION.format('end_station_id')}"""


@query("c04_clean_bikes", f"SELECT line FROM ({BIKE_FIELDS}) b WHERE n_fields >= 13 AND {BIKE_OK}")
def c04(v: Views) -> DataFrame:
    return C.clean_bikes(bike_pieces(v)).select("line")


@query("c05_clean_subway", CLEAN_SUBWAY)
def c05(v: Views) -> DataFrame:
    return C.clean_subway(parsed_subway(v))


# a year of two digits is not in the strict layout
SQL_STRICT_TIME = "CASE WHEN split_part({0}, ' ', 1) LIKE '%/____' THEN try_strptime({0}, '%m/%d/%Y %I:%M:%S %p') END"
SQL_MULTI_TIME = """try_strptime({0}, ['%m/%d/%y %I:%M:%S %p', '%m/%d/%Y %I:%M:%S %p', '%m/%d/%Y %H:%M:%S', '%Y-%m-%d %H:%M:%S',
  '%Y/%m/%d %H:%M:%S', '%m-%d-%Y %I:%M:%S %p', '%m/%d/%Y %I:%M %p', '%m/%d/%Y %H:%M',
  '%Y-%m-%d %H:%M', '%m-%d-%Y %H:%M:%S', '%Y-%m-%d', '%m/%d/%Y'])"""
SQL_SQUEEZE = r"regexp_replace(trim({0}), '\s+', ' ', 'g')"

LOADED_LOCATIONS = """
SELECT raw_location, lat, lon, location_id FROM (
  SELECT replace(raw_location, '"', '') AS raw_location, lat, lon, location_id,
         row_number() OVER (PARTITION BY raw_location ORDER BY line_no DESC) AS nth
  FROM raw_location_lookup WHERE lat <> '') t WHERE nth = 1"""

STRICT_EVENTS = f"""
SELECT id_text AS event_id, {SQL_SQUEEZE.format('name_text')} AS event_name,
       {SQL_STRICT_TIME.format('start_text')} AS start_ts, {SQL_STRICT_TIME.format('end_text')} AS end_ts,
       type_text AS event_type, location_text
FROM raw_events
WHERE name_text <> '' AND position(',' IN name_text) = 0 AND tail_text <> '' AND type_text <> ''
  AND {SQL_STRICT_TIME.format('start_text')} <= {SQL_STRICT_TIME.format('end_text')}"""


@query("c06_clean_events_strict", f"""
SELECT event_id, event_name, start_ts, end_ts, event_type, coalesce(lat, '0.0') AS lat,
       coalesce(lon, '0.0') AS lon, coalesce(location_id, 'UNKNOWN') AS location_id
FROM ({STRICT_EVENTS}) e LEFT JOIN ({LOADED_LOCATIONS}) l ON raw_location = location_text""")
def c06(v: Views) -> DataFrame:
    locations = lookups.load_locations(v["raw_location_lookup"], order_by="line_no")
    return C.clean_events_strict(event_pieces(v), locations)


# Best zone of every distinct location, by comparing all pairs.
MATCHED_ZONES = f"""
SELECT std, -low AS location_id FROM (
  SELECT std, max([least(length(std), length(zone_name)), -location_id])[2] AS low
  FROM (SELECT DISTINCT {STANDARD_NAME.format('location_text')} AS std FROM raw_events) n,
       ({LOADED_ZONES}) z
  WHERE std <> '' AND zone_name <> '' AND (contains(std, zone_name) OR contains(zone_name, std))
  GROUP BY std) m"""


CLEAN_EVENTS = f"""
SELECT id_text AS event_id, {SQL_SQUEEZE.format("replace(name_text, chr(34), '')")} AS event_name,
       {SQL_MULTI_TIME.format('start_text')} AS start_ts, {SQL_MULTI_TIME.format('end_text')} AS end_ts,
       type_text AS event_type, CAST(coalesce(location_id, -1) AS INT) AS start_location_id,
       CAST(coalesce(location_id, -1) AS INT) AS end_location_id
FROM raw_events LEFT JOIN ({MATCHED_ZONES}) m ON std = {STANDARD_NAME.format('location_text')}
WHERE name_text <> '' AND {SQL_MULTI_TIME.format('start_text')} <= {SQL_MULTI_TIME.format('end_text')}"""


@query("c07_clean_events_multiformat", CLEAN_EVENTS)
def c07(v: Views) -> DataFrame:
    return C.clean_events_multiformat(event_rows(v), lookups.load_zones(v["raw_zone_lookup"]))


def _trip_reasons(view: str, passengers: bool, distance: str) -> str:
    count = f"WHEN NOT {SQL_WHOLE.format('passenger_count', 1, 6)} THEN 'PASSENGER_COUNT'" if passengers else ""
    return f"""
WITH r AS (SELECT CASE {count}
    WHEN NOT {SQL_NUMBER.format(distance, 0, 100)} THEN 'TRIP_DISTANCE'
    WHEN NOT {SQL_ZONE.format('"PULocationID"')} THEN 'PU_LOCATION'
    WHEN NOT {SQL_ZONE.format('"DOLocationID"')} THEN 'DO_LOCATION' END AS reason FROM {view})
SELECT 'TOTAL' AS counter, count(*) AS n FROM r
UNION ALL SELECT CASE WHEN reason IS NULL THEN 'VALID' ELSE 'INVALID' END, count(*) FROM r GROUP BY 1
UNION ALL SELECT reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY 1"""


for _name, _kind, _passengers, _distance in (
    ("trips", "yellow", True, "trip_distance"), ("green_trips", "green", True, "trip_distance"), ("fhv_trips", "fhv", False, "trip_miles"),
):
    query(f"c08_reject_summary_{_name}", _trip_reasons(f"raw_{_kind}", _passengers, _distance))(
        lambda v, k=_kind: C.reject_summary(C.screen_trips(v[f"raw_{k}"], k)))


@query("c08_reject_summary_subway", """
WITH r AS (SELECT CASE
    WHEN tail_text = '' THEN 'TOO_FEW_COLUMNS'
    WHEN origin_text IN ('', 'n/a') OR lat_text = ' NULL ' OR dest_text = 'NA' THEN 'MISSING_CRITICAL_FIELDS'
    END AS reason FROM raw_subway
  UNION ALL SELECT 'HEADER_SKIPPED')
SELECT 'TOTAL' AS counter, count(*) AS n FROM r
UNION ALL SELECT CASE WHEN reason IS NULL THEN 'VALID' ELSE 'INVALID' END, count(*) FROM r GROUP BY 1
UNION ALL SELECT reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY 1
UNION ALL SELECT 'COLUMNS_14', count(*) FROM r WHERE reason = 'TOO_FEW_COLUMNS'""")
def c08_subway(v: Views) -> DataFrame:
    return C.reject_summary(C.screen_subway(parsed_subway(v)), by_field_count=True)


# -- parsing and reshaping


@query("x01_parse_multi_ts", f"SELECT event_id, {SQL_MULTI_TIME.format('start_text')} AS start_ts FROM raw_events")
def x01(v: Views) -> DataFrame:
    return v["raw_events"].select("event_id", P.parse_multi_ts(F.col("start_text")).alias("start_ts"))


@query("x02_parse_event_ts", f"SELECT event_id, {SQL_STRICT_TIME.format('start_text')} AS start_ts FROM raw_events")
def x02(v: Views) -> DataFrame:
    return v["raw_events"].select("event_id", P.parse_event_ts(F.col("start_text")).alias("start_ts"))


@query("x03_standardize_name", f"SELECT zone, {STANDARD_NAME.format('zone')} AS zone_name FROM raw_zone_lookup")
def x03(v: Views) -> DataFrame:
    return v["raw_zone_lookup"].select("zone", TX.standardize_name(F.col("zone")).alias("zone_name"))


@query("x04_normalize_trips_epoch", """
SELECT make_timestamp(pickup_datetime) AS pickup_ts, make_timestamp(dropoff_datetime) AS dropoff_ts,
       "PULocationID" AS start_location_id, "DOLocationID" AS end_location_id, trip_miles AS trip_distance,
       CAST(1 AS INT) AS passenger_count, taxi_type FROM epoch_trips""")
def x04_epoch(v: Views) -> DataFrame:
    return X.normalize_trips(v["epoch_trips"], "fhv")


@query("x04_normalize_trips_typed", """
SELECT tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
       CAST("PULocationID" AS INT) AS start_location_id, CAST("DOLocationID" AS INT) AS end_location_id,
       trip_distance, CAST(passenger_count AS INT) AS passenger_count, 'yellow' AS taxi_type
FROM typed_yellow
WHERE passenger_count BETWEEN 1 AND 6 AND trip_distance BETWEEN 0 AND 100
  AND "PULocationID" BETWEEN 1 AND 263 AND "DOLocationID" BETWEEN 1 AND 263""")
def x04_typed(v: Views) -> DataFrame:
    kinds = {"tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz",
             "passenger_count": "double", "trip_distance": "double", "PULocationID": "int", "DOLocationID": "int"}
    return X.normalize_trips(C.clean_yellow(readers.select_typed(v["typed_yellow"], kinds)), "yellow")


@query("x05_type_and_partition_trips", TYPED_TRIPS)
def x05(v: Views) -> DataFrame:
    return X.type_and_partition_trips(v["text_trips"])


def _as_text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query("x06_type_and_partition_events", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_name, start_time, end_time, event_type, start_location_id,
       end_location_id, CAST(year(start_time) AS INT) AS year, CAST(month(start_time) AS INT) AS month
FROM permits""")
def x06(v: Views) -> DataFrame:
    text = v["permits"].select(
        F.col("event_id").cast("string").alias("event_id"), "event_name", _as_text("start_time"),
        _as_text("end_time"), "event_type", F.col("start_location_id").cast("string").alias("start_location_id"),
        F.col("end_location_id").cast("string").alias("end_location_id"))
    return X.type_and_partition_events(text)


def _city_zone(side: str) -> str:
    """The square of ``city_rings`` around a ride end."""
    x, y = f"CAST({side}_lng AS DOUBLE)", f"CAST({side}_lat AS DOUBLE)"
    return f"""CASE WHEN {x} BETWEEN -74.1025 AND -73.8525 AND {y} BETWEEN 40.6775 AND 40.9275
       THEN CAST(1 + floor(({x} + 74.1025) / 0.05) + 5 * floor(({y} - 40.6775) / 0.05) AS INT) END AS {side}_location_id"""


TYPED_BIKES = f"""
SELECT ride_id, trim(rideable_type) AS rideable_type, CAST(started_at AS TIMESTAMP) AS started_at,
       CAST(ended_at AS TIMESTAMP) AS ended_at, start_station_name, start_station_id, end_station_name, end_station_id,
       CAST(start_lat AS DOUBLE) AS start_lat, CAST(start_lng AS DOUBLE) AS start_lng,
       CAST(end_lat AS DOUBLE) AS end_lat, CAST(end_lng AS DOUBLE) AS end_lng, member_casual AS member_type,
       CAST(1 AS INT) AS passenger_count, {_city_zone('start')}, {_city_zone('end')},
       CAST(year(CAST(started_at AS TIMESTAMP)) AS INT) AS year,
       CAST(month(CAST(started_at AS TIMESTAMP)) AS INT) AS month
FROM ({BIKE_FIELDS}) b WHERE n_fields >= 13 AND {BIKE_OK}"""


def typed_bikes(v: Views) -> DataFrame:
    """Clean rides (C4) with the zones of both ends (J3), typed (X7)."""
    rides, cells = C.clean_bikes(bike_pieces(v)), J.zone_cells(v["city_rings"])
    rides = rides.withColumns({f"{side}_{c}": F.col(f"{side}_{c}").cast("double") for side in ("start", "end") for c in ("lat", "lng")})
    for side in ("start", "end"):
        rides = J.assign_zone_by_point(rides, cells, f"{side}_lng", f"{side}_lat", f"{side}_location_id")
    return X.type_and_partition_bikes(rides)


query("x07_type_and_partition_bikes", TYPED_BIKES)(typed_bikes)


_TRIP_LIST = ", ".join([*S.TRIP_COLUMNS, "year", "month"])


@query("x08_combine_trips", f"SELECT {_TRIP_LIST} FROM trips_all UNION ALL SELECT {_TRIP_LIST} FROM taxi_rides")
def x08(v: Views) -> DataFrame:
    names = [*S.TRIP_COLUMNS, "year", "month"]
    kinds = [v["trips_all"].filter(F.col("taxi_type") == k).select(*names) for k in ("green", "yellow", "fhv")]
    return X.combine_trips(*kinds, v["taxi_rides"].select(*names))


# -- enrichment


@query("j01_lookup_location", f"""
SELECT event_id, location_text, coalesce(lat, '0.0') AS lat, coalesce(lon, '0.0') AS lon,
       coalesce(location_id, 'UNKNOWN') AS location_id
FROM raw_events LEFT JOIN ({LOADED_LOCATIONS}) l ON raw_location = location_text""")
def j01(v: Views) -> DataFrame:
    locations = lookups.load_locations(v["raw_location_lookup"], order_by="line_no")
    return J.lookup_location(v["raw_events"].select("event_id", "location_text"), locations, "location_text")


@query("j02_match_zone_by_name", f"""
SELECT event_id, location_text, CAST(coalesce(location_id, -1) AS INT) AS location_id
FROM raw_events LEFT JOIN ({MATCHED_ZONES}) m ON std = {STANDARD_NAME.format('location_text')}""")
def j02(v: Views) -> DataFrame:
    events = v["raw_events"].select("event_id", "location_text")
    return J.match_zone_by_name(events, lookups.load_zones(v["raw_zone_lookup"]), "location_text")


def _inside(x: str, y: str) -> str:
    """Strictly inside a unit square, or inside one without its upper right quarter."""
    dx, dy = f"({x} - n_nationkey % 5)", f"({y} - n_nationkey // 5)"
    return f"""({dx} > 0 AND {dy} > 0 AND CASE n_nationkey % 2 WHEN 0 THEN {dx} < 1 AND {dy} < 1
      ELSE ({dx} < 1 AND {dy} < 0.5) OR ({dx} < 0.5 AND {dy} < 1) END)"""


POINT_ZONES = f"""
SELECT p.*, a.n_nationkey + 1 AS start_location_id, a.n_name AS start_location_id_zone,
       r.r_name AS start_location_id_borough, b.n_nationkey + 1 AS end_location_id
FROM ride_points p
LEFT JOIN nation a ON {_inside('start_lng', 'start_lat').replace('n_nationkey', 'a.n_nationkey')}
LEFT JOIN region r ON a.n_regionkey = r.r_regionkey
LEFT JOIN nation b ON {_inside('end_lng', 'end_lat').replace('n_nationkey', 'b.n_nationkey')}"""


def zoned_rides(v: Views) -> DataFrame:
    grid = 8  # the zones of the view are a degree wide
    cells = J.zone_cells(v["zone_rings"], grid)
    starts = J.assign_zone_by_point(
        v["ride_points"], cells, "start_lng", "start_lat", "start_location_id", True, grid)
    return J.assign_zone_by_point(starts, cells, "end_lng", "end_lat", "end_location_id", False, grid)


@query("j03_assign_zone_by_point", POINT_ZONES)
def j03(v: Views) -> DataFrame:
    return zoned_rides(v)


@query("j04_unmatched_points", f"""
WITH z AS ({POINT_ZONES})
SELECT ride_id, 'start' AS side, start_lat AS lat, start_lng AS lng FROM z WHERE start_location_id IS NULL
UNION ALL
SELECT ride_id, 'end' AS side, end_lat AS lat, end_lng AS lng FROM z WHERE end_location_id IS NULL""")
def j04(v: Views) -> DataFrame:
    return J.unmatched_points(zoned_rides(v))
