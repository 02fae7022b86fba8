"""Profiles and audits on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.operators import profiling as P
from zonepulse.plans.cleaning import (
    BIKE_FIELDS,
    SQL_DATETIME,
    SQL_NUMBER,
    SQL_STATION,
    SQL_STRICT_TIME,
    SQL_TIME_TEXT,
    SQL_ZONE,
    bike_pieces,
    event_pieces,
)
from zonepulse.plans.registry import query
from zonepulse.plans.views import Views
from zonepulse.sources import readers, writers
from zonepulse.sources.scratch import scratch_path


def _profile_sql(kind: str) -> str:
    layout = S.TRIP_LAYOUTS[kind]
    checks = [("PICKUP_DATETIME", layout.pickup, SQL_DATETIME.format(layout.pickup), True),
              ("DROPOFF_DATETIME", layout.dropoff, SQL_DATETIME.format(layout.dropoff), True)]
    if layout.passengers:
        checks.append(("PASSENGER_COUNT", "passenger_count", SQL_NUMBER.format("passenger_count", 1, 6), True))
    checks += [
        (layout.distance.upper(), layout.distance, SQL_NUMBER.format(layout.distance, 0, 100), True),
        ("PU_LOCATION", '"PULocationID"', SQL_ZONE.format('"PULocationID"'), False),
        ("DO_LOCATION", '"DOLocationID"', SQL_ZONE.format('"DOLocationID"'), False),
    ]
    parts = [f"SELECT 'TOTAL_RECORDS' AS metric, count(*) AS n FROM raw_{kind}"]
    for label, column, ok, null_counts in checks:
        null = f"coalesce({column} IN ('', 'null'), true)" if null_counts else "false"
        parts.append(f"""
SELECT CASE WHEN {null} THEN 'NULL_' WHEN {ok} THEN 'VALID_' ELSE 'INVALID_' END || '{label}' AS metric, count(*) AS n
FROM raw_{kind} GROUP BY 1""")
    return " UNION ALL ".join(parts)


query("p01_profile_yellow", _profile_sql("yellow"))(lambda v: P.profile_trips(v["raw_yellow"], "yellow"))
query("p02_profile_green", _profile_sql("green"))(lambda v: P.profile_trips(v["raw_green"], "green"))
query("p03_profile_fhv", _profile_sql("fhv"))(lambda v: P.profile_trips(v["raw_fhv"], "fhv"))


@query("p01_profile_typed", """
WITH t AS (SELECT *, passenger_count AS p, trip_distance AS d, "PULocationID" AS pu, "DOLocationID" AS dr
           FROM typed_yellow)
SELECT * FROM (
  SELECT 'TOTAL_RECORDS' AS metric, count(*) AS n FROM t
  UNION ALL SELECT 'VALID_PICKUP_DATETIME', count(*) FROM t
  UNION ALL SELECT 'VALID_DROPOFF_DATETIME', count(*) FROM t
  UNION ALL SELECT 'NULL_PASSENGER_COUNT', count(*) FROM t WHERE p IS NULL
  UNION ALL SELECT 'VALID_PASSENGER_COUNT', count(*) FROM t WHERE p BETWEEN 1 AND 6
  UNION ALL SELECT 'INVALID_PASSENGER_COUNT', count(*) FROM t WHERE p NOT BETWEEN 1 AND 6
  UNION ALL SELECT 'VALID_TRIP_DISTANCE', count(*) FROM t WHERE d BETWEEN 0 AND 100
  UNION ALL SELECT 'INVALID_TRIP_DISTANCE', count(*) FROM t WHERE d NOT BETWEEN 0 AND 100
  UNION ALL SELECT 'VALID_PU_LOCATION', count(*) FROM t WHERE pu BETWEEN 1 AND 263
  UNION ALL SELECT 'INVALID_PU_LOCATION', count(*) FROM t WHERE pu NOT BETWEEN 1 AND 263
  UNION ALL SELECT 'VALID_DO_LOCATION', count(*) FROM t WHERE dr BETWEEN 1 AND 263
  UNION ALL SELECT 'INVALID_DO_LOCATION', count(*) FROM t WHERE dr NOT BETWEEN 1 AND 263) u
WHERE n > 0""")
def p01_typed(v: Views) -> DataFrame:
    return P.profile_trips(v["typed_yellow"], "yellow")


@query("p04_profile_report", f"""
WITH p AS ({_profile_sql("yellow")}),
     s AS (SELECT sum(CASE WHEN metric = 'TOTAL_RECORDS' THEN n END) AS total,
                  sum(CASE WHEN metric <> 'TOTAL_RECORDS' THEN n END) AS checks,
                  sum(CASE WHEN metric LIKE 'VALID_%' THEN n END) AS good,
                  sum(CASE WHEN metric LIKE '%VALID%' THEN n END) AS literal FROM p)
SELECT metric, n, round(n * 100.0::DOUBLE / total, 2) AS pct FROM p, s
UNION ALL SELECT 'QUALITY_SCORE', CAST(good AS BIGINT), round(good * 100.0::DOUBLE / checks, 2) FROM s
UNION ALL SELECT 'QUALITY_SCORE_LITERAL', CAST(literal AS BIGINT), round(literal * 100.0::DOUBLE / checks, 2) FROM s""")
def p04(v: Views) -> DataFrame:
    return P.profile_report(P.profile_trips(v["raw_yellow"], "yellow"))


# Bike columns of the rows long enough, for the checking SQL.
_RIDES = f"(SELECT * FROM ({BIKE_FIELDS}) f WHERE n_fields >= 13)"


def _share(part: str) -> str:
    return f"round(count(*) FILTER ({part}) * 100.0::DOUBLE / count(*), 2)"


def _counted(part: str, name: str) -> str:
    return f"count(*) FILTER ({part}) AS {name}, {_share(part)} AS {name}_pct"


def _head(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) AS total, {_counted(f"{column} = ''", 'missing')}"""


def _time_sql(c: str) -> str:
    usable = f"length({c}) IN (19, 23)"
    full = f"CASE length({c}) WHEN 19 THEN {c} || '.000' ELSE {c} END"
    return ", ".join([
        _counted(f"{c} <> '' AND NOT {usable}", "invalid"), _counted(f"length({c}) = 19", "miss_precision"),
        _counted(f"{usable} AND NOT {SQL_TIME_TEXT.format(c)}", "out_of_range"),
        f"min({full}) FILTER ({usable}) AS min_time, max({full}) FILTER ({usable}) AS max_time"])


def _coordinate_sql(c: str) -> str:
    lo, hi = S.LAT_RANGE if c.endswith("lat") else S.LNG_RANGE
    value = f"try_cast({c} AS DOUBLE)"
    finite = f"coalesce(isfinite({value}), false)"
    return ", ".join([
        _counted(f"{c} <> '' AND NOT {finite}", "invalid"),
        _counted(f"{finite} AND {value} NOT BETWEEN {lo} AND {hi}", "out_of_range")])


@query("p05_profile_id_column", f"{_head('ride_id')} FROM {_RIDES} r")
def p05_id(v: Views) -> DataFrame:
    return P.profile_id_column(_rides(v), "ride_id")


@query("p05_profile_name_column", f"{_head('start_station_name')} FROM {_RIDES} r")
def p05_name(v: Views) -> DataFrame:
    return P.profile_name_column(_rides(v), "start_station_name")


def _rides(v: Views) -> DataFrame:
    return P.bike_columns(bike_pieces(v)).filter(F.col("n_fields") >= len(S.BIKE_COLUMNS))


@query("p06_profile_categorical", f"""
WITH r AS {_RIDES},
     s AS ({_head('rideable_type')}, count(DISTINCT nullif(rideable_type, '')) AS unique_values FROM r)
SELECT 'rideable_type' AS column_name, * FROM (
  SELECT 'total' AS measure, CAST(NULL AS VARCHAR) AS value, total AS n, CAST(NULL AS DOUBLE) AS pct FROM s
  UNION ALL SELECT 'missing', NULL, missing, missing_pct FROM s
  UNION ALL SELECT 'unique_values', NULL, unique_values, NULL FROM s
  UNION ALL SELECT 'value', rideable_type, count(*), NULL FROM r WHERE rideable_type <> '' GROUP BY 2) u""")
def p06(v: Views) -> DataFrame:
    return P.profile_categorical(_rides(v), "rideable_type")


@query("p07_profile_station_id", f"""
{_head('start_station_id')},
  {_counted(f"start_station_id <> '' AND NOT {SQL_STATION.format('start_station_id')}", 'invalid')}
FROM {_RIDES} r""")
def p07(v: Views) -> DataFrame:
    return P.profile_station_id(_rides(v), "start_station_id")


@query("p08_profile_time_column", f"""
{_head('started_at')}, {_time_sql('started_at')},
  '[2024-01-01 00:00:00.000 to 2025-11-01 00:00:00.000]' AS accepted_range
FROM {_RIDES} r""")
def p08(v: Views) -> DataFrame:
    return P.profile_time_column(_rides(v), "started_at")


@query("p09_profile_coordinate", f"{_head('start_lat')}, {_coordinate_sql('start_lat')} FROM {_RIDES} r")
def p09(v: Views) -> DataFrame:
    return P.profile_coordinate(_rides(v), "start_lat")


def _bike_profile_sql() -> str:
    parts = []
    for c in S.BIKE_COLUMNS:
        sql = _head(c)
        if c in ("rideable_type", "member_casual"):
            sql += f", count(DISTINCT nullif({c}, '')) AS unique_values"
        elif c.endswith("station_id"):
            sql += ", " + _counted(f"{c} <> '' AND NOT {SQL_STATION.format(c)}", "invalid")
        elif c in ("started_at", "ended_at"):
            sql += ", " + _time_sql(c)
        elif c.endswith(("lat", "lng")):
            sql += ", " + _coordinate_sql(c)
        parts.append(f"{sql} FROM rides")
    return f"WITH rides AS {_RIDES} " + " UNION ALL BY NAME ".join(parts)


@query("p10_profile_bikes", _bike_profile_sql())
def p10(v: Views) -> DataFrame:
    return P.profile_bikes(bike_pieces(v))


@query("p10_malformed_bikes", f"SELECT count(*) FILTER (n_fields < 13) AS malformed_row FROM ({BIKE_FIELDS}) f")
def p10_malformed(v: Views) -> DataFrame:
    return P.malformed_bikes(bike_pieces(v))


# Event lines cut at commas, empty pieces at the end dropped: a comma inside a name makes up for one of them.
_EVENTS = """(SELECT len(f) = 12 AS ok, trim(f[1]) AS id_text, trim(f[2]) AS name_text, trim(f[3]) AS start_text,
  trim(f[4]) AS end_text, trim(f[6]) AS type_text, trim(f[8]) AS location_text
  FROM (SELECT string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM event_lines) s)"""


@query("p11_profile_events", f"""
WITH e AS {_EVENTS}
SELECT * FROM (
  SELECT 'row_count' AS metric, count(*) AS n FROM e
  UNION ALL SELECT 'malformed_row', count(*) FROM e WHERE NOT ok
  UNION ALL SELECT 'empty_event_name', count(*) FROM e WHERE ok AND trim(name_text) = ''
  UNION ALL SELECT 'empty_start_time', count(*) FROM e WHERE ok AND start_text = ''
  UNION ALL SELECT 'empty_end_time', count(*) FROM e WHERE ok AND end_text = ''
  UNION ALL SELECT 'empty_event_type', count(*) FROM e WHERE ok AND type_text = ''
  UNION ALL SELECT 'empty_event_location', count(*) FROM e WHERE ok AND location_text = ''
  UNION ALL SELECT 'location_mapping_missing', count(*) FROM e WHERE ok AND location_text = ''
  UNION ALL SELECT 'invalid_timestamp_start', count(*) FROM e
    WHERE ok AND start_text <> '' AND {SQL_STRICT_TIME.format('start_text')} IS NULL
  UNION ALL SELECT 'invalid_timestamp_end', count(*) FROM e
    WHERE ok AND end_text <> '' AND {SQL_STRICT_TIME.format('end_text')} IS NULL) u
WHERE n > 0""")
def p11(v: Views) -> DataFrame:
    return P.profile_events(event_pieces(v))


@query("p12_event_value_counts", f"""
SELECT 'event_type' AS kind, type_text AS value, count(*) AS n FROM {_EVENTS} e WHERE ok AND type_text <> '' GROUP BY 2
UNION ALL
SELECT 'event_location', location_text, count(*) FROM {_EVENTS} e WHERE ok AND location_text <> '' GROUP BY 2""")
def p12(v: Views) -> DataFrame:
    return P.event_value_counts(event_pieces(v))


@query("p13_event_time_bounds", f"""
SELECT min({SQL_STRICT_TIME.format('start_text')}) AS min_start_time,
       max({SQL_STRICT_TIME.format('start_text')}) AS max_start_time,
       min({SQL_STRICT_TIME.format('end_text')}) AS min_end_time,
       max({SQL_STRICT_TIME.format('end_text')}) AS max_end_time
FROM {_EVENTS} e WHERE ok""")
def p13(v: Views) -> DataFrame:
    return P.event_time_bounds(event_pieces(v))


@query("p14_audit_location_ids", """
WITH s AS (SELECT taxi_type AS kind, start_location_id AS id, 1 AS a, 0 AS b FROM trips_all
           UNION ALL SELECT taxi_type, end_location_id, 0, 1 FROM trips_all),
     i AS (SELECT * FROM s UNION ALL SELECT 'ALL', id, a, b FROM s)
SELECT kind, count(DISTINCT id) FILTER (a = 1) AS start_ids, count(DISTINCT id) FILTER (b = 1) AS end_ids,
       count(DISTINCT id) AS all_ids, min(id) AS min_id, max(id) AS max_id,
       count(DISTINCT id) FILTER (id BETWEEN 1 AND 263) AS in_range,
       count(DISTINCT id) FILTER (id NOT BETWEEN 1 AND 263) AS out_of_range
FROM i GROUP BY kind""")
def p14(v: Views) -> DataFrame:
    return P.audit_location_ids(v["trips_all"])


@query("p14_location_ids_out_of_range", """
SELECT DISTINCT id FROM (SELECT start_location_id AS id FROM trips_all UNION SELECT end_location_id FROM trips_all) t
WHERE id NOT BETWEEN 1 AND 263""")
def p14_outside(v: Views) -> DataFrame:
    return P.location_ids_out_of_range(v["trips_all"])


@query("p15_partition_counts", "SELECT year, month, count(*) AS n FROM trips_all GROUP BY year, month")
def p15(v: Views) -> DataFrame:
    return P.partition_counts(v["trips_all"])


@query("p16_preview", "SELECT * FROM bike_rides ORDER BY ride_id LIMIT 10")
def p16_preview(v: Views) -> DataFrame:
    return P.preview(v["bike_rides"], "ride_id", 10)


@query("p16_find_by_ids", """
SELECT * FROM bike_rides WHERE year = 2024 AND month = 1
  AND ride_id IN (SELECT CAST(max(event_id) - k AS VARCHAR) FROM events, (SELECT unnest(range(20)) AS k) r GROUP BY k)""")
def p16_ids(v: Views) -> DataFrame:
    """On a table with a folder for each month."""
    path = scratch_path(v.spark, "bikes")
    rides = v["bike_rides"]
    writers.write_curated(rides, path)
    last = v["events"].agg(F.max("event_id").alias("last"))
    ids = last.select(F.explode(F.sequence(F.col("last") - 19, F.col("last"))).alias("id"))
    ids = ids.select(F.col("id").cast("string").alias("ride_id"))
    return P.find_by_ids(readers.read_curated(v.spark, path), "ride_id", ids, 2024, 1).select(*rides.columns)
