"""Mobility-shaped views of the given tables.

The given tables hold no trips, so each view derives one input of an operator from them. A view is
written once as SQL text; only the few functions that differ by engine go through ``Dialect``. Spark
uses the view as a DataFrame, the checking SQL uses the same text as a CTE. Every view reads its whole
tables; faults in raw views are keyed on ids so that all of them occur.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonepulse.functions.plan import evaluate_once

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Dialect:
    """Spark SQL spellings."""

    name = "spark"
    layouts = {
        "iso": "yyyy-MM-dd'T'HH:mm:ss",
        "sql": "yyyy-MM-dd HH:mm:ss",
        "sql_ms": "yyyy-MM-dd HH:mm:ss.SSS",
        "slash_ymd": "yyyy/MM/dd HH:mm:ss",
        "us12": "MM/dd/yyyy hh:mm:ss a",
        "us12_short": "M/d/yyyy hh:mm:ss a",
        "us24": "MM/dd/yyyy HH:mm:ss",
        "us12_dash": "MM-dd-yyyy hh:mm:ss a",
        "us12_no_seconds": "MM/dd/yyyy hh:mm a",
        "us_date": "MM/dd/yyyy",
        "us24_no_seconds": "MM/dd/yyyy HH:mm",
        "sql_no_seconds": "yyyy-MM-dd HH:mm",
        "us24_dash": "MM-dd-yyyy HH:mm:ss",
        "iso_date": "yyyy-MM-dd",
        "us12_two_digits": "MM/dd/yy hh:mm:ss a",
    }

    def fmt(self, ts: str, layout: str) -> str:
        return f'date_format({ts}, "{self.layouts[layout]}")'

    def text(self, x: str) -> str:
        return f"CAST({x} AS STRING)"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))"

    def days(self, n: str) -> str:
        return f"make_dt_interval(CAST({n} AS INT))"

    def hours(self, n: str) -> str:
        return f"make_dt_interval(0, CAST({n} AS INT))"

    def to_minute(self, ts: str) -> str:
        return f"({ts} - make_dt_interval(0, 0, 0, extract(SECOND FROM {ts})))"

    def to_second(self, ts: str) -> str:
        return f"({ts} - make_dt_interval(0, 0, 0, extract(SECOND FROM {ts}) - second({ts})))"

    def epoch_us(self, ts: str) -> str:
        return (f"(CAST(datediff({ts}, DATE '1970-01-01') AS BIGINT) * 86400000000 + "
                f"(hour({ts}) * 3600 + minute({ts}) * 60) * 1000000L + "
                f"CAST(extract(SECOND FROM {ts}) * 1000000 AS BIGINT))")

    def words(self, x: str, i: int) -> str:
        return f"split_part({x}, ' ', {i})"

    def ring(self, points: list[tuple[str, str]]) -> str:
        made = ", ".join(f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))" for x, y in points)
        return f"array({made})"


class DuckDialect(Dialect):
    """DuckDB spellings."""

    name = "duckdb"
    layouts = {
        "iso": "%Y-%m-%dT%H:%M:%S",
        "sql": "%Y-%m-%d %H:%M:%S",
        "sql_ms": "%Y-%m-%d %H:%M:%S.%g",
        "slash_ymd": "%Y/%m/%d %H:%M:%S",
        "us12": "%m/%d/%Y %I:%M:%S %p",
        "us12_short": "%-m/%-d/%Y %I:%M:%S %p",
        "us24": "%m/%d/%Y %H:%M:%S",
        "us12_dash": "%m-%d-%Y %I:%M:%S %p",
        "us12_no_seconds": "%m/%d/%Y %I:%M %p",
        "us_date": "%m/%d/%Y",
        "us24_no_seconds": "%m/%d/%Y %H:%M",
        "sql_no_seconds": "%Y-%m-%d %H:%M",
        "us24_dash": "%m-%d-%Y %H:%M:%S",
        "iso_date": "%Y-%m-%d",
        "us12_two_digits": "%m/%d/%y %I:%M:%S %p",
    }

    def fmt(self, ts: str, layout: str) -> str:
        return f"strftime({ts}, '{self.layouts[layout]}')"

    def text(self, x: str) -> str:
        return f"CAST({x} AS VARCHAR)"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) // ({b}))"

    def days(self, n: str) -> str:
        return f"to_days(CAST({n} AS INT))"

    def hours(self, n: str) -> str:
        return f"to_hours(CAST({n} AS INT))"

    def to_minute(self, ts: str) -> str:
        return f"date_trunc('minute', {ts})"

    def to_second(self, ts: str) -> str:
        return f"date_trunc('second', {ts})"

    def epoch_us(self, ts: str) -> str:
        return f"epoch_us({ts})"

    def ring(self, points: list[tuple[str, str]]) -> str:
        return "[" + ", ".join(f"{{'x': CAST({x} AS DOUBLE), 'y': CAST({y} AS DOUBLE)}}" for x, y in points) + "]"


VIEWS: dict[str, Callable[[Dialect], str]] = {}


def view(fn: Callable[[Dialect], str]) -> Callable[[Dialect], str]:
    VIEWS[fn.__name__] = fn
    return fn


# -- trips over several years, from orders and their lines


@view
def trips_all(d: Dialect) -> str:
    return """
    SELECT o_orderkey, l_linenumber, o_orderdate AS pickup_ts, l_shipdate AS dropoff_ts,
           c_nationkey AS start_location_id, s_nationkey AS end_location_id,
           l_extendedprice / 1000 AS trip_distance, CAST(l_quantity AS INT) AS passenger_count,
           CASE l_returnflag WHEN 'A' THEN 'yellow' WHEN 'N' THEN 'green' ELSE 'fhv' END AS taxi_type,
           CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey"""


@view
def taxi_volume(d: Dialect) -> str:
    return "SELECT * FROM trips_all WHERE taxi_type = 'yellow'"


@view
def subway_volume(d: Dialect) -> str:
    return """
    SELECT pickup_ts AS transit_timestamp, start_location_id AS origin_location_id,
           CASE WHEN end_location_id = 7 THEN NULL ELSE end_location_id END AS destination_location_id,
           passenger_count / CAST(4 AS DOUBLE) AS estimated_average_ridership, year, month
    FROM trips_all WHERE taxi_type = 'green'"""


@view
def bike_volume(d: Dialect) -> str:
    return """
    SELECT pickup_ts AS started_at, dropoff_ts AS ended_at,
           CASE WHEN start_location_id = 3 THEN NULL ELSE start_location_id END AS start_location_id,
           end_location_id, 1 AS passenger_count, year, month
    FROM trips_all WHERE taxi_type = 'fhv'"""


# -- trips and permitted events with times of day, from events


@view
def taxi_rides(d: Dialect) -> str:
    return """
    SELECT event_id AS trip_id, ts AS pickup_ts, ts + INTERVAL '10' MINUTE AS dropoff_ts,
           CAST(1 + user_id % 25 AS INT) AS start_location_id,
           CAST(1 + (user_id + event_id % 3) % 25 AS INT) AS end_location_id,
           value AS trip_distance, CAST(1 + event_id % 6 AS INT) AS passenger_count,
           CASE event_type WHEN 'click' THEN 'yellow' ELSE 'fhv' END AS taxi_type,
           CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month
    FROM events WHERE event_type IN ('click', 'signup')"""


@view
def subway_rides(d: Dialect) -> str:
    # every second week is folded onto the week before it, so that some weeks have no subway data
    return f"""
    SELECT transit_timestamp, origin_location_id, destination_location_id, estimated_average_ridership,
           CAST(year(transit_timestamp) AS INT) AS year, CAST(month(transit_timestamp) AS INT) AS month
    FROM (
      SELECT ts - {d.days(f"7 * ({d.div('day(ts) - 1', '7')} % 2)")} AS transit_timestamp,
             CAST(1 + user_id % 25 AS INT) AS origin_location_id,
             CAST(1 + (user_id + event_id % 3) % 25 AS INT) AS destination_location_id,
             value AS estimated_average_ridership
      FROM events WHERE event_type = 'view') v"""


@view
def bike_rides(d: Dialect) -> str:
    return f"""
    SELECT {d.text('event_id')} AS ride_id, ts AS started_at, ts + INTERVAL '10' MINUTE AS ended_at,
           CAST(1 + user_id % 25 AS INT) AS start_location_id,
           CAST(1 + (user_id + event_id % 3) % 25 AS INT) AS end_location_id,
           CAST(1 AS INT) AS passenger_count,
           CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month
    FROM events WHERE event_type = 'error'"""


@view
def permits(d: Dialect) -> str:
    # dates are folded onto every fifth day, so that days without events remain for the baselines
    return f"""
    SELECT event_id, event_name, event_type, start_time,
           start_time + {d.hours('1 + event_id % 7')} AS end_time, start_location_id, end_location_id
    FROM (
      SELECT event_id, 'Event ' || {d.text('event_id')} AS event_name,
             CASE event_id % 3 WHEN 0 THEN 'Special Event' WHEN 1 THEN 'Sport - Youth'
                  ELSE 'Sport - Adult' END AS event_type,
             {d.to_minute('ts')} + {d.days('3 - (day(ts) - 1) % 5')} AS start_time,
             CAST(1 + user_id % 25 AS INT) AS start_location_id,
             CAST(1 + user_id % 25 AS INT) AS end_location_id
      FROM events WHERE event_type = 'purchase') v"""


# -- raw records with faults


def _raw_time(d: Dialect, ts: str) -> str:
    return f"""CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN {d.fmt(ts, 'iso')} || 'Z'
           WHEN 4 THEN {d.fmt(ts, 'sql')} ELSE {d.fmt(ts, 'iso')} END"""


def _raw_taxi(d: Dialect, flag: str, pickup: str, dropoff: str, distance: str, passengers: bool) -> str:
    count = f"""CASE l_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN '0'
           WHEN 4 THEN '7' WHEN 5 THEN '2.0' ELSE {d.text('1 + l_linenumber % 6')} END AS passenger_count,"""
    return f"""
    SELECT {_raw_time(d, f"(l_shipdate + {d.days('9862')})")} AS {pickup},
           {_raw_time(d, f"(l_shipdate + {d.days('9863')})")} AS {dropoff},
           {count if passengers else ''}
           CASE l_partkey % 11 WHEN 0 THEN '100.01' WHEN 1 THEN '-0.5' WHEN 2 THEN 'NaN' WHEN 3 THEN 'abc'
                ELSE {d.text('CAST(l_quantity AS INT)')} || '.5' END AS {distance},
           CASE l_suppkey % 9 WHEN 0 THEN '264' WHEN 1 THEN '0' WHEN 2 THEN NULL WHEN 3 THEN 'x1'
                ELSE {d.text('1 + l_suppkey % 263')} END AS "PULocationID",
           CASE l_partkey % 7 WHEN 0 THEN '-1' WHEN 1 THEN '' ELSE {d.text('1 + l_partkey % 263')} END
             AS "DOLocationID"
    FROM lineitem WHERE l_returnflag = '{flag}'"""


@view
def raw_yellow(d: Dialect) -> str:
    return _raw_taxi(d, "A", "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", True)


@view
def raw_green(d: Dialect) -> str:
    return _raw_taxi(d, "N", "lpep_pickup_datetime", "lpep_dropoff_datetime", "trip_distance", True)


@view
def raw_fhv(d: Dialect) -> str:
    return _raw_taxi(d, "R", "pickup_datetime", "dropoff_datetime", "trip_miles", False)


@view
def typed_yellow(d: Dialect) -> str:
    """Typed trips as they lie in parquet; counts and ids are stored as doubles and longs."""
    return f"""
    SELECT ts AS tpep_pickup_datetime, ts + INTERVAL '10' MINUTE AS tpep_dropoff_datetime,
           CASE event_id % 5 WHEN 0 THEN NULL ELSE CAST(event_id % 9 AS DOUBLE) END AS passenger_count,
           CAST(event_id % 120 AS DOUBLE) AS trip_distance,
           CAST(user_id % 270 AS BIGINT) AS "PULocationID",
           CAST(event_id % 280 AS DOUBLE) AS "DOLocationID"
    FROM events"""


@view
def epoch_trips(d: Dialect) -> str:
    """Cleaned for-hire trips with times in epoch microseconds."""
    return f"""
    SELECT {d.epoch_us('ts')} AS pickup_datetime, {d.epoch_us("(ts + INTERVAL '10' MINUTE)")} AS dropoff_datetime,
           value AS trip_miles, CAST(1 + user_id % 263 AS INT) AS "PULocationID",
           CAST(1 + event_id % 263 AS INT) AS "DOLocationID", 'fhv' AS taxi_type
    FROM events"""


@view
def text_trips(d: Dialect) -> str:
    """Reshaped trips as text; the years run from 2022 to 2028."""
    return f"""
    SELECT {d.fmt(f"(o_orderdate + {d.days('9862')})", 'sql')} AS pickup_ts,
           {d.fmt(f"(l_shipdate + {d.days('9862')})", 'sql')} AS dropoff_ts,
           {d.text('1 + l_suppkey % 263')} AS start_location_id, {d.text('1 + l_partkey % 263')} AS end_location_id,
           {d.text('CAST(l_quantity AS INT)')} || '.5' AS trip_distance,
           {d.text('1 + l_linenumber % 6')} AS passenger_count, 'yellow' AS taxi_type
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _event_time(d: Dialect, ts: str) -> str:
    layouts = ["us12", "sql", "slash_ymd", "us12_short", "us24", "us12_dash", "us12_no_seconds", "us_date",
               "us24_no_seconds", "sql_no_seconds", "us24_dash", "iso_date", "us12_two_digits"]
    cases = " ".join(f"WHEN {i} THEN {d.fmt(ts, layout)}" for i, layout in enumerate(layouts))
    return f"CASE event_id % 15 {cases} WHEN 13 THEN '13/45/2024 01:00:00 PM' ELSE '' END"


@view
def raw_events(d: Dialect) -> str:
    """Fields of permitted-event lines before they are joined with commas."""
    return f"""
    SELECT event_id, {d.text('event_id')} AS id_text,
           CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN 'Soccer   Non  Regulation' WHEN 2 THEN '"Music, Food"'
                WHEN 3 THEN '  Fair ' ELSE 'Event ' || {d.text('event_id')} END AS name_text,
           {_event_time(d, 'ts')} AS start_text,
           {_event_time(d, "(ts + " + d.hours('event_id % 9 - 1') + ")")} AS end_text,
           CASE event_id % 12 WHEN 0 THEN '' WHEN 1 THEN 'Sport - Youth' ELSE 'Special Event' END AS type_text,
           CASE event_id % 7 WHEN 0 THEN upper(p_name) || ': ' || {d.text('event_id % 9')}
                WHEN 1 THEN {d.words('p_name', 2)} WHEN 2 THEN 'Main - ' || p_name WHEN 3 THEN ''
                WHEN 4 THEN 'Nowhere' WHEN 5 THEN p_name || '/annex' ELSE p_name END AS location_text,
           CASE event_id % 17 WHEN 0 THEN '' ELSE 'x' END AS tail_text
    FROM events JOIN part ON p_partkey = user_id"""


@view
def event_lines(d: Dialect) -> str:
    return """
    SELECT id_text || ',' || name_text || ',' || start_text || ',' || end_text || ',Parks,' || type_text ||
           ',Boro,' || location_text || ',a,b,c,' || tail_text AS value
    FROM raw_events"""


@view
def raw_zone_lookup(d: Dialect) -> str:
    return f"""
    SELECT p_name || CASE p_partkey % 3 WHEN 0 THEN ' 12' WHEN 1 THEN '-' ELSE '' END AS zone,
           CASE p_partkey % 29 WHEN 0 THEN 'n/a' ELSE {d.text('1 + p_partkey % 263')} END AS location_id
    FROM part
    UNION ALL SELECT 'special event ' || n_name, {d.text('n_nationkey')} FROM nation"""


@view
def raw_location_lookup(d: Dialect) -> str:
    return f"""
    SELECT '"' || p_name || '"' AS raw_location,
           CASE p_partkey % 31 WHEN 0 THEN '' ELSE '40.' || {d.text('p_partkey')} END AS lat,
           '-73.' || {d.text('p_partkey')} AS lon, {d.text('1 + p_partkey % 263')} AS location_id, p_partkey AS line_no
    FROM part"""


@view
def raw_bikes(d: Dialect) -> str:
    """Fields of bike-ride lines."""
    return f"""
    SELECT event_id,
           CASE event_id % 41 WHEN 0 THEN '' ELSE {d.text('event_id')} END AS ride_id,
           CASE event_type WHEN 'click' THEN 'classic_bike' WHEN 'view' THEN ' electric_bike ' WHEN 'error' THEN ''
                ELSE 'electric_bike' END AS rideable_type,
           CASE event_id % 13 WHEN 0 THEN {d.fmt('ts', 'sql')} WHEN 1 THEN {d.fmt('ts', 'sql')} || '.12'
                WHEN 2 THEN '' WHEN 3 THEN '2023-12-31 23:59:59.999' ELSE {d.fmt('ts', 'sql_ms')} END AS started_at,
           CASE event_id % 14 WHEN 0 THEN {d.fmt('ts', 'sql')} WHEN 1 THEN '2025-11-01 00:00:00.001'
                WHEN 2 THEN '2025-11-01 00:00:00.000'
                ELSE {d.fmt("(ts + INTERVAL '10' MINUTE)", 'sql_ms')} END AS ended_at,
           CASE event_id % 15 WHEN 0 THEN ' ' ELSE 'Station ' || {d.text('user_id')} END AS start_station_name,
           CASE event_id % 16 WHEN 0 THEN 'JC009' WHEN 1 THEN '12.' WHEN 2 THEN '8465.01'
                ELSE {d.text('1 + user_id')} END AS start_station_id,
           'Station ' || {d.text('event_id % 50')} AS end_station_name,
           CASE event_id % 18 WHEN 0 THEN '' ELSE {d.text('1 + event_id % 50')} END AS end_station_id,
           CASE event_id % 19 WHEN 0 THEN '40.93' WHEN 1 THEN 'NaN' WHEN 2 THEN '' WHEN 3 THEN 'north'
                WHEN 4 THEN '40.49' ELSE '40.7' || {d.text('event_id % 10')} END AS start_lat,
           '-73.9' || {d.text('event_id % 10')} AS start_lng,
           '40.8' || {d.text('event_id % 10')} AS end_lat,
           CASE event_id % 21 WHEN 0 THEN '-74.27' ELSE '-74.0' || {d.text('event_id % 10')} END AS end_lng,
           CASE event_id % 22 WHEN 0 THEN '' WHEN 1 THEN 'casual' ELSE 'member' END AS member_casual
    FROM events"""


@view
def bike_lines(d: Dialect) -> str:
    full = " || ',' || ".join([
        "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id",
        "end_station_name", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng"])
    return f"""
    SELECT {full} || CASE WHEN event_id % 43 = 0 THEN '' ELSE ',' || member_casual END AS value FROM raw_bikes"""


@view
def raw_subway(d: Dialect) -> str:
    """Fields of subway lines."""
    return f"""
    SELECT event_id, {d.fmt('ts', 'iso')} AS time_text,
           CASE event_id % 9 WHEN 0 THEN '"Times Sq, 42 St"' WHEN 1 THEN 'n/a' WHEN 2 THEN ''
                ELSE 'Stop ' || {d.text('user_id')} END AS origin_text,
           CASE event_id % 10 WHEN 0 THEN ' NULL ' ELSE '40.7' END AS lat_text,
           CASE event_id % 8 WHEN 0 THEN 'NA' ELSE ' Stop ' || {d.text('event_id % 50')} || ' ' END AS dest_text,
           {d.text('event_id % 100')} || '.5' AS riders_text,
           CASE WHEN event_id % 23 = 0 THEN '' ELSE ',p,q' END AS tail_text
    FROM events"""


@view
def subway_lines(d: Dialect) -> str:
    return """
    SELECT '2024,1,Monday,5,' || time_text || ',1,' || origin_text || ',' || lat_text || ',-73.9,2,' ||
           dest_text || ',40.8,-73.8,' || riders_text || tail_text AS value
    FROM raw_subway
    UNION ALL SELECT 'Year,Month,Day,Hour,Timestamp,f,g,h,i,j,k,l,m,n,o,p'"""


# -- points and polygons


@view
def zone_rings(d: Dialect) -> str:
    """A 5 x 5 grid of unit squares; every odd one lacks its upper right quarter."""
    x0, y0 = "n_nationkey % 5", d.div("n_nationkey", "5")
    square = [(x0, y0), (f"{x0} + 1", y0), (f"{x0} + 1", f"{y0} + 1"), (x0, f"{y0} + 1")]
    corner = [(x0, y0), (f"{x0} + 1", y0), (f"{x0} + 1", f"{y0} + 0.5"), (f"{x0} + 0.5", f"{y0} + 0.5"),
              (f"{x0} + 0.5", f"{y0} + 1"), (x0, f"{y0} + 1")]
    return f"""
    SELECT n_nationkey + 1 AS location_id, n_name AS zone, r_name AS borough,
           CASE n_nationkey % 2 WHEN 0 THEN {d.ring(square)} ELSE {d.ring(corner)} END AS ring
    FROM nation JOIN region ON n_regionkey = r_regionkey"""


@view
def city_rings(d: Dialect) -> str:
    """A 5 x 5 grid of squares over the ends of the bike rides, whose borders no ride end lies on."""
    x0, y0 = "(n_nationkey % 5) * 0.05 - 74.1025", f"{d.div('n_nationkey', '5')} * 0.05 + 40.6775"
    square = [(x0, y0), (f"{x0} + 0.05", y0), (f"{x0} + 0.05", f"{y0} + 0.05"), (x0, f"{y0} + 0.05")]
    return f"""
    SELECT n_nationkey + 1 AS location_id, n_name AS zone, r_name AS borough, {d.ring(square)} AS ring
    FROM nation JOIN region ON n_regionkey = r_regionkey"""


@view
def ride_points(d: Dialect) -> str:
    """Ride ends on a sixteenth grid, some outside of all zones, some without coordinates."""
    return """
    SELECT event_id AS ride_id,
           CASE WHEN event_id % 37 = 0 THEN NULL ELSE (user_id * 7 + event_id) % 90 / CAST(16 AS DOUBLE) END AS start_lng,
           (event_id * 11) % 83 / CAST(16 AS DOUBLE) AS start_lat,
           (event_id * 5 + user_id) % 81 / CAST(16 AS DOUBLE) AS end_lng,
           (event_id * 3) % 85 / CAST(16 AS DOUBLE) AS end_lat
    FROM events"""


def _names_in(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))
    return [n for n in VIEWS if n in words]


def with_views(body: str) -> str:
    """``body`` as DuckDB SQL with the views it names (and those they name) as CTEs."""
    duck = DuckDialect()
    ordered: dict[str, str] = {}

    def need(sql: str) -> None:
        for name in _names_in(sql):
            if name not in ordered:
                text = VIEWS[name](duck)
                need(text)
                ordered[name] = text

    need(body)
    ctes = [f"{n} AS ({sql})" for n, sql in ordered.items()]
    own = re.match(r"\s*WITH\s+", body)
    if own:
        return "WITH " + ",\n".join([*ctes, body[own.end():]])
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


class Views:
    """The views over one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def _make(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        sql = VIEWS[name](Dialect()).replace('AS "PULocationID"', "AS PULocationID").replace(
            'AS "DOLocationID"', "AS DOLocationID").replace('"DOLocationID"', "DOLocationID")
        words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))
        inputs = {n: self[n] for n in [*VIEWS, *TABLES] if n in words and re.search(rf"(FROM|JOIN)\s+{n}\b", sql)}
        for n in inputs:
            sql = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", sql)
        made = self.spark.sql(sql, **inputs)
        # raw views stand for files: their text is built once, as a scan would deliver it
        return evaluate_once(made) if name.startswith("raw_") or name.endswith("_lines") else made
