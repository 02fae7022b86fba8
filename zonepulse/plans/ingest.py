"""Sources, lookups and sinks on the given tables: written to the scratch folder, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.operators.cleaning import EVENT_RAW_COLUMNS, SUBWAY_RAW_COLUMNS, clean_subway
from zonepulse.operators.reshape import type_and_partition_trips
from zonepulse.plans.registry import query, rounded
from zonepulse.plans.views import Views
from zonepulse.sources import lookups, readers, writers
from zonepulse.sources.scratch import scratch_path

STANDARD_NAME = r"""trim(regexp_replace(regexp_replace(regexp_replace(upper({0}), '[:,.\-/]', ' ', 'g'),
    '\s*-?\s*\d+\s*$', ''), '\s+', ' ', 'g'))"""

# Typed and partitioned trips, the expected content of every curated-table query.
TYPED_TRIPS = """
SELECT CAST(pickup_ts AS TIMESTAMP) AS pickup_ts, CAST(dropoff_ts AS TIMESTAMP) AS dropoff_ts,
       CAST(start_location_id AS INT) AS start_location_id, CAST(end_location_id AS INT) AS end_location_id,
       CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(passenger_count AS INT) AS passenger_count, taxi_type,
       CAST(year(CAST(pickup_ts AS TIMESTAMP)) AS INT) AS year,
       CAST(month(CAST(pickup_ts AS TIMESTAMP)) AS INT) AS month
FROM text_trips
WHERE (year(CAST(pickup_ts AS TIMESTAMP)) = 2024)
   OR (year(CAST(pickup_ts AS TIMESTAMP)) = 2025 AND month(CAST(pickup_ts AS TIMESTAMP)) <= 9)"""


def _lines_file(v: Views, name: str) -> str:
    path = scratch_path(v.spark, name)
    writers.write_text(v[name], path, "text")
    return path


def _typed_trips(v: Views) -> DataFrame:
    return type_and_partition_trips(v["text_trips"])


@query("s01_read_trips", """
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, CAST(NULL AS DOUBLE) AS trip_distance,
       CAST("PULocationID" AS INT) AS "PULocationID", CAST("DOLocationID" AS INT) AS "DOLocationID"
FROM typed_yellow""")
def s01(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "typed")
    v["typed_yellow"].drop("trip_distance").write.parquet(path)
    return readers.read_trips(v.spark, path, "yellow")


@query("s01_read_trips_mixed", """
SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
       CASE CAST("PULocationID" AS INT) % 3 WHEN 0 THEN NULL ELSE passenger_count END AS passenger_count,
       CASE CAST("PULocationID" AS INT) % 3 WHEN 1 THEN CAST(CAST(trip_distance AS INT) AS DOUBLE) ELSE trip_distance END
         AS trip_distance,
       CAST("PULocationID" AS INT) AS "PULocationID", CAST("DOLocationID" AS INT) AS "DOLocationID"
FROM typed_yellow""")
def s01_mixed(v: Views) -> DataFrame:
    """Three folders that store the columns differently: one lacks the passengers, numbers have other types."""
    path, trips = scratch_path(v.spark, "mixed"), v["typed_yellow"]
    for part, kinds in enumerate((
        {"PULocationID": "double", "DOLocationID": "bigint"},
        {"passenger_count": "bigint", "trip_distance": "int", "PULocationID": "int"},
        {"passenger_count": "float", "DOLocationID": "int"},
    )):
        one = trips.filter(F.col("PULocationID").cast("int") % 3 == part)
        one = one.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
        (one.drop("passenger_count") if part == 0 else one).write.parquet(f"{path}/month{part}")
    return readers.read_trips(v.spark, path, "yellow", recursive=True)


@query("s02_read_delimited_drop_trailing", r"""
SELECT value AS line, CAST(len(string_split(regexp_replace(value, ',+$', ''), ',')) AS INT) AS n_fields,
       string_split(value, ',')[1] AS first_field
FROM event_lines""")
def s02_drop(v: Views) -> DataFrame:
    rows = readers.read_delimited(v.spark, _lines_file(v, "event_lines"), "event id", keep_trailing=False)
    return rows.select("line", F.size("fields").alias("n_fields"), F.get("fields", F.lit(0)).alias("first_field"))


@query("s02_read_delimited_keep_trailing", """
SELECT value AS line, CAST(len(string_split(value, ',')) AS INT) AS n_fields,
       string_split(value, ',')[13] AS last_field
FROM bike_lines""")
def s02_keep(v: Views) -> DataFrame:
    rows = readers.read_delimited(v.spark, _lines_file(v, "bike_lines"), "ride_id")
    return rows.select("line", F.size("fields").alias("n_fields"), F.get("fields", F.lit(12)).alias("last_field"))


@query("s03_read_quoted", """
SELECT id_text AS f0, nullif(replace(name_text, '"', ''), '') AS f1, nullif(start_text, '') AS f2,
       nullif(location_text, '') AS f7, nullif(tail_text, '') AS f11, CAST(12 AS INT) AS n_fields
FROM raw_events""")
def s03(v: Views) -> DataFrame:
    rows = readers.read_quoted(v.spark, _lines_file(v, "event_lines"), EVENT_RAW_COLUMNS, "event id")
    return rows.select("f0", "f1", "f2", "f7", "f11", "n_fields")


@query("s04_read_json_trips", """
SELECT pickup_datetime, dropoff_datetime, trip_miles, "PULocationID", "DOLocationID", taxi_type FROM epoch_trips""")
def s04(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "json")
    writers.write_text(v["epoch_trips"], path, "json")
    return readers.read_json_trips(v.spark, path, "fhv")


@query("s05_read_csv_header", "SELECT * FROM text_trips")
def s05(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv")
    writers.write_text(v["text_trips"], path, "csv", header=True)
    return readers.read_csv(v.spark, path, list(S.TRIP_COLUMNS), header=True)


@query("s06_read_csv_headerless", f"""
SELECT {', '.join(f"nullif({n}, '') AS {n}" for n in S.BIKE_COLUMNS)} FROM raw_bikes""")
def s06(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv")
    writers.write_text(v["raw_bikes"].drop("event_id"), path, "csv")
    return readers.read_csv(v.spark, path, S.BIKE_COLUMNS, header=False)


@query("s07_read_recursive", "SELECT value FROM bike_lines")
def s07(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "nested")
    v["bike_lines"].withColumn("folder", F.length("value")).write.partitionBy("folder").text(path)
    return readers.read_lines(v.spark, path, "ride_id", recursive=True)


@query("s08_read_curated", f"""
SELECT year, month, taxi_type, count(*) AS trips, round(sum(trip_distance), 4) AS distance
FROM ({TYPED_TRIPS}) t GROUP BY year, month, taxi_type""")
def s08(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "curated")
    writers.write_curated(_typed_trips(v), path)
    table = readers.read_curated(v.spark, path, "trips")
    return rounded(table.groupBy("year", "month", "taxi_type").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_distance").alias("distance")))


@query("s09_load_locations", """
SELECT raw_location, lat, lon, location_id FROM (
  SELECT replace(raw_location, '"', '') AS raw_location, lat, lon, location_id,
         row_number() OVER (PARTITION BY raw_location ORDER BY line_no DESC) AS nth
  FROM raw_location_lookup WHERE lat <> '') t
WHERE nth = 1""")
def s09(v: Views) -> DataFrame:
    return lookups.load_locations(v["raw_location_lookup"], order_by="line_no")


LOADED_ZONES = f"""
SELECT {STANDARD_NAME.format('zone')} AS zone_name, max(CAST(location_id AS INT)) AS location_id
FROM raw_zone_lookup WHERE location_id <> 'n/a' AND zone NOT LIKE 'special event%' GROUP BY 1"""


@query("s10_load_zones", LOADED_ZONES)
def s10(v: Views) -> DataFrame:
    return lookups.load_zones(v["raw_zone_lookup"])


@query("k01_write_curated", TYPED_TRIPS)
def k01(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "curated")
    writers.write_curated(_typed_trips(v), path)
    return readers.read_curated(v.spark, path, "trips")


@query("k02_insert_append", f"SELECT * FROM ({TYPED_TRIPS}) a UNION ALL SELECT * FROM ({TYPED_TRIPS}) b")
def k02_append(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "curated")
    writers.insert_curated(_typed_trips(v), path)
    writers.insert_curated(_typed_trips(v), path)
    return readers.read_curated(v.spark, path, "trips")


@query("k02_insert_overwrite", f"""
SELECT * REPLACE (CASE WHEN month <= 6 THEN 2 * passenger_count ELSE passenger_count END AS passenger_count)
FROM ({TYPED_TRIPS}) t""")
def k02_overwrite(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "curated")
    writers.insert_curated(_typed_trips(v), path)
    first_half = _typed_trips(v).filter("month <= 6").withColumn("passenger_count", F.col("passenger_count") * 2)
    writers.insert_curated(first_half, path, overwrite=True)
    return readers.read_curated(v.spark, path, "trips")


@query("k03_save_result", "SELECT taxi_type, count(*) AS trips FROM trips_all GROUP BY taxi_type")
def k03(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "result")
    name = "result_" + path.rsplit("-", 1)[-1]
    counts = v["trips_all"].groupBy("taxi_type").agg(F.count(F.lit(1)).alias("trips"))
    writers.save_result(counts, name, path)
    return v.spark.table(name)


CLEAN_SUBWAY = """
SELECT replace(time_text, 'T', ' ') AS "timestamp",
       trim(replace(origin_text, '"', '')) AS origin_station_complex_name,
       trim(lat_text) AS origin_latitude, '-73.9' AS origin_longitude,
       trim(dest_text) AS destination_station_complex_name,
       '40.8' AS destination_latitude, '-73.8' AS destination_longitude, riders_text AS estimated_average_ridership
FROM raw_subway
WHERE tail_text <> '' AND origin_text NOT IN ('', 'n/a') AND lat_text <> ' NULL ' AND dest_text <> 'NA'"""


def parsed_subway(v: Views) -> DataFrame:
    return readers.parse_quoted(v["subway_lines"], SUBWAY_RAW_COLUMNS)


@query("k04_write_text", CLEAN_SUBWAY)
def k04(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "clean")
    writers.write_text(clean_subway(parsed_subway(v)), path, "csv", header=True)
    return readers.read_csv(v.spark, path, list(S.SUBWAY_FIELDS))


@query("k05_compact", "SELECT * FROM text_trips")
def k05(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "parts")
    v["text_trips"].repartition(48).write.option("header", True).csv(path)
    parts = readers.read_csv(v.spark, path, list(S.TRIP_COLUMNS))
    merged = scratch_path(v.spark, "merged")
    writers.compact(parts, merged, fmt="csv")
    return readers.read_csv(v.spark, merged, list(S.TRIP_COLUMNS))


@query("k06_register", f"""
SELECT DISTINCT 'year=' || CAST(year AS VARCHAR) || '/month=' || CAST(month AS VARCHAR) AS "partition"
FROM ({TYPED_TRIPS}) t""")
def k06(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "curated")
    writers.write_curated(_typed_trips(v), path)
    schema = ", ".join(f"{n} {k}" for n, k in {**S.TRIP_COLUMNS, "year": "int", "month": "int"}.items())
    return writers.register(v.spark, "trips_" + path.rsplit("-", 1)[-1], path, schema)
