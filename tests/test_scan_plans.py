"""How often inputs are read, and joins that stay whole when nothing is small enough to broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.operators import cleaning, enrich, profiling
from zonepulse.sources import readers, scratch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def best_zone(place, zones):
    """Longest overlap, then the smallest id, among zones of which one text contains the other."""
    fits = [(-min(len(place), len(z)), i) for z, i in zones if z and (z in place or place in z)]
    return min(fits)[1] if place and fits else -1


@pytest.fixture
def named_places(spark):
    rnd = random.Random(5)
    words = ["AA", "B", "PARK", "YARDS", "HUDSON", "QUEENSBRIDGE", "ZZ TOP", "LONG ISLAND", "ÉLAN", "PAR"]
    zones = sorted({(" ".join(rnd.sample(words, rnd.randint(1, 3))), i) for i in range(60)}, key=lambda z: z[1])
    places = [" ".join(rnd.sample([*words, "X", "NOWHERE"], rnd.randint(1, 4))) for _ in range(300)] + ["", None, "12", "PA", "ARD"] * 20 + ["HUDSON PARK"] * 500
    rows = [(k, p) for k, p in enumerate(places)]
    return rows, zones, spark.createDataFrame(rows, "event_id int, place string"), spark.createDataFrame(zones, "zone_name string, location_id int")


@pytest.mark.parametrize("small", [True, False])
def test_names_match_whatever_is_small(spark, named_places, monkeypatch, small):
    rows, zones, events, table = named_places
    if not small:
        for module in (scratch, enrich):
            monkeypatch.setattr(module, "is_small", lambda *_: False)
        monkeypatch.setattr(enrich, "_HEAVY_SHARE", 50)
    got = enrich.match_zone_by_name(events, table, "place")
    assert got.columns == ["event_id", "place", "location_id"]
    standard = {p: s for p, s in events.select("place", enrich.standardize_name(F.col("place"))).collect()}
    assert {r.event_id: r.location_id for r in got.collect()} == {k: best_zone(standard[p], zones) for k, p in rows}
    assert ("SortMergeJoin" in plan(got)) is False or not small


def test_hot_location_and_blanks_have_keys_of_their_own(spark, named_places, monkeypatch):
    _, _, events, table = named_places
    for module in (scratch, enrich):
        monkeypatch.setattr(module, "is_small", lambda *_: False)
    monkeypatch.setattr(enrich, "_HEAVY_SHARE", 50)
    seen = {}
    plain = enrich._matched_back

    def watch(keyed, places, best, std):
        out = plain(keyed, places, best, std)
        seen["keys"] = [r["count"] for r in out.groupBy("_key").count().collect()]
        return out

    monkeypatch.setattr(enrich, "_matched_back", watch)
    enrich.match_zone_by_name(events, table, "place").collect()
    assert max(seen["keys"]) < 20 < 500


def test_events_are_parsed_once(spark, tmp_path):
    lines = ['%d,Fair,01/02/2024 01:00:00 PM,01/02/2024 03:00:00 PM,Parks,Special Event,Boro,Central Park,a,b,c,x' % k for k in range(20)]
    path = tmp_path / "raw_events.csv"
    path.write_text("\n".join(lines))
    rows = readers.read_quoted(spark, str(path), cleaning.EVENT_RAW_COLUMNS)
    zones = spark.createDataFrame([("CENTRAL PARK", 43)], "zone_name string, location_id int")
    got = cleaning.clean_events_multiformat(rows, zones)
    assert "raw_events.csv" not in plan(got)  # only the parsed table is read from here on
    assert {r.start_location_id for r in got.collect()} == {43} and got.count() == 20


def test_ride_profile_reads_its_lines_once(spark, tmp_path):
    kinds = ["classic_bike", "electric_bike", "", "classic_bike"]
    lines = [f"r{k},{kinds[k % 4]},2024-01-02 03:04:05,2024-01-02 03:14:05,A,1.1,B,2.2,40.7,-73.9,40.8,-74.0,{'member' if k % 3 else 'casual'}" for k in range(50)]
    path = tmp_path / "rides.csv"
    path.write_text("\n".join(lines))
    got = profiling.profile_bikes(readers.read_delimited(spark, str(path)))
    assert plan(got).count("FileScan") == 1
    rows = {r.column_name: r for r in got.collect()}
    assert (rows["rideable_type"].unique_values, rows["rideable_type"].missing, rows["rideable_type"].total) == (2, 12, 50)
    assert rows["member_casual"].unique_values == 2 and rows["started_at"].unique_values is None
    assert rows["started_at"].min_time == rows["started_at"].max_time


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    out = run()
    spark.sparkContext.setJobGroup("rest", "rest")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), out


def trips(spark, n, **kinds):
    df = spark.range(n).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("tpep_pickup_datetime"), F.lit("2024-01-01 00:10:00").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.lit(2.0).alias("passenger_count"), F.col("id").cast("double").alias("trip_distance"),
        F.lit(5).cast("bigint").alias("PULocationID"), F.lit(6).cast("bigint").alias("DOLocationID"))
    return df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def test_many_files_are_planned_by_few_jobs(spark, tmp_path):
    path = str(tmp_path / "many")
    trips(spark, 400).repartition(200).write.parquet(path)
    n, df = jobs(spark, "one-layout", lambda: readers.read_trips(spark, path, "yellow"))
    assert n <= 3 and df.count() == 400  # the first file, the list of files, all footers
    trips(spark, 300, trip_distance="int", PULocationID="double").repartition(150).write.parquet(str(tmp_path / "mixed/2024-02"))
    trips(spark, 400).drop("passenger_count").repartition(200).write.parquet(str(tmp_path / "mixed/2024-01"))
    n, df = jobs(spark, "two-layouts", lambda: readers.read_trips(spark, str(tmp_path / "mixed"), "yellow", recursive=True))
    assert n < 60
    got = df.groupBy("passenger_count").agg(F.count("*").alias("n"), F.sum("trip_distance").alias("d"), F.max("PULocationID").alias("p")).collect()
    assert sorted((r.passenger_count or 0, r.n, r.d, r.p) for r in got) == [(0, 400, 79800.0, 5), (2, 300, 44850.0, 5)]
    assert set(df.columns) == set(S.TRIP_LAYOUTS["yellow"].columns)
