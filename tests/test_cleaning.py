"""Cleaning, parsing and profiling on hand-made rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from zonepulse.functions import parsing, validators
from zonepulse.functions.text import standardize_name
from zonepulse.operators import cleaning, enrich, profiling, reshape
from zonepulse.plans.views import Views
from zonepulse.sources import lookups, readers

TRIP = "passenger_count string, trip_distance string, PULocationID string, DOLocationID string"


def lines_of(spark, rows, keep_trailing=True):
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    return df.select(F.col("value").alias("line"), readers.split_line(F.col("value"), keep_trailing).alias("fields"))


def raw_trips(spark, rows):
    times = [F.lit("2024-01-01T00:00:00").alias(n) for n in ("tpep_pickup_datetime", "tpep_dropoff_datetime")]
    return spark.createDataFrame(rows, TRIP).select(*times, "*")


@pytest.mark.parametrize("row, kept", [
    (("1", "0.0", "1", "263"), True),
    (("6", "100.0", "263", "1"), True),
    (("2.0", "1.0", "5", "5"), True),
    (("1.5", "1.0", "5", "5"), False),
    (("0", "1.0", "5", "5"), False),
    (("7", "1.0", "5", "5"), False),
    ((None, "1.0", "5", "5"), False),
    (("null", "1.0", "5", "5"), False),
    (("", "1.0", "5", "5"), False),
    (("2", "100.01", "5", "5"), False),
    (("2", "NaN", "5", "5"), False),
    (("2", "1.0", "264", "5"), False),
    (("2", "1.0", "0", "5"), False),
    (("2", "1.0", None, "5"), False),
    (("2", "1.0", "5.0", "5"), False),
])
def test_clean_trips(spark, row, kept):
    raw = raw_trips(spark, [row])
    assert cleaning.clean_yellow(raw).count() == int(kept)
    assert (cleaning.screen_trips(raw, "yellow").first()["reject_reason"] is None) == kept


def test_clean_trips_on_numbers(spark):
    """Stored numbers give the same rows as their text."""
    rows = [(1.0, 0.0, 1, 263.0), (1.5, 1.0, 5, 5.0), (7.0, 1.0, 5, 5.0), (2.0, float("nan"), 5, 5.0),
            (None, 1.0, 5, 5.0), (2.0, 1.0, 264, 5.0), (2.0, 1.0, 5, 5.5)]
    raw = spark.createDataFrame(
        rows, "passenger_count double, trip_distance double, PULocationID bigint, DOLocationID double"
    ).withColumns({n: F.lit(0).cast("bigint") for n in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    out = cleaning.clean_yellow(raw).collect()
    assert [(r.passenger_count, r.PULocationID, r.DOLocationID) for r in out] == [(1, 1, 263)]
    reasons = [r.reject_reason for r in cleaning.screen_trips(raw, "yellow").collect()]
    assert reasons == [None, "PASSENGER_COUNT", "PASSENGER_COUNT", "TRIP_DISTANCE", "PASSENGER_COUNT",
                       "PU_LOCATION", "DO_LOCATION"]


def test_profile_of_clean_trips_has_no_invalid(spark, sf_dir):
    v = Views(spark, sf_dir)
    raw = v["raw_yellow"]
    clean = cleaning.clean_yellow(raw)
    found = {r.metric for r in profiling.profile_trips(clean, "yellow").collect()}
    checked = ("PASSENGER_COUNT", "TRIP_DISTANCE", "PU_LOCATION", "DO_LOCATION")
    assert not {m for m in found if m.endswith(checked) and not m.startswith("VALID_")}
    again = cleaning.clean_yellow(clean)
    assert again.exceptAll(clean).isEmpty() and again.count() == clean.count()
    counts = {r.counter: r.n for r in cleaning.reject_summary(cleaning.screen_trips(raw, "yellow")).collect()}
    assert counts["VALID"] + counts["INVALID"] == counts["TOTAL"] == raw.count()
    assert counts["VALID"] == clean.count()


EVENT = "9,{name},{start},{end},Parks,{kind},Boro,{place},a,b,c,{tail}"


def event_line(name="Fair", start="01/02/2024 01:00:00 PM", end="01/02/2024 03:00:00 PM", kind="Sport",
               place="Central", tail="x"):
    return EVENT.format(name=name, start=start, end=end, kind=kind, place=place, tail=tail)


@pytest.mark.parametrize("change, strict, multi", [
    ({}, "2024-01-02 13:00:00", "2024-01-02 13:00:00"),
    ({"start": "1/2/2024 01:00:00 PM"}, "2024-01-02 13:00:00", "2024-01-02 13:00:00"),
    ({"start": "2024-01-02 13:00:00"}, None, "2024-01-02 13:00:00"),
    ({"start": "2024/01/02 13:00:00"}, None, "2024-01-02 13:00:00"),
    ({"start": "2024-01-02", "end": "2024-01-02"}, None, "2024-01-02 00:00:00"),
    ({"start": "01/02/2024 04:00:00 PM"}, None, None),
    ({"start": "01/02/2024 03:00:00 PM"}, "2024-01-02 15:00:00", "2024-01-02 15:00:00"),
    ({"kind": ""}, None, "2024-01-02 13:00:00"),
    ({"name": '"Music, Food"'}, None, "2024-01-02 13:00:00"),
    ({"tail": ""}, None, "2024-01-02 13:00:00"),
    ({"start": "13/02/2024 01:00:00 PM"}, None, None),
    ({"start": "01/02/2024 1:00 PM"}, None, "2024-01-02 13:00:00"),
    ({"start": "01/02/24 01:00:00 PM"}, None, "2024-01-02 13:00:00"),
    ({"name": "  "}, None, None),
])
def test_clean_events(spark, change, strict, multi):
    line = event_line(**change)
    locations = spark.createDataFrame([("Nowhere", "1", "2", "3")], "raw_location string, lat string, lon string, location_id string")
    zones = spark.createDataFrame([("CENTRAL PARK", 43)], "zone_name string, location_id int")
    a = cleaning.clean_events_strict(lines_of(spark, [line], keep_trailing=False), locations).collect()
    rows = readers.parse_quoted(spark.createDataFrame([(line,)], "value string"), cleaning.EVENT_RAW_COLUMNS)
    b = cleaning.clean_events_multiformat(rows, zones).collect()
    assert [str(r.start_ts) for r in a] == ([strict] if strict else [])
    assert [str(r.start_ts) for r in b] == ([multi] if multi else [])
    if a:
        assert (a[0].lat, a[0].lon, a[0].location_id) == ("0.0", "0.0", "UNKNOWN")
    if b:
        assert b[0].start_location_id == b[0].end_location_id == 43
        assert b[0].event_name == change.get("name", "Fair").replace('"', "")


def test_event_names_are_squeezed(spark):
    line = event_line(name="Soccer   Non \t Regulation")
    rows = readers.parse_quoted(spark.createDataFrame([(line,)], "value string"), cleaning.EVENT_RAW_COLUMNS)
    zones = spark.createDataFrame([], "zone_name string, location_id int")
    out = cleaning.clean_events_multiformat(rows, zones).first()
    assert out.event_name == "Soccer Non Regulation"
    assert out.start_location_id == -1


@pytest.mark.parametrize("zones, location, expected", [
    ({"Hudson Yards": 10, "Yards": 20}, "Hudson-Yards: 5", 10),
    ({"Central Park": 43}, "Central", 43),
    ({"AA": 1, "BB": 2}, "AA BB", 1),
    ({"BB": 1, "AA": 2}, "AA BB", 1),
    ({"Astoria": 7}, "Flushing", -1),
    ({"Astoria": 7}, "", -1),
    ({"Astoria": 7}, None, -1),
    ({"A": 7}, "x a", 7),
    ({"Park Slope": 3, "Special Event Park": 9}, "Park Slope North 12", 3),
])
def test_match_zone_by_name(spark, zones, location, expected):
    table = spark.createDataFrame([(k, str(i)) for k, i in zones.items()], "zone string, location_id string")
    events = spark.createDataFrame([(1, location)], "event_id int, place string")
    out = enrich.match_zone_by_name(events, lookups.load_zones(table), "place").collect()
    assert [r.location_id for r in out] == [expected]


def test_match_zone_by_name_against_all_pairs(spark):
    words = ["PARK", "PARK SLOPE", "SLOPE", "EAST", "EAST PARK", "A", "YARDS", "HUDSON YARDS N", "NORTH"]
    zones = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "zone_name string, location_id int")
    places = [f"{a} {b}" for a in words for b in words] + [w[:3] for w in words] + ["ZZ"]
    events = spark.createDataFrame([(p,) for p in places], "place string")
    got = {r.place: r.location_id for r in enrich.match_zone_by_name(events, zones, "place").collect()}
    for p in places:
        hits = [(min(len(p), len(w)), -i) for i, w in enumerate(words) if w in p or p in w]
        assert got[p] == (-max(hits)[1] if hits else -1), p


BIKE = dict(
    ride_id="A1", rideable_type="classic", started_at="2024-05-01 10:00:00.000", ended_at="2024-05-01 10:10:00.000",
    start_station_name="A", start_station_id="8465.01", end_station_name="B", end_station_id="12",
    start_lat="40.7", start_lng="-74.0", end_lat="40.8", end_lng="-73.9", member_casual="member")


@pytest.mark.parametrize("change, kept", [
    ({}, True),
    ({"started_at": "2024-05-01 10:00:00"}, True),
    ({"started_at": "2024-05-01 10:00:00."}, False),
    ({"ended_at": "2025-11-01 00:00:00.000"}, True),
    ({"ended_at": "2025-11-01 00:00:00.001"}, False),
    ({"ended_at": "2024-05-01 10:00:00.000"}, False),
    ({"start_lat": "40.49"}, True),
    ({"start_lat": "40.92"}, True),
    ({"start_lat": "40.93"}, False),
    ({"start_lat": "NaN"}, False),
    ({"end_lng": "Infinity"}, False),
    ({"start_station_id": "JC009"}, False),
    ({"start_station_id": "12."}, False),
    ({"member_casual": " "}, False),
    ({"start_station_name": ""}, False),
])
def test_clean_bikes(spark, change, kept):
    line = ",".join({**BIKE, **change}.values())
    out = cleaning.clean_bikes(lines_of(spark, [line])).collect()
    assert [r.line for r in out] == ([line] if kept else [])


def test_short_bike_line(spark):
    line = ",".join(list(BIKE.values())[:12])
    screened = cleaning.screen_bikes(lines_of(spark, [line])).first()
    assert screened.reject_reason == "TOO_FEW_COLUMNS"
    assert profiling.malformed_bikes(lines_of(spark, [line])).first()[0] == 1


def test_bike_profile_of_clean_rides_is_clean(spark, sf_dir):
    v = Views(spark, sf_dir)
    lines = v["bike_lines"].select(F.col("value").alias("line"), readers.split_line(F.col("value")).alias("fields"))
    clean = cleaning.clean_bikes(lines).select("line", F.split("line", ",", -1).alias("fields"))
    profile = profiling.profile_bikes(clean).collect()
    assert len(profile) == 13
    for r in profile:
        assert not (r.missing or r.invalid or r.out_of_range), r


SUBWAY = '2024,1,Mon,5,{t},1,{o},{lat},-73.9,2,{d},40.8,-73.8,{n}{tail}'


@pytest.mark.parametrize("change, reason", [
    ({}, None),
    ({"o": '"Times Sq, 42 St"'}, None),
    ({"o": "n/a"}, "MISSING_CRITICAL_FIELDS"),
    ({"d": " NULL "}, "MISSING_CRITICAL_FIELDS"),
    ({"n": "NA"}, "MISSING_CRITICAL_FIELDS"),
    ({"n": ""}, "MISSING_CRITICAL_FIELDS"),
    ({"tail": ",p"}, "TOO_FEW_COLUMNS"),
    ({"t": "Timestamp"}, "HEADER_SKIPPED"),
])
def test_clean_subway(spark, change, reason):
    parts = {"t": "2024-01-01T05:00:00", "o": "A", "lat": "40.7", "d": "B", "n": "1.5", "tail": ",p,q", **change}
    line = SUBWAY.format(**parts)
    rows = readers.parse_quoted(spark.createDataFrame([(line,), (line,)], "value string"), cleaning.SUBWAY_RAW_COLUMNS)
    screened = cleaning.screen_subway(rows).collect()
    assert [r.reject_reason for r in screened] == [reason, reason]
    if reason is None:
        out = cleaning.clean_subway(rows, ordered=True).collect()
        assert len(out) == 2 and out[0].timestamp == "2024-01-01 05:00:00"
        assert out[0].origin_station_complex_name == parts["o"].replace('"', "")
    if reason == "TOO_FEW_COLUMNS":
        counts = {r.counter: r.n for r in cleaning.reject_summary(cleaning.screen_subway(rows), True).collect()}
        assert counts == {"TOTAL": 2, "INVALID": 2, "TOO_FEW_COLUMNS": 2, "COLUMNS_15": 2}


@pytest.mark.parametrize("text, ok", [
    ("2024-01-01T00:00:00", True), ("2025-12-31T23:59:59.123456789", True), ("2024-01-01T00:00Z", True),
    ("2024-01-01T00:00:00+05:00", True), ("2026-01-01T00:00:00", False), ("2024-01-01 00:00:00", False),
    ("2024-02-30T00:00:00", False), ("2024-01-01", False), ("null", False), ("", False), (None, False),
])
def test_valid_datetime(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(validators.valid_datetime(F.col("t"))).first()[0] is ok


@pytest.mark.parametrize("text, expected", [
    ("01/02/2024 12:30:00 AM", "2024-01-02 00:30:00"), ("01/02/2024 12:30:00 PM", "2024-01-02 12:30:00"),
    ("01-02-2024 01:02:03 pm", "2024-01-02 13:02:03"), ("2/29/2024", "2024-02-29 00:00:00"),
    ("2/29/2023", None), ("2024-01-02T03:04:05", "2024-01-02 03:04:05"), ("01/02/2024 13:00", "2024-01-02 13:00:00"),
    ("01/02/2024 24:00:00", None), ("hello", None), ("", None), (None, None), ("01/02", None),
])
def test_parse_multi_ts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(parsing.parse_multi_ts(F.col("t"))).first()[0]
    assert (str(got) if got else None) == expected
    staged = parsing.with_timestamps(df, {"out": "t"}, strict=False).first()["out"]
    assert staged == got


def test_standardize_name(spark):
    df = spark.createDataFrame([("Hudson-Yards: 5",), ("  a.b/c  ",), (None,), ("42",)], "n string")
    assert [r[0] for r in df.select(standardize_name(F.col("n"))).collect()] == ["HUDSON YARDS", "A B C", "", ""]


def test_epoch_times_keep_microseconds_in_any_time_zone(spark):
    us = 1_704_067_200_123_456
    df = spark.createDataFrame([(us, us + 1, 1, 2, 1.0, "fhv")],
                               "pickup_datetime bigint, dropoff_datetime bigint, PULocationID int, "
                               "DOLocationID int, trip_miles double, taxi_type string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = reshape.normalize_trips(df, "fhv").first()
        assert row.pickup_ts == datetime.datetime(2024, 1, 1, 0, 0, 0, 123456)
        assert row.passenger_count == 1
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_point_in_polygon(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    hole = [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25)]
    zones = spark.createDataFrame(
        [(5, "Z", "B", ring), (5, "Z", "B", hole)],
        "location_id int, zone string, borough string, ring array<struct<x:double,y:double>>")
    cases = {(1.0, 1.0): 5, (2.0, 3.0): None, (3.5, 2.0): 5, (5.0, 1.0): None, (0.0, 1.0): None, (2.0, 1.0): None,
             (0.5, 0.5): None, (0.1, 0.5): 5, (0.25, 0.5): None, (float("nan"), 1.0): None, (None, 1.0): None,
             (float("inf"), 1.0): None}
    points = spark.createDataFrame(list(cases), "x double, y double")
    for grid in (1, 8):
        cells = enrich.zone_cells(zones, grid)
        out = enrich.assign_zone_by_point(points, cells, "x", "y", "z", cells_per_degree=grid).collect()
        assert len(out) == len(cases)
        assert [r.z for r in out] == list(cases.values())
