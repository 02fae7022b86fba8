"""Window sums of one length against plain Python, and the plans of the event analyses on curated tables."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.test_impact import EVENTS, HALF, TRIPS, make_events, make_trips, mode_frames
from zonepulse.operators import impact, windows
from zonepulse.schemas import CITIBIKE, SUBWAY, TAXI
from zonepulse.sources import readers, scratch, writers


@pytest.mark.parametrize("length, period", [(10, None), (7, None), (11, 40), (10, 40), (40, 40), (1, 40), (39, 40)])
def test_equal_window_sums(spark, length, period):
    rng = random.Random(length)
    low, high = (0, period - 1) if period else (-60, 60)
    ticks = [(rng.choice("ab"), rng.choice([1, 2, None]), rng.randint(low, high), rng.choice([None, *range(1, 9)])) for _ in range(300)]
    spans = [(i, rng.choice("abc"), rng.randint(low, high)) for i in range(80)]
    got = windows.equal_window_sums(
        spark.createDataFrame(ticks, "key string, day int, pos bigint, w bigint"),
        spark.createDataFrame(spans, "id int, key string, lo bigint"), ["key"], ["w"], length, period, ["day"])
    found = {(r.id, r.day): r.w or 0 for r in got.groupBy("id", "day").agg(F.sum("w").alias("w")).collect()}
    for i, key, lo in spans:
        inside = {p % period if period else p for p in range(lo, lo + length)}
        for day in (1, 2, None):
            expected = sum(w or 0 for k, d, p, w in ticks if (k, d) == (key, day) and p in inside)
            assert found.get((i, day), 0) == expected


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), 1e17])
def test_nothing_outside_a_clock_window_touches_its_baseline(spark, odd):
    day = dt.datetime(2024, 5, 1)
    events = [(1, "n", "t", day.replace(hour=11), day.replace(hour=12), 4, 4)]
    other = day + dt.timedelta(days=2)
    rides = [(other.replace(hour=9, minute=29, second=59), 9, 4, odd), (other.replace(hour=10), 9, 4, 5.0), (other.replace(hour=11, second=1), 9, 4, odd),
             (other.replace(hour=11), 9, 4, 0.25), (other.replace(hour=9, minute=30), 9, 4, 0.5)]
    schema = "transit_timestamp timestamp_ntz, origin_location_id int, destination_location_id int, estimated_average_ridership double"
    subway, frame = spark.createDataFrame(rides, schema), spark.createDataFrame(events, EVENTS)
    assert impact.daily_baseline(frame, subway, SUBWAY).first().baseline_inbound == 5.75
    assert impact.baseline_average(frame, {SUBWAY: subway}).first().baseline_subway_inbound == 5.75


def test_broadcast_and_shuffle_agree(spark, monkeypatch):
    events, trips = make_events(11), make_trips(12, subsecond=True)
    frame, tables = spark.createDataFrame(events, EVENTS), mode_frames(spark, trips)
    small = sorted(map(tuple, impact.event_actual(frame, *tables).collect()))
    for module in (scratch, windows, impact):
        monkeypatch.setattr(module, "is_small", lambda *_: False)
    assert sorted(map(tuple, impact.event_actual(frame, *tables).collect())) == small


@pytest.fixture(autouse=True)
def whole_plans(spark):
    """Plans are shown with all their filters."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    """Trips of two years in the layout of the curated tables, and events of two months."""
    at, made = tmp_path_factory.mktemp("curated"), {}
    trips = [(s + dt.timedelta(days=rng), e + dt.timedelta(days=rng), a, b, w) for rng in range(0, 700, 20) for s, e, a, b, w in make_trips(rng, 40)]
    taxi, subway, bikes = mode_frames(spark, trips)
    for mode, df in ((TAXI, taxi), (SUBWAY, subway), (CITIBIKE, bikes)):
        t = F.col(mode.day_time)
        path = str(at / mode.name)
        writers.write_curated(df.withColumns({"year": F.year(t), "month": F.month(t)}), path, fmt="parquet")
        made[mode] = readers.read_curated(spark, path, fmt="parquet")
    return trips, made


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, mode):
    return [x for x in re.findall(r"FileScan parquet.*", text) if f"/{mode.name}]" in x or f"/{mode.name}," in x or f"/{mode.name} " in x]


def test_folders_are_pruned_by_the_windows(spark, curated):
    trips, tables = curated
    frame = spark.createDataFrame(make_events(13, repeat=False), EVENTS)
    for mode, column, longest in ((SUBWAY, "transit_timestamp", None), (CITIBIKE, "started_at", 1), (TAXI, "dropoff_ts", 1)):
        got = impact.sampled_impact(frame, tables[mode], mode, year=None, longest_trip_days=longest)
        (scan,) = scans(plan(got), mode)
        assert "dynamicpruning" in re.search(r"PartitionFilters: \[.*?\], PushedFilters", scan).group()
        assert re.search(rf"PushedFilters: .*GreaterThanOrEqual\({column}", scan)
        everything = impact.sampled_impact(frame, tables[mode].drop("year", "month"), mode, year=None)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, everything.collect()))


def test_pruned_table_reads_few_folders(spark, curated):
    _, tables = curated
    frame = spark.createDataFrame(make_events(13, repeat=False), EVENTS)
    kept = impact.within({SUBWAY: tables[SUBWAY]}, impact._spread_windows(impact.event_windows(frame), 3), None)[SUBWAY]
    kept.collect()
    node = kept._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in node
    assert {(r.year, r.month) for r in kept.select("year", "month").distinct().collect()} <= {(2023, 12), (2024, 1)}


def test_summary_scans_each_table_once(spark, curated):
    _, tables = curated
    frame = spark.createDataFrame(make_events(14, repeat=False), EVENTS)
    text = plan(impact.summarize(impact.sampled_impacts(frame, tables)))
    assert [len(scans(text, m)) for m in tables] == [1, 1, 1]
    text = plan(impact.event_actual(frame, *tables.values()))
    assert [len(scans(text, m)) for m in tables] == [1, 1, 1]
    one = {m: impact.sampled_impact(frame, t, m) for m, t in tables.items()}
    together = impact.summarize(impact.sampled_impacts(frame, tables)).collect()
    apart = impact.event_transit_summary(one[TAXI], one[SUBWAY], one[CITIBIKE]).collect()
    assert together == apart


def daily_rows(df):
    return sorted(((r.event_id, r.baseline_date, r.baseline_inbound, r.baseline_outbound) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])


def test_days_of_an_event_are_neither_grouped_nor_sorted(spark):
    """They become rows in the last step, so no task holds what an event's days make of its input."""
    days = impact.daily_baseline(spark.createDataFrame(make_events(15), EVENTS), spark.createDataFrame(make_trips(16), TRIPS), TAXI)
    assert "Aggregate" not in plan(days) and "baseline_date" not in "".join(re.findall(r"(?:Sort|Exchange) .*", plan(days)))


@pytest.mark.parametrize("directional", [False, True])
def test_daily_baseline_over_many_tasks(spark, monkeypatch, directional):
    # an id of several rows, some alike, some without a zone or a time; rows without an id
    t, events = dt.datetime(2024, 1, 10, 9), make_events(17)
    events += [(900, "n", "t", t, t, 1, 1)] * 3 + [(900, "n", "t", None, t, 2, 2), (900, "n", "t", t, t, None, 1), (901, "n", "t", None, None, 1, 1)]
    events += [(None, "n", "t", t, t, 1, 1), (None, "n", "t", t, t, 3, 1), (902, "n", "t", t, t, None, 1)]
    frame, trips = spark.createDataFrame(events, EVENTS), spark.createDataFrame(make_trips(18), TRIPS)
    few = daily_rows(impact.daily_baseline(frame, trips, TAXI, directional))
    assert {None, 900, 901} <= {r[0] for r in few} and 902 not in {r[0] for r in few}
    once = [r for r in daily_rows(impact.daily_baseline(frame.filter("event_id = 900").limit(1), trips, TAXI, directional)) if r[2] or r[3]]
    many = {r[1]: r for r in daily_rows(impact.daily_baseline(frame.filter("event_id = 900 AND start_location_id = 1"), trips, TAXI, directional))}
    assert once and all(many[r[1]][2:] == (3 * r[2], 3 * r[3]) for r in once)
    monkeypatch.setattr(windows, "_TASK_ROWS", 50)
    assert daily_rows(impact.daily_baseline(frame, trips, TAXI, directional)) == few
