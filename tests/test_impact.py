"""Window sums, baselines and event impact against plain Python on small random data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zonepulse.operators import impact, volume, windows
from zonepulse.operators.temporal import subway_temporal_profile
from zonepulse.plans.views import Views
from zonepulse.schemas import CITIBIKE, SUBWAY, TAXI

TRIPS = "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, start_location_id int, end_location_id int, passenger_count int"
EVENTS = ("event_id int, event_name string, event_type string, start_time timestamp_ntz, end_time timestamp_ntz, "
          "start_location_id int, end_location_id int")
HALF = dt.timedelta(minutes=90)


@pytest.mark.parametrize("width, period", [(10, None), (7, None), (10, 40)])
def test_window_sums(spark, width, period):
    rng = random.Random(width)
    low, high = (0, period - 1) if period else (-60, 60)
    ticks = [(rng.choice("ab"), rng.randint(low, high), rng.randint(1, 9)) for _ in range(300)]
    spans = []
    for _ in range(80):
        lo = rng.randint(low, high)
        spans.append((rng.choice("abc"), lo, lo + rng.randint(0, 25)))
    got = windows.window_sums(
        spark.createDataFrame(ticks, "key string, pos bigint, w bigint"),
        spark.createDataFrame(spans + spans[:5], "key string, lo bigint, hi bigint"), ["key"], ["w"], width, period)
    found = {(r.key, r.lo, r.hi): r.w for r in got.collect()}
    expected = {}
    for key, lo, hi in set(spans):
        if lo < hi:
            inside = {p % period if period else p for p in range(lo, hi)}
            expected[key, lo, hi] = sum(w for k, p, w in ticks if k == key and p in inside)
    assert found == expected


def make_trips(seed, n=400, subsecond=False, zones=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 6 * 86400))
        if subsecond:
            start += dt.timedelta(microseconds=rng.randint(0, 999_999))
        end = start + dt.timedelta(minutes=rng.randint(0, 40))
        a, b = rng.choice([None, *range(1, zones + 1)]), rng.randint(1, zones)
        rows.append((start, end, a, b, rng.randint(1, 6)))
    return rows


def make_events(seed, n=25, subsecond=False, zones=3, repeat=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = dt.datetime(2024, 1, 3) + dt.timedelta(minutes=rng.randint(0, 1439))
        if subsecond:
            start += dt.timedelta(microseconds=rng.randint(0, 999_999))
        end = start + dt.timedelta(hours=rng.randint(0, 4))
        event_id = i // 2 if repeat and i < 8 else i
        zone = rng.choice([*range(1, zones + 2)])
        rows.append((event_id, "n", "t", start, end, zone, zone))
    return rows


def near_borders(events, trips):
    """Trips that end or start exactly on, or one microsecond off, a window border."""
    tick = dt.timedelta(microseconds=1)
    extra = []
    for _, _, _, start, end, zone, _ in events:
        for t in (start - HALF, start, end, end + HALF):
            for d in (-tick, tick * 0, tick):
                extra.append((t + d, t + d, zone, zone, 1))
    return trips + extra


def brute_actual(events, trips):
    out = {}
    for event_id, _, _, start, end, zone, _ in events:
        key = event_id, zone
        i, o = out.get(key, (0, 0))
        i += sum(w for p, d, a, b, w in trips if b == zone and start - HALF <= d < start)
        o += sum(w for p, d, a, b, w in trips if a == zone and end <= p < end + HALF)
        out[key] = i, o
    return out


def mode_frames(spark, trips):
    taxi = spark.createDataFrame(trips, TRIPS)
    subway = taxi.select(
        F.col("dropoff_ts").alias("transit_timestamp"), F.col("start_location_id").alias("origin_location_id"),
        F.col("end_location_id").alias("destination_location_id"),
        (F.col("passenger_count") / 2).alias("estimated_average_ridership"))
    bikes = taxi.select(F.col("pickup_ts").alias("started_at"), F.col("dropoff_ts").alias("ended_at"),
                        "start_location_id", "end_location_id", F.lit(1).alias("passenger_count"))
    return taxi, subway, bikes


@pytest.mark.parametrize("subsecond", [False, True])
def test_event_actual(spark, subsecond):
    events = make_events(1, subsecond=subsecond)
    trips = near_borders(events, make_trips(2, subsecond=True))
    frame = spark.createDataFrame(events, EVENTS)
    taxi, subway, bikes = mode_frames(spark, trips)
    got = impact.event_actual(frame, taxi, subway, bikes)
    expected = brute_actual(events, trips)
    assert {(r.event_id, r.zone_id): (r.taxi_inbound_pre, r.taxi_outbound_post) for r in got.collect()} == expected
    rides = [(p, d, a, b, 1) for p, d, a, b, _ in trips]
    expected = brute_actual(events, rides)
    assert {(r.event_id, r.zone_id): (r.citibike_inbound_pre, r.citibike_outbound_post)
            for r in got.collect()} == expected
    hourly = [(d, d, a, b, w / 2) for p, d, a, b, w in trips]
    expected = brute_actual(events, hourly)
    assert {(r.event_id, r.zone_id): (r.subway_inbound_pre, r.subway_outbound_post)
            for r in got.collect()} == expected


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), 1e17])
def test_nothing_outside_a_window_touches_its_sum(spark, odd):
    """The odd weight lies in the same zone and hour, before the window."""
    day = dt.datetime(2024, 5, 1)
    events = [(1, "n", "t", day.replace(hour=11), day.replace(hour=12), 4, 4)]
    rides = [(day.replace(hour=9, minute=10), 9, 4, odd), (day.replace(hour=10), 9, 4, 5.0), (day.replace(hour=10, microsecond=500_000), 9, 4, 0.25)]
    subway = spark.createDataFrame(rides, "transit_timestamp timestamp_ntz, origin_location_id int, destination_location_id int, estimated_average_ridership double")
    frame = spark.createDataFrame(events, EVENTS)
    assert impact.sampled_impact(frame, subway, SUBWAY).first().subway_inbound_pre == 5.25


def clock(t):
    return t.hour * 3600 + t.minute * 60 + t.second


def in_clock(t, lo, hi):
    c, a, b = clock(t), clock(lo), clock(hi)
    return (c >= a or c <= b) if b < a else a <= c <= b


def brute_daily(events, trips, one_time=False):
    excluded = {(e[5], t.date()) for e in events for t in (e[3], e[4])}
    out = {}
    for event_id, _, _, start, end, zone, _ in events:
        for p, d, a, b, w in trips:
            if zone not in (a, b) or (zone, d.date()) in excluded or (not one_time and (zone, p.date()) in excluded):
                continue
            key = event_id, d.date()
            i, o = out.get(key, (0, 0))
            i += w if in_clock(d, start - HALF, start) else 0
            o += w if in_clock(p, end, end + HALF) else 0
            out[key] = i, o
    return out


def on_clock_borders(events, trips):
    """Trips on another day at the very seconds where time-of-day windows begin and end."""
    day, extra = dt.date(2024, 1, 6), []
    for _, _, _, start, end, zone, _ in events:
        for t in (start - HALF, start, end, end + HALF):
            for s in (-1, 0, 1):
                at = dt.datetime.combine(day, (t + dt.timedelta(seconds=s)).time())
                extra.append((at, at, zone, zone, 1))
    return trips + extra


@pytest.mark.parametrize("mode", [TAXI, SUBWAY, CITIBIKE], ids=lambda m: m.name)
def test_daily_baseline_and_average(spark, mode):
    # repeated event ids, some of them in several zones
    events = make_events(3)
    trips = on_clock_borders(events, make_trips(4))
    frame = spark.createDataFrame(events, EVENTS)
    tables = dict(zip((TAXI, SUBWAY, CITIBIKE), mode_frames(spark, trips), strict=True))
    seen = {TAXI: trips, SUBWAY: [(d, d, a, b, w / 2) for p, d, a, b, w in trips],
            CITIBIKE: [(p, d, a, b, 1) for p, d, a, b, w in trips]}[mode]
    expected = brute_daily(events, seen, one_time=mode is SUBWAY)
    got = impact.daily_baseline(frame, tables[mode], mode).collect()
    assert {(r.event_id, r.baseline_date): (r.baseline_inbound, r.baseline_outbound) for r in got} == expected

    per_event = {}
    for (event_id, _), pair in expected.items():
        per_event.setdefault(event_id, []).append(pair)
    average = impact.baseline_average(frame, {mode: tables[mode]}).collect()
    assert {r.event_id for r in average} == set(per_event)
    for r in average:
        days = per_event[r.event_id]
        for i, side in enumerate(("inbound", "outbound")):
            assert r[f"baseline_{mode.name}_{side}"] == pytest.approx(sum(d[i] for d in days) / len(days))


def test_wrapped_window_borders(spark):
    """An event at 00:30 has the closed window 23:00 to 00:30."""
    event = (1, "n", "t", dt.datetime(2024, 1, 3, 0, 30), dt.datetime(2024, 1, 3, 5, 0), 1, 1)
    day = dt.datetime(2024, 1, 10)
    times = {(23, 0, 0): 1, (0, 30, 0): 2, (0, 30, 1): 4, (22, 59, 59): 8}
    trips = [(day.replace(hour=h, minute=m, second=s), day.replace(hour=h, minute=m, second=s), None, 1, w)
             for (h, m, s), w in times.items()]
    got = impact.daily_baseline(spark.createDataFrame([event], EVENTS), spark.createDataFrame(trips, TRIPS), TAXI)
    assert [r.baseline_inbound for r in got.collect()] == [3]


def test_sampled_impact(spark):
    events = make_events(5, repeat=False)
    trips = make_trips(6, subsecond=True)
    trips += [(dt.datetime(2023, 12, 31, 23), dt.datetime(2023, 12, 31, 23), 1, 1, 100)]
    got = impact.sampled_impact(spark.createDataFrame(events, EVENTS), spark.createDataFrame(trips, TRIPS), TAXI)
    rows = {r.event_id: r for r in got.collect()}
    assert len(rows) == len(events)
    in_year = [t for t in trips if t[1].year == 2024]

    def total(zone, lo, side):
        return sum(t[4] for t in in_year if t[2 + side] == zone and lo <= t[side] < lo + HALF)

    for event_id, _, _, start, end, zone, _ in events:
        r, day = rows[event_id], dt.timedelta(days=1)
        assert r.taxi_inbound_pre == total(zone, start - HALF, 1)
        assert r.taxi_outbound_post == total(zone, end, 0)
        before = sum(total(zone, start - HALF - k * day, 1) for k in (1, 2, 3)) / 3
        after = sum(total(zone, end + k * day, 0) for k in (1, 2, 3)) / 3
        assert r.avg_taxi_inbound_baseline == pytest.approx(before)
        assert r.avg_taxi_outbound_baseline == pytest.approx(after)


def test_hot_zone_hour(spark):
    """One zone and hour holds nearly all movements and events; the sums stay exact."""
    start = dt.datetime(2024, 1, 3, 12)
    moves = spark.range(200_000).select(
        F.lit("in").alias("direction"), F.lit(1).alias("zone_id"),
        (F.lit(start).cast("timestamp_ntz") - F.make_dt_interval(secs=(F.col("id") % 7200).cast("decimal(18,6)"))).alias("t"),
        F.lit(1).cast("bigint").alias("taxi"))
    spans = spark.range(50_000).select(
        F.lit("in").alias("direction"), F.lit(1).alias("zone_id"),
        F.lit(start - HALF).cast("timestamp_ntz").alias("t_lo"), F.lit(start).cast("timestamp_ntz").alias("t_hi"))
    out = windows.timeline_sums(moves, spans, ["taxi"]).collect()
    expected = sum(1 for i in range(200_000) if 1 <= i % 7200 <= 5400)
    assert [r.taxi for r in out] == [expected]


def test_ratio_and_order(spark):
    events = make_events(7, repeat=False)
    trips = make_trips(8)
    got = impact.event_impact(spark.createDataFrame(events, EVENTS), *mode_frames(spark, trips)).collect()
    assert [r.event_id for r in got] == sorted(e[0] for e in events)
    for r in got:
        base = r.baseline_taxi_inbound
        expected = None if not base else round(r.taxi_inbound_pre / base, 2)
        assert r.taxi_inbound_ratio == (expected if expected is None else pytest.approx(expected, abs=0.011))


# Published results of the twelve sampled events per mode, in the published order, and totals of three of them.
SAMPLED = {
    "taxi": [
        (793006, 85, 97, 74.7, 149.3),
        (751172, 219, 246, 254.7, 343.3),
        (751570, 62, 102, 61.7, 136.0),
        (793055, 73, 116, 86.3, 100.0),
        (806389, 219, 356, 166.0, 379.0),
        (810977, 6, 16, 5.7, 8.7),
        (761847, 38, 28, 39.3, 42.0),
        (776844, 31, 22, 27.7, 36.3),
        (797622, 240, 184, 238.3, 350.0),
        (757989, 508, 419, 384.7, 459.3),
        (810920, 156, 112, 140.7, 119.7),
        (751766, 11, 7, 3.0, 6.0),
    ],
    "subway": [
        (751172, 3419.8761000000013, 3139.4060999999965, 3913.6129333333333, 2699.329733333333),
        (793006, 0.0, 0.0, 0.0, 0.0),
        (810920, 562.9011999999999, 1672.0225999999996, 529.4570666666667, 1641.5806),
        (757989, 2976.473200000001, 7409.896199999993, 2573.4710333333333, 6315.285833333338),
        (797622, 2844.3942, 4141.800000000005, 2637.5544000000004, 3622.3161333333323),
        (751766, 0.0, 0.0, 0.0, 0.0),
        (761847, 2441.1860000000015, 2907.452199999999, 2399.8849999999993, 2506.6378000000004),
        (776844, 0.0, 0.0, 0.0, 0.0),
        (806389, 5401.621400000002, 4998.520400000004, 5809.8997999999965, 5925.352399999999),
        (810977, 0.0, 0.0, 0.0, 0.0),
        (793055, 0.0, 0.0, 0.0, 0.0),
        (751570, 0.0, 0.0, 0.0, 0.0),
    ],
    "citibike": [
        (761847, 0, 5, 2.0, 6.0),
        (776844, 6, 0, 1.7, 1.7),
        (806389, 301, 281, 322.0, 518.7),
        (810977, 3, 4, 4.7, 5.0),
        (751570, 15, 23, 13.7, 31.0),
        (793055, 0, 0, 0.0, 0.0),
        (751172, 381, 214, 311.3, 183.0),
        (793006, 34, 14, 52.7, 25.3),
        (751766, 13, 14, 9.7, 25.0),
        (797622, 133, 49, 233.7, 259.0),
        (757989, 70, 137, 182.7, 509.3),
        (810920, 0, 0, 0.0, 0.0),
    ],
}
SUMMARY = {
    751172: (4019.8761, 3599.4061, 4479.6129, 3225.6297, -459.7368, 373.7764),
    757989: (3554.4732, 7965.8962, 3140.871, 7283.8858, 413.6022, 682.0104),
    793006: (119.0, 111.0, 127.4, 174.6, -8.4, -63.6),
}


def test_event_transit_summary_of_published_values(spark):
    frames = []
    for name, rows in SAMPLED.items():
        kind = "double" if name == "subway" else "bigint"
        schema = (f"event_id int, {name}_inbound_pre {kind}, {name}_outbound_post {kind}, "
                  f"avg_{name}_inbound_baseline double, avg_{name}_outbound_baseline double")
        frames.append(spark.createDataFrame(rows, schema).withColumns({
            "event_name": F.lit("n"), "event_type": F.lit("t"), "zone_id": F.lit(43),
            "start_time": F.lit(None).cast("timestamp_ntz"), "end_time": F.lit(None).cast("timestamp_ntz")}))
    out = impact.event_transit_summary(*frames).collect()
    assert [r.event_id for r in out] == sorted(r[0] for r in SAMPLED["taxi"])
    assert (len(out), out[0].event_id, out[-1].event_id) == (12, 751172, 810977)
    per_mode = {name: {r[0]: r[1:] for r in rows} for name, rows in SAMPLED.items()}
    for r in out:
        summed = [sum(rows[r.event_id][i] for rows in per_mode.values()) for i in range(4)]
        got = (r.total_inbound_pre, r.total_outbound_post, r.avg_total_inbound_baseline,
               r.avg_total_outbound_baseline, r.total_inbound_delta, r.total_outbound_delta)
        assert got == pytest.approx((*summed, summed[0] - summed[2], summed[1] - summed[3]))
        if r.event_id in SUMMARY:
            assert [round(x, 4) for x in got] == list(SUMMARY[r.event_id])
    missing = impact.event_transit_summary(frames[0], frames[1].limit(0), frames[2].limit(0)).collect()
    assert {r.event_id: r.total_inbound_pre for r in missing} == {r[0]: float(r[1]) for r in SAMPLED["taxi"]}


def test_results_do_not_depend_on_the_session_time_zone(spark):
    # 02:30 does not exist in New York on this day
    events = [(1, "n", "t", dt.datetime(2024, 3, 10, 3, 0), dt.datetime(2024, 3, 10, 4, 0), 1, 1)]
    trips = [(dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 30), 1, 1, 5),
             (dt.datetime(2024, 3, 12, 2, 30), dt.datetime(2024, 3, 12, 2, 30), 1, 1, 7)]
    results = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        frame = spark.createDataFrame(events, EVENTS)
        taxi, subway, bikes = mode_frames(spark, trips)
        results.append((impact.event_impact(frame, taxi, subway, bikes).collect(),
                        impact.sampled_impact(frame, taxi, TAXI).collect()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1]
    assert results[0][0][0].taxi_inbound_pre == 5


def test_volume_is_in_plus_out(spark, sf_dir):
    v = Views(spark, sf_dir)
    trips = v["taxi_rides"]
    both = trips.agg(F.sum("passenger_count")).first()[0] * 2
    assert volume.zone_volume(trips, TAXI).agg(F.sum("taxi_passengers")).first()[0] == both
    slots = subway_temporal_profile(v["subway_rides"])
    assert slots.filter("population_in < 0 OR population_out < 0").isEmpty()


def test_seeded_sample_is_a_subset(spark, sf_dir):
    v = Views(spark, sf_dir)
    pool = impact.events_on_mid_dates(v["permits"], v["subway_rides"])
    picked = impact.sample_midweek_events(v["permits"], v["subway_rides"], n=5, salt="3")
    assert picked.count() == 5
    assert picked.join(pool, "event_id", "left_anti").isEmpty()
