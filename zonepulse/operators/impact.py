"""How permitted events change traffic: windows, actual traffic, baselines, ratios and deltas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.plan import spread
from zonepulse.functions.timeparts import DAY_SECONDS, days, epoch_day, hours, minutes, second_of_day
from zonepulse.operators.windows import (
    all_movements,
    equal_window_sums,
    tasks_for,
    timed_window_sums,
    weight_columns,
)
from zonepulse.schemas import CITIBIKE, SUBWAY, TAXI, Mode
from zonepulse.sources.scratch import is_small, materialize

WINDOW_MINUTES = 90
EVENT_KEYS = ["event_id", "event_name", "event_type", "zone_id"]


def event_windows(events: DataFrame) -> DataFrame:
    """Events with zone, and the 90 minutes before the start and after the end."""
    return events.select(
        "event_id", "event_name", "event_type", F.col("start_location_id").alias("zone_id"),
        "start_time", "end_time",
        (F.col("start_time") - minutes(WINDOW_MINUTES)).alias("pre_start_time"),
        (F.col("end_time") + minutes(WINDOW_MINUTES)).alias("post_end_time"),
    )


def _spread_windows(windows: DataFrame, baseline_days: int) -> DataFrame:
    """One row per event, direction and day offset k: arrivals k days before, departures k days after."""
    rows = []
    for k in range(baseline_days + 1):
        rows.append([F.lit("in"), F.lit(k), F.col("pre_start_time") - days(k), F.col("start_time") - days(k)])
        rows.append([F.lit("out"), F.lit(k), F.col("end_time") + days(k), F.col("post_end_time") + days(k)])
    return windows.select("*", spread(["direction", "k", "t_lo", "t_hi"], *rows))


def _window_totals(
    windows: DataFrame, tables: dict[Mode, DataFrame], weights: dict[str, Column], longest_trip_days: int | None = None
) -> DataFrame:
    """Rows of ``windows`` with the weights of each mode, and one row more per window without any.

    All modes go through one pass; each table is scanned once, within the time that the windows span.
    """
    windows = materialize(windows, "windows")
    tables = within(tables, windows, longest_trip_days)
    names = [m.name for m in tables]
    sums = timed_window_sums(all_movements(tables, weights), windows, names, WINDOW_MINUTES)
    return sums.unionByName(windows, allowMissingColumns=True)


def within(tables: dict[Mode, DataFrame], windows: DataFrame, longest_trip_days: int | None = None) -> dict[Mode, DataFrame]:
    """The trips that may lie in a window, by bounds on their times that the scan can use.

    Year and month of a partitioned table are joined with those of the windows, which prunes its folders. A table with two
    times is partitioned by the departure; its folders are pruned if ``longest_trip_days`` says how
    long before its arrival a trip may have begun.
    """
    bounds = windows.groupBy("direction").agg(F.min("t_lo").alias("lo"), F.max("t_hi").alias("hi")).collect()  # two rows
    spans = {r.direction: (r.lo, r.hi) for r in bounds if r.lo is not None}
    out = {}
    for mode, trips in tables.items():
        near = F.lit(False)
        for way, (lo, hi) in spans.items():
            t = F.col(mode.end_time if way == "in" else mode.start_time)
            near = near | ((t >= F.lit(str(lo)).cast("timestamp_ntz")) & (t < F.lit(str(hi)).cast("timestamp_ntz")))
        out[mode] = trips.filter(near)
        one_time = mode.start_time == mode.end_time == mode.day_time
        if {"year", "month"} <= set(trips.columns) and (one_time or longest_trip_days is not None):
            months = _months(windows, 0 if one_time else longest_trip_days)
            out[mode] = out[mode].join(F.broadcast(months), ["year", "month"], "left_semi")  # bounded by the calendar
    return out


def _months(windows: DataFrame, days_before: int) -> DataFrame:
    """(year, month) of all windows, and of the days before them."""
    first, last = F.to_date(F.col("t_lo") - days(days_before)), F.to_date("t_hi")
    each = windows.dropna(subset=["t_lo"]).select(F.explode(F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL '1' MONTH"))).alias("d"))
    months = materialize(each.select(F.year("d").alias("year"), F.month("d").alias("month")).distinct(), "months")
    return months.filter(F.col("month").between(1, 12))  # a condition, so that Spark takes it for a list to prune by


def _sum_of(column: str, direction: str, k: Column, kind: str) -> Column:
    picked = F.when((F.col("direction") == direction) & k, F.col(column))
    return F.coalesce(F.sum(picked), F.lit(0)).cast(kind)


def event_actual(
    events: DataFrame, taxi: DataFrame, subway: DataFrame, citibike: DataFrame
) -> DataFrame:
    """Arrivals before the start and departures after the end, per event and mode; 0 without traffic.

    Modes are summed on their own, so the rows of one mode do not multiply those of another.
    """
    tables = {TAXI: taxi, SUBWAY: subway, CITIBIKE: citibike}
    totals = _window_totals(_spread_windows(event_windows(events), 0), tables, {})
    every = F.lit(True)
    out = []
    for m in tables:
        out += [
            _sum_of(m.name, "in", every, m.weight_type).alias(f"{m.name}_inbound_pre"),
            _sum_of(m.name, "out", every, m.weight_type).alias(f"{m.name}_outbound_post"),
        ]
    return totals.groupBy(*EVENT_KEYS).agg(*out)


def event_exclude_dates(events: DataFrame) -> DataFrame:
    """Distinct (zone, date) on which an event starts or ends: at most zones x calendar days rows."""
    dates = F.array(F.to_date("start_time"), F.to_date("end_time"))
    return events.select(
        F.col("start_location_id").alias("zone_id"), F.explode(dates).alias("exclude_date")
    ).distinct()


# -- baseline by time of day


def _zones_and_dates(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The event zones and their excluded dates, with broadcast hints when a count shows they are small."""
    excluded = event_exclude_dates(events).filter(F.col("zone_id").isNotNull())
    zones = events.select(F.col("start_location_id").alias("zone_id")).dropna().distinct()
    return (F.broadcast(zones), F.broadcast(excluded)) if is_small(excluded) else (zones, excluded)


def _eligible_trips(trips: DataFrame, mode: Mode, zones_with_events: DataFrame, excluded: DataFrame) -> DataFrame:
    """(zone, trip) pairs of the event zones on dates without events: zone_id, baseline_date, times, weight.

    A trip belongs to its start and its end zone, once when they are the same. With broadcast inputs all
    of this happens in the scan stage.
    """
    zones = F.array_distinct(F.array(F.col(mode.start_zone).cast("int"), F.col(mode.end_zone).cast("int")))
    pairs = trips.select(
        F.explode(zones).alias("zone_id"),
        F.col(mode.end_time).alias("in_t"), F.col(mode.start_time).alias("out_t"),
        F.col(mode.weight).cast(mode.weight_type).alias("w"),
        F.col(mode.end_zone).alias("in_zone"), F.col(mode.start_zone).alias("out_zone"),
    ).join(zones_with_events, "zone_id", "left_semi")
    pairs = pairs.withColumns({"baseline_date": F.to_date("in_t"), "out_date": F.to_date("out_t")})
    by_arrival = excluded.withColumnRenamed("exclude_date", "baseline_date")
    pairs = pairs.join(by_arrival, ["zone_id", "baseline_date"], "left_anti")
    if mode.start_time != mode.end_time:
        by_departure = excluded.withColumnRenamed("exclude_date", "out_date")
        pairs = pairs.join(by_departure, ["zone_id", "out_date"], "left_anti")
    return pairs


def _clock_ticks(pairs: DataFrame, directional: bool, *extra: Column | str, with_days: bool = False) -> DataFrame:
    """Arrivals and departures by second of the day. Undirected: every pair counts both ways.

    ``with_days`` adds one more row per pair, direction 'day', whose position is the baseline date.
    """
    ways = ["in", "out"]
    rows = [[F.lit(d), second_of_day(F.col(f"{d}_t"))] for d in ways]
    own = [F.col(f"{d}_zone") == F.col("zone_id") if directional else None for d in ways]
    if with_days:
        rows.append([F.lit("day"), epoch_day(F.col("baseline_date"))])
        own.append(None)
    kept = spread(["direction", "pos"], *rows, when=own if directional else None)
    return pairs.select("zone_id", *extra, kept)


_CLOCK_SECONDS = WINDOW_MINUTES * 60 + 1


def _clock_windows(events: DataFrame) -> DataFrame:
    """Pre and post window of each event as seconds of the day; closed, _CLOCK_SECONDS long, and may run past midnight."""
    w = event_windows(events).filter(F.col("zone_id").isNotNull())
    pre, post = second_of_day(F.col("pre_start_time")), second_of_day(F.col("end_time"))
    return w.select("event_id", "zone_id", spread(["direction", "lo"], [F.lit("in"), pre], [F.lit("out"), post]))


def daily_baseline(events: DataFrame, trips: DataFrame, mode: Mode, directional: bool = False) -> DataFrame:
    """Per event and date: weight inside the event's time-of-day windows on days without events.

    Dates are those of arrival on which some eligible trip touches the event's zone. The result has one
    row per event and day by nature; ``baseline_average`` gets to the averages without it.

    Sums are taken once for each distinct window and put together once for each distinct set of windows of an event id. The
    days of a window or a set travel as one array and become rows in the last step, which neither sorts nor groups them.
    What does group them is dealt over as many tasks as there are rows, so a task's memory does not grow with the events.
    """
    pairs = _eligible_trips(trips, mode, *_zones_and_dates(events))
    ticks = _clock_ticks(pairs, directional, "baseline_date", "w", with_days=True)
    clock = materialize(ticks.groupBy("zone_id", "direction", "baseline_date", "pos").agg(F.sum("w").alias("w")), "clock")
    dates = clock.filter(F.col("direction") == "day").select("zone_id", "baseline_date")
    longest = dates.groupBy("zone_id").count().agg(F.max("count")).first()[0] or 0
    sets = materialize(_window_sets(events), "sets")
    wanted = materialize(_set_windows(sets), "wanted")
    days_of = materialize(_window_days(clock.filter(F.col("direction") != "day"), dates, wanted, longest), "window-days")
    set_days = materialize(_set_days(wanted, days_of, wanted.count() * longest, mode), "set-days")
    return sets.join(set_days, "windows").select("event_id", F.inline("days"))


def _window_sets(events: DataFrame) -> DataFrame:
    """(event_id, windows): the distinct windows of an event id's rows with zone, sorted, with how many rows have each."""
    w = event_windows(events).filter(F.col("zone_id").isNotNull())
    pre, post = second_of_day(F.col("pre_start_time")).alias("pre"), second_of_day(F.col("end_time")).alias("post")
    each = w.select("event_id", "zone_id", pre, post).groupBy("event_id", "zone_id", "pre", "post").agg(F.count("*").alias("n"))
    return each.groupBy("event_id").agg(F.sort_array(F.collect_list(F.struct("zone_id", "pre", "post", "n"))).alias("windows"))


def _set_windows(sets: DataFrame) -> DataFrame:
    """One row per distinct set and window of it: direction 'in' or 'out' from second ``lo`` on, or 'day' for the dates of the zone."""
    each = sets.select("windows").distinct().select("windows", F.inline("windows"))
    rows = [[F.lit("day"), F.lit(0).cast("bigint")], [F.lit("in"), F.col("pre")], [F.lit("out"), F.col("post")]]
    return each.select("windows", "zone_id", "n", spread(["direction", "lo"], *rows, when=[None, F.col("pre").isNotNull(), F.col("post").isNotNull()]))


_WINDOW = ["zone_id", "direction", "lo"]


def _window_days(ticks: DataFrame, dates: DataFrame, wanted: DataFrame, longest: int) -> DataFrame:
    """(zone_id, direction, lo, days): date and weight of each distinct window; direction 'day' has the dates of the zone, without weights."""
    windows = materialize(wanted.filter(F.col("direction") != "day").select(*_WINDOW).distinct(), "windows")
    parts = tasks_for(windows.count() * longest + 4 * ticks.count())  # a tick is two running sums, of a cell or two each
    sums = equal_window_sums(ticks, windows, ["zone_id", "direction"], ["w"], _CLOCK_SECONDS, DAY_SECONDS, ["baseline_date"], parts == 1, parts)
    daily = sums.repartition(parts, *_WINDOW).groupBy(*_WINDOW, "baseline_date").agg(F.sum("w").alias("w"))
    seen = dates.select("zone_id", F.lit("day").alias("direction"), F.lit(0).cast("bigint").alias("lo"), "baseline_date", F.lit(None).cast(daily.schema["w"].dataType).alias("w"))
    day = F.collect_list(F.struct("baseline_date", "w")).alias("days")
    return daily.groupBy(*_WINDOW).agg(day).unionByName(seen.groupBy(*_WINDOW).agg(day))


def _set_days(wanted: DataFrame, days_of: DataFrame, rows: int, mode: Mode) -> DataFrame:
    """(windows, days): date and both baselines of each distinct set of windows; ``rows`` bounds the windows times their days."""
    parts = tasks_for(rows)
    if parts == 1:
        met = wanted.join(F.broadcast(days_of), _WINDOW)
    else:  # the same number on both sides: a task meets as many days as it passes on
        met = wanted.repartition(parts, *_WINDOW).join(days_of.repartition(parts, *_WINDOW), _WINDOW)
    dealt = met.select("windows", "direction", "n", "days").repartition(parts, "windows")
    each = dealt.select("windows", "direction", "n", F.inline("days")).withColumn("w", F.col("w") * F.col("n"))
    daily = each.groupBy("windows", "baseline_date").agg(
        *[_sum_of("w", d, F.lit(True), mode.weight_type).alias(f"baseline_{name}")
          for d, name in (("in", "inbound"), ("out", "outbound"))]
    )
    return daily.groupBy("windows").agg(F.collect_list(F.struct("baseline_date", "baseline_inbound", "baseline_outbound")).alias("days"))


def _days_per_event(events: DataFrame, zone_dates: DataFrame, names: list[str]) -> DataFrame:
    """Number of distinct baseline dates per event and mode, over all zones of the event id.

    Events are reduced to their distinct zone sets first: nearly always single zones, so the date
    count is done once per zone rather than once per event.
    """
    sets = events.filter(F.col("start_location_id").isNotNull()).groupBy("event_id").agg(
        F.sort_array(F.collect_set("start_location_id")).alias("zone_set"))
    set_dates = sets.select("zone_set").distinct().withColumn("zone_id", F.explode("zone_set")).join(
        zone_dates, "zone_id").groupBy("zone_set", "pos").agg(*[F.max(f"{n}_seen").alias(f"{n}_seen") for n in names])
    per_set = set_dates.groupBy("zone_set").agg(*[F.count_if(f"{n}_seen").alias(f"{n}_days") for n in names])
    return sets.join(per_set, "zone_set").drop("zone_set")


def baseline_average(
    events: DataFrame, tables: dict[Mode, DataFrame], directional: bool = False
) -> DataFrame:
    """Mean of the daily baselines per event and mode, without building the daily rows.

    A mean of daily sums is the total over all eligible days divided by their number, so trips are
    reduced to at most 86,400 positions and one row per date for each zone before they meet the events.
    Each trip table is scanned once; that reduced table is what both the sums and the day counts read.
    A mode without an eligible day for the event gives null.
    """
    names = [m.name for m in tables]
    inputs = _zones_and_dates(events)
    windows = _clock_windows(events)
    keys = ["zone_id", "direction"]
    ticks = []
    for mode, trips in tables.items():
        seen = [F.lit(True if n == mode.name else None).cast("boolean").alias(f"{n}_seen") for n in names]
        extra = [*weight_columns(mode, F.col("w"), names), *seen]
        ticks.append(_clock_ticks(_eligible_trips(trips, mode, *inputs), directional, *extra, with_days=True))
    clock = materialize(
        reduce(DataFrame.unionByName, ticks).groupBy(*keys, "pos").agg(
            *[F.sum(n).alias(n) for n in names], *[F.max(f"{n}_seen").alias(f"{n}_seen") for n in names]),
        "clock",
    )
    is_day = F.col("direction") == "day"
    sums = equal_window_sums(clock.filter(~is_day), windows, keys, names, _CLOCK_SECONDS, DAY_SECONDS, small=is_small(windows))
    totals = sums.groupBy("event_id").agg(
        *[F.sum(F.when(F.col("direction") == d, F.col(n))).alias(f"{n}_{d}") for n in names for d in ("in", "out")]
    )
    counts = _days_per_event(events, clock.filter(is_day), names)
    mean = [
        F.try_divide(F.coalesce(F.col(f"{n}_{d}"), F.lit(0)).cast("double"), F.col(f"{n}_days")).alias(f"baseline_{n}_{name}")
        for n in names for d, name in (("in", "inbound"), ("out", "outbound"))
    ]
    return counts.join(totals, "event_id", "left").select("event_id", *mean)


def event_impact(
    events: DataFrame,
    taxi: DataFrame,
    subway: DataFrame,
    citibike: DataFrame,
    directional: bool = False,
) -> DataFrame:
    """Actual traffic next to its baseline and their ratio, per event; ordered by event id."""
    tables = {TAXI: taxi, SUBWAY: subway, CITIBIKE: citibike}
    actual = event_actual(events, taxi, subway, citibike)
    joined = actual.join(baseline_average(events, tables, directional), "event_id", "left")
    ratios = []
    for m in tables:
        for side, when in (("inbound", "pre"), ("outbound", "post")):
            base = F.nullif(F.col(f"baseline_{m.name}_{side}"), F.lit(0.0))
            ratios.append(F.round(F.col(f"{m.name}_{side}_{when}").cast("double") / base, 2)
                          .alias(f"{m.name}_{side}_ratio"))
    return joined.select("*", *ratios).orderBy("event_id")


# -- sampled analysis


def mid_sample_dates(subway: DataFrame, year: int) -> DataFrame:
    """Per month of the year: the first date with subway data plus three days."""
    t = F.col("transit_timestamp")
    in_year = subway.filter((t >= _year_start(year)) & (t < _year_start(year + 1)))
    first = in_year.groupBy(F.year(t).alias("y"), F.month(t).alias("m")).agg(F.min(F.to_date(t)).alias("first_date"))
    return first.select(F.date_add("first_date", 3).alias("mid_sample_date"))


def _year_start(year: int) -> Column:
    return F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")


def events_on_mid_dates(events: DataFrame, subway: DataFrame, year: int = 2024, max_hours: int = 5) -> DataFrame:
    """Events that start on a sampled date and last at most ``max_hours`` whole hours."""
    mid = mid_sample_dates(subway, year)  # at most twelve rows
    start = F.col("start_time")
    dated = events.filter((start >= _year_start(year)) & (start < _year_start(year + 1))).filter(
        F.col("end_time") < start + hours(max_hours + 1))
    return dated.withColumn("mid_sample_date", F.to_date(start)).join(
        F.broadcast(mid), "mid_sample_date", "left_semi"
    ).select("event_id", "event_name", "event_type", "start_location_id", "end_location_id", "start_time", "end_time")


def sample_midweek_events(
    events: DataFrame, subway: DataFrame, n: int = 12, salt: str = "mobility", year: int = 2024, max_hours: int = 5,
) -> DataFrame:
    """``n`` of the mid-week events at random: those with the least hash of ``salt`` and event id.

    The pick is the same on every run, engine and use; another ``salt`` gives another sample.
    """
    pool = events_on_mid_dates(events, subway, year, max_hours)
    ticket = F.md5(F.concat(F.lit(salt), F.col("event_id").cast("string")).cast("binary"))
    return pool.orderBy(ticket, "event_id", "start_time").limit(n)


_COUNTED = {"citibike"}


def sampled_impacts(
    events: DataFrame, tables: dict[Mode, DataFrame], baseline_days: int = 3, year: int | None = 2024, longest_trip_days: int | None = None,
) -> DataFrame:
    """Actual traffic and the mean of the same windows on the days before (arrivals) or after (departures), all modes in one pass.

    Taxi sums passengers, subway sums ridership, bikes count rides. See ``within`` for ``longest_trip_days``.
    """
    kept = {}
    for mode, trips in tables.items():
        if year is not None:
            t = F.col(mode.period_time)
            trips = trips.filter((t >= _year_start(year)) & (t < _year_start(year + 1)))
            if mode.period_time == mode.day_time and "year" in trips.columns:
                trips = trips.filter(F.col("year") == year)
        kept[mode] = trips
    totals = _window_totals(_spread_windows(event_windows(events), baseline_days), kept, {n: F.lit(1) for n in _COUNTED}, longest_trip_days)
    actual, before = F.col("k") == 0, F.col("k") > 0
    out = []
    for m in tables:
        n, kind = m.name, m.weight_type
        out += [_sum_of(n, "in", actual, kind).alias(f"{n}_inbound_pre"), _sum_of(n, "out", actual, kind).alias(f"{n}_outbound_post")]
        out += [(_sum_of(n, d, before, kind).cast("double") / float(baseline_days)).alias(f"avg_{n}_{side}_baseline")
                for d, side in (("in", "inbound"), ("out", "outbound"))]
    return totals.groupBy(*EVENT_KEYS, "start_time", "end_time").agg(*out)


def sampled_impact(
    events: DataFrame, trips: DataFrame, mode: Mode, baseline_days: int = 3, year: int | None = 2024, longest_trip_days: int | None = None,
) -> DataFrame:
    """``sampled_impacts`` of one mode."""
    return sampled_impacts(events, {mode: trips}, baseline_days, year, longest_trip_days)


def _measures(name: str) -> list[str]:
    return [f"{name}_inbound_pre", f"{name}_outbound_post", f"avg_{name}_inbound_baseline", f"avg_{name}_outbound_baseline"]


_SUMMED = [TAXI.name, SUBWAY.name, CITIBIKE.name]


def event_transit_summary(taxi: DataFrame, subway: DataFrame, citibike: DataFrame) -> DataFrame:
    """The three sampled results side by side with totals and deltas, ordered by event id."""
    joined = taxi
    for name, other in (("subway", subway), ("citibike", citibike)):
        joined = joined.join(other.select("event_id", *_measures(name)), "event_id", "left")
    return summarize(joined)


def summarize(sampled: DataFrame) -> DataFrame:
    """Totals over the modes and deltas of ``sampled_impacts``, ordered by event id; a missing measure counts as 0."""
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for name in _SUMMED for c in _measures(name)}

    def over_modes(i: int) -> Column:
        return reduce(Column.__add__, [filled[_measures(name)[i]] for name in _SUMMED])

    return sampled.select(
        *EVENT_KEYS, "start_time", "end_time",
        *[c.alias(n) for n, c in filled.items()],
        over_modes(0).alias("total_inbound_pre"),
        over_modes(1).alias("total_outbound_post"),
        over_modes(2).alias("avg_total_inbound_baseline"),
        over_modes(3).alias("avg_total_outbound_baseline"),
        (over_modes(0) - over_modes(2)).alias("total_inbound_delta"),
        (over_modes(1) - over_modes(3)).alias("total_outbound_delta"),
    ).orderBy("event_id")
