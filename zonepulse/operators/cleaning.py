"""Cleaning jobs. ``screen_*`` adds a ``reject_reason`` (null = keep); ``clean_*`` filters and projects.

Every job is a narrow stage: filter and projection only, apart from the lookup joins of the event jobs.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.functions import validators as V
from zonepulse.functions.parsing import with_timestamps
from zonepulse.functions.plan import evaluate_once
from zonepulse.functions.text import is_empty, squeeze, strip_padding, unquote
from zonepulse.operators.enrich import lookup_location, match_zone_by_name
from zonepulse.sources.scratch import materialize

REASON = "reject_reason"


def _first_reason(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first check that is true."""
    (name, failed), *rest = checks
    chain = F.when(failed, name)
    for name, failed in rest:
        chain = chain.when(failed, name)
    return chain


def _kept(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


# -- taxi trips


def _trip_checks(raw: DataFrame, kind: str) -> dict[str, Column]:
    """What must hold for a valid trip: passenger count, distance and zone ids; times are not looked at.

    Columns already stored as numbers are compared as numbers, so their bounds reach the parquet scan
    as pushed filters; text goes through the text validators.
    """
    layout = S.TRIP_LAYOUTS[kind]
    checks = {}
    if layout.passengers:
        checks["PASSENGER_COUNT"] = V.whole_ok(raw, layout.passengers, *S.PASSENGERS)
    checks["TRIP_DISTANCE"] = V.number_ok(raw, layout.distance, *S.TRIP_MILES)
    checks["PU_LOCATION"] = V.zone_ok(raw, layout.pickup_zone)
    checks["DO_LOCATION"] = V.zone_ok(raw, layout.dropoff_zone)
    return checks


def screen_trips(raw: DataFrame, kind: str) -> DataFrame:
    """The trips with the first failed check of each."""
    failed = [(n, ~F.coalesce(ok, F.lit(False))) for n, ok in _trip_checks(raw, kind).items()]
    return raw.withColumn(REASON, _first_reason(failed))


def clean_trips(raw: DataFrame, kind: str, label: str | None = None) -> DataFrame:
    layout = S.TRIP_LAYOUTS[kind]
    out = [F.col(layout.pickup), F.col(layout.dropoff)]
    if layout.passengers:
        out.append(F.col(layout.passengers).cast("double").cast("int").alias(layout.passengers))
    out += [
        F.col(layout.distance).cast("double").alias(layout.distance),
        F.col(layout.pickup_zone).cast("int").alias(layout.pickup_zone),
        F.col(layout.dropoff_zone).cast("int").alias(layout.dropoff_zone),
        F.lit(label or layout.label).alias("taxi_type"),
    ]
    return raw.filter(reduce(and_, _trip_checks(raw, kind).values())).select(*out)


def clean_yellow(raw: DataFrame) -> DataFrame:
    return clean_trips(raw, "yellow")


def clean_green(raw: DataFrame) -> DataFrame:
    return clean_trips(raw, "green")


def clean_fhv(raw: DataFrame, label: str = "fhv") -> DataFrame:
    return clean_trips(raw, "fhv", label)


# -- bike rides (input: ``line`` and ``fields`` of read_delimited)


def bike_columns(lines: DataFrame) -> DataFrame:
    """The 13 ride columns as trimmed text next to ``line``; pieces a short row lacks are null."""
    named = [strip_padding(F.get("fields", F.lit(i))).alias(n) for i, n in enumerate(S.BIKE_COLUMNS)]
    return lines.select("line", F.size("fields").alias("n_fields"), *named)


def screen_bikes(lines: DataFrame) -> DataFrame:
    c = F.col
    rides = bike_columns(lines)
    points_ok = [V.valid_lat(c("start_lat")), V.valid_lat(c("end_lat")),
                 V.valid_lng(c("start_lng")), V.valid_lng(c("end_lng"))]
    checks = [
        ("TOO_FEW_COLUMNS", c("n_fields") < len(S.BIKE_COLUMNS)),
        ("MISSING_IDENTITY", reduce(or_, [is_empty(c(n)) for n in ("ride_id", "rideable_type", "member_casual")])),
        ("TIME_RANGE", ~(V.valid_time_text(c("started_at")) & V.valid_time_text(c("ended_at")))),
        ("TIME_ORDER", ~(c("ended_at") > c("started_at"))),
        ("COORDINATES", ~reduce(and_, points_ok)),
        ("STATION_NAME", is_empty(c("start_station_name")) | is_empty(c("end_station_name"))),
        ("STATION_ID", ~(V.valid_station_id(c("start_station_id")) & V.valid_station_id(c("end_station_id")))),
    ]
    return evaluate_once(rides.withColumn(REASON, _first_reason(checks)))


def clean_bikes(lines: DataFrame) -> DataFrame:
    """Valid rides; ``line`` is the input line unchanged."""
    return _kept(screen_bikes(lines)).drop("n_fields")


# -- subway origin-destination (input: read_quoted with columns f0..f15)

SUBWAY_RAW_COLUMNS = [f"f{i}" for i in range(S.SUBWAY_FIELD_COUNT)]


def screen_subway(rows: DataFrame) -> DataFrame:
    kept = {name: F.col(f"f{i}") for name, i in S.SUBWAY_FIELDS.items()}
    header = (F.lower(F.coalesce("f0", F.lit(""))) == "year") | (F.lower(F.coalesce("f4", F.lit(""))) == "timestamp")
    reason = _first_reason([
        ("TOO_FEW_COLUMNS", F.col("n_fields") < S.SUBWAY_FIELD_COUNT),
        ("HEADER_SKIPPED", header),
        ("MISSING_CRITICAL_FIELDS", reduce(or_, [V.is_missing(c) for c in kept.values()])),
    ])
    values = {**kept, "timestamp": F.replace(kept["timestamp"], F.lit("T"), F.lit(" "))}
    return evaluate_once(
        rows.select("n_fields", *[strip_padding(c).alias(n) for n, c in values.items()], reason.alias(REASON)))


def clean_subway(rows: DataFrame, ordered: bool = False) -> DataFrame:
    """The eight kept fields as trimmed text; duplicates stay. ``ordered`` sorts by all of them."""
    out = _kept(screen_subway(rows)).drop("n_fields")
    return out.orderBy(*out.columns) if ordered else out


# -- permitted events


def screen_events_strict(lines: DataFrame) -> DataFrame:
    """Exactly 12 comma pieces, one time layout, type required (input: read_delimited, no trailing pieces)."""
    c = F.col
    raw = lines.select(
        F.size("fields").alias("n_fields"),
        *[unquote(F.get("fields", F.lit(i))).alias(n) for n, i in S.EVENT_FIELDS.items()],
    )
    raw = with_timestamps(raw, {"start_ts": "start_time", "end_ts": "end_time"}, strict=True)
    required = ("event_id", "event_name", "start_time", "end_time")
    checks = [
        ("MALFORMED_ROW", c("n_fields") != S.EVENT_FIELD_COUNT),
        ("MISSING_FIELD", reduce(or_, [is_empty(c(n)) for n in required])),
        ("TIMESTAMP", c("start_ts").isNull() | c("end_ts").isNull()),
        ("TIME_ORDER", c("start_ts") > c("end_ts")),
        ("MISSING_TYPE", is_empty(c("event_type"))),
    ]
    return evaluate_once(raw.withColumn(REASON, _first_reason(checks)))


def clean_events_strict(lines: DataFrame, locations: DataFrame) -> DataFrame:
    events = _kept(screen_events_strict(lines)).select(
        "event_id", squeeze(F.col("event_name")).alias("event_name"), "start_ts", "end_ts",
        strip_padding(F.col("event_type")).alias("event_type"), "event_location",
    )
    return lookup_location(events, locations, "event_location").drop("event_location")


EVENT_RAW_COLUMNS = [f"f{i}" for i in range(S.EVENT_FIELD_COUNT)]


def screen_events_multiformat(rows: DataFrame) -> DataFrame:
    """At least four quoted-CSV fields, many time layouts, blank type allowed (input: read_quoted)."""
    c = F.col
    raw = rows.select(
        "n_fields",
        *[F.coalesce(unquote(c(f"f{i}")), F.lit("")).alias(n) for n, i in S.EVENT_FIELDS.items()],
    )
    raw = with_timestamps(raw, {"start_ts": "start_time", "end_ts": "end_time"}, strict=False)
    required = ("event_id", "event_name", "start_time", "end_time")
    checks = [
        ("MALFORMED_ROW", c("n_fields") < 4),
        ("MISSING_FIELD", reduce(or_, [is_empty(c(n)) for n in required])),
        ("TIMESTAMP", c("start_ts").isNull() | c("end_ts").isNull()),
        ("TIME_ORDER", c("start_ts") > c("end_ts")),
    ]
    return evaluate_once(raw.withColumn(REASON, _first_reason(checks)))


def clean_events_multiformat(rows: DataFrame, zones: DataFrame) -> DataFrame:
    # parsed once: both the distinct locations and the rows come from the written table
    events = materialize(_kept(screen_events_multiformat(rows)), "events")
    matched = match_zone_by_name(events, zones, "event_location")
    return matched.select(
        "event_id", squeeze(F.col("event_name")).alias("event_name"), "start_ts", "end_ts", "event_type",
        F.col("location_id").alias("start_location_id"), F.col("location_id").alias("end_location_id"),
    )


# -- counters


def reject_summary(screened: DataFrame, by_field_count: bool = False) -> DataFrame:
    """Rows per outcome: TOTAL, VALID, INVALID and each reject reason, as (counter, n).

    ``by_field_count`` adds one ``COLUMNS_n`` counter per field count of the rows with too few fields.
    """
    reason = F.col(REASON)
    counters = [
        F.lit("TOTAL"),
        F.when(reason.isNull(), "VALID").otherwise("INVALID"),
        reason,
    ]
    if by_field_count:
        short = F.concat(F.lit("COLUMNS_"), F.col("n_fields").cast("string"))
        counters.append(F.when(reason == "TOO_FEW_COLUMNS", short))
    # aggregate to one row per outcome before spreading to counters, so rows are not multiplied
    keys = [REASON, "n_fields"] if by_field_count else [REASON]
    grouped = screened.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    spread = grouped.select(F.explode(F.array(*counters)).alias("counter"), "n")
    return spread.filter(F.col("counter").isNotNull()).groupBy("counter").agg(F.sum("n").alias("n"))
