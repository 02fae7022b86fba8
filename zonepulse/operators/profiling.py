"""Profiles. Each is one pass of conditional counts with partial aggregation, then a small reshape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse import schemas as S
from zonepulse.functions import validators as V
from zonepulse.functions.parsing import with_timestamps
from zonepulse.functions.plan import spread
from zonepulse.functions.text import is_empty, strip_padding
from zonepulse.functions.timeparts import from_epoch_micros
from zonepulse.operators.cleaning import bike_columns

TOTAL = "TOTAL_RECORDS"


def _unpivot_counts(one_row: DataFrame, names: list[str], key: str = "metric", value: str = "n") -> DataFrame:
    return one_row.unpivot([], names, key, value)


def _percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; 0 of nothing is 0."""
    return F.coalesce(F.round(F.try_divide(part * 100.0, whole), 2), F.lit(0.0))


# -- taxi


def _datetime_state(df: DataFrame, name: str) -> tuple[Column, Column]:
    """(is null, is valid) of a time column stored as text, timestamp or epoch microseconds."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.StringType):
        return V.is_null_text(c), V.valid_datetime(c)
    t = from_epoch_micros(c) if isinstance(kind, T.NumericType) else c
    return c.isNull(), F.coalesce(F.year(t).between(*S.VALID_YEARS), F.lit(False))


def profile_trips(raw: DataFrame, kind: str) -> DataFrame:
    """Validity counters of a raw trip table as (metric, n); counters that stay 0 are absent."""
    layout = S.TRIP_LAYOUTS[kind]
    states: dict[str, tuple[Column, Column]] = {
        "PICKUP_DATETIME": _datetime_state(raw, layout.pickup),
        "DROPOFF_DATETIME": _datetime_state(raw, layout.dropoff),
    }
    if layout.passengers:
        ok = V.number_ok(raw, layout.passengers, *S.PASSENGERS)
        states["PASSENGER_COUNT"] = V.is_null_text(F.col(layout.passengers)), ok
    ok = V.number_ok(raw, layout.distance, *S.TRIP_MILES)
    states[layout.distance.upper()] = V.is_null_text(F.col(layout.distance)), ok
    for short, name in (("PU_LOCATION", layout.pickup_zone), ("DO_LOCATION", layout.dropoff_zone)):
        states[short] = F.lit(False), F.coalesce(V.zone_ok(raw, name), F.lit(False))

    # one state per check and row, so that each check is evaluated once for its three counters
    outcome = [
        F.when(missing, "NULL").when(valid, "VALID").otherwise("INVALID").alias(short)
        for short, (missing, valid) in states.items()
    ]
    counts = {TOTAL: F.count(F.lit(1))}
    for short in states:
        for state in ("NULL", "VALID", "INVALID"):
            counts[f"{state}_{short}"] = F.count_if(F.col(short) == state)
    one_row = raw.select(*outcome).agg(*[c.alias(n) for n, c in counts.items()])
    return _unpivot_counts(one_row, list(counts)).filter(F.col("n") > 0)


def profile_report(profile: DataFrame) -> DataFrame:
    """Each metric with its percentage of all records, plus the overall quality scores.

    QUALITY_SCORE is the share of valid checks among all checks. QUALITY_SCORE_LITERAL counts every
    metric whose name contains VALID, which includes the invalid ones.
    """
    is_check = F.col("metric") != TOTAL
    n = F.col("n")
    summary = profile.agg(
        F.sum(F.when(is_check, n)).alias("checks"),
        F.sum(F.when(F.col("metric").startswith("VALID_"), n)).alias("good"),
        F.sum(F.when(is_check & F.col("metric").contains("VALID"), n)).alias("literal"),
    )
    scores = summary.select(
        spread(
            ["metric", "n", "pct"],
            [F.lit("QUALITY_SCORE"), F.col("good"), _percent(F.col("good"), F.col("checks"))],
            [F.lit("QUALITY_SCORE_LITERAL"), F.col("literal"), _percent(F.col("literal"), F.col("checks"))],
        )
    )
    # a profile has one row per counter, about twenty in all
    total = F.sum(F.when(~is_check, n)).over(Window.partitionBy())
    lines = profile.select("metric", "n", _percent(n, total).alias("pct"))
    return lines.unionByName(scores).orderBy("metric")


# -- bikes (text columns without padding, as ``bike_columns`` gives them)

_ID_AND_NAME = ("ride_id", "start_station_name", "end_station_name")
_CATEGORIES = ("rideable_type", "member_casual")
_STATION_IDS = ("start_station_id", "end_station_id")
_TIMES = ("started_at", "ended_at")
_COORDINATES = {"start_lat": S.LAT_RANGE, "start_lng": S.LNG_RANGE, "end_lat": S.LAT_RANGE, "end_lng": S.LNG_RANGE}


def _base(c: Column) -> dict[str, Column]:
    return {"total": F.count(F.lit(1)), "missing": F.count_if(is_empty(c))}


def id_or_name_measures(c: Column) -> dict[str, Column]:
    """Counts for an id or name column."""
    return _base(c)


def categorical_measures(c: Column) -> dict[str, Column]:
    """Counts for a category column; the values themselves come from ``category_counts``."""
    return {**_base(c), "unique_values": F.count_distinct(F.when(~is_empty(c), c))}


def station_id_measures(c: Column) -> dict[str, Column]:
    return {**_base(c), "invalid": F.count_if(~is_empty(c) & ~V.valid_station_id(c))}


def time_measures(c: Column) -> dict[str, Column]:
    """Counts and text bounds of a time column; only texts of an accepted length enter the bounds."""
    full = V.full_time_text(c)
    usable = full.isNotNull()
    return {
        **_base(c),
        "invalid": F.count_if(~is_empty(c) & full.isNull()),
        "miss_precision": F.count_if(usable & (F.length(c) == 19)),
        "out_of_range": F.count_if(usable & ~full.between(S.BIKE_TIME_MIN, S.BIKE_TIME_MAX)),
        "min_time": F.min(F.when(usable, full)),
        "max_time": F.max(F.when(usable, full)),
    }


def coordinate_measures(c: Column, bounds: tuple[float, float]) -> dict[str, Column]:
    value = V.finite_number(c)
    return {
        **_base(c),
        "invalid": F.count_if(~is_empty(c) & value.isNull()),
        "out_of_range": F.count_if(value.isNotNull() & ~value.between(*bounds)),
    }


_MEASURES = {
    "total": "bigint", "missing": "bigint", "invalid": "bigint", "miss_precision": "bigint",
    "out_of_range": "bigint", "unique_values": "bigint", "min_time": "string", "max_time": "string",
}


def _folded(name: str, measure: str) -> Column:
    """A measure of all rows from those of their groups: counts add up, bounds stay bounds."""
    c = F.col(f"`{name}:{measure}`")
    return {"min_time": F.min, "max_time": F.max}.get(measure, lambda n: F.coalesce(F.sum(n), F.lit(0)))(c).alias(f"{name}:{measure}")


def profile_columns(df: DataFrame, measures: dict[str, dict[str, Column]], categories: Sequence[str] = ()) -> DataFrame:
    """One row per column with the given measures and their percentages, in one pass over ``df``.

    Of the ``categories`` among the columns distinct values are counted too: rows are first reduced to one for each
    combination of values, which holds the measures of all columns, and folded from there. Exact distinct
    counts in the pass itself would multiply its rows.
    """
    flat = [c.alias(f"{name}:{m}") for name, per in measures.items() for m, c in per.items()]
    if categories:
        groups = df.groupBy(*categories).agg(*flat)
        unique = [F.count_distinct(F.when(~is_empty(F.col(c)), F.col(c))).alias(f"{c}:unique_values") for c in categories]
        one_row = groups.agg(*[_folded(name, m) for name, per in measures.items() for m in per], *unique)
        measures = {name: {**per, **({"unique_values": F.lit(0)} if name in categories else {})} for name, per in measures.items()}
    else:
        one_row = df.agg(*flat)
    rows = [
        [F.lit(name), *[(F.col(f"`{name}:{m}`") if m in per else F.lit(None)).cast(k) for m, k in _MEASURES.items()]]
        for name, per in measures.items()
    ]
    table = one_row.select(spread(["column_name", *_MEASURES], *rows))
    shares = [
        F.when(F.col(m).isNotNull(), _percent(F.col(m), F.col("total"))).alias(f"{m}_pct")
        for m in ("missing", "invalid", "miss_precision", "out_of_range")
    ]
    return table.select("*", *shares)


def profile_id_column(df: DataFrame, name: str) -> DataFrame:
    return profile_columns(df, {name: id_or_name_measures(F.col(name))}).select(
        "column_name", "total", "missing", "missing_pct")


profile_name_column = profile_id_column


def profile_station_id(df: DataFrame, name: str) -> DataFrame:
    return profile_columns(df, {name: station_id_measures(F.col(name))}).select(
        "column_name", "total", "missing", "missing_pct", "invalid", "invalid_pct")


def profile_time_column(df: DataFrame, name: str) -> DataFrame:
    out = profile_columns(df, {name: time_measures(F.col(name))})
    return out.select(
        "column_name", "total", "missing", "missing_pct", "invalid", "invalid_pct", "miss_precision",
        "miss_precision_pct", "out_of_range", "out_of_range_pct", "min_time", "max_time",
        F.lit(f"[{S.BIKE_TIME_MIN} to {S.BIKE_TIME_MAX}]").alias("accepted_range"),
    )


def profile_coordinate(df: DataFrame, name: str) -> DataFrame:
    out = profile_columns(df, {name: coordinate_measures(F.col(name), _COORDINATES[name])})
    return out.select("column_name", "total", "missing", "missing_pct", "invalid", "invalid_pct",
                      "out_of_range", "out_of_range_pct")


def category_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows per non-blank value of each column: (column_name, value, n).

    A table rather than one map per column, so a dirty column with many values stays distributed.
    """
    pairs = [[F.lit(n), F.col(n)] for n in names]
    long = df.select(spread(["column_name", "value"], *pairs)).filter(~is_empty(F.col("value")))
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_categorical(df: DataFrame, name: str) -> DataFrame:
    """Rows (column_name, measure, value, n, pct): total, missing, unique_values, and one row per value.

    The value counts stay rows of a table, so a dirty column with many values is no problem; only the
    three totals are reduced to one row.
    """
    value = F.when(~is_empty(F.col(name)), F.col(name))
    counts = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    summary = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(known).alias("unique_values"),
    )
    no_share = F.lit(None).cast("double")
    measures = summary.select(spread(
        ["measure", "n", "pct"],
        [F.lit("total"), F.col("total"), no_share],
        [F.lit("missing"), F.col("missing"), _percent(F.col("missing"), F.col("total"))],
        [F.lit("unique_values"), F.col("unique_values"), no_share],
    ))
    values = counts.filter(known).select(F.lit("value").alias("measure"), "value", "n")
    every = measures.unionByName(values, allowMissingColumns=True)
    return every.select(F.lit(name).alias("column_name"), "measure", "value", "n", "pct")


def profile_bikes(lines: DataFrame) -> DataFrame:
    """Profile of all 13 ride columns in one pass. Short rows are left out (see ``malformed_bikes``)."""
    rides = bike_columns(lines).filter(F.col("n_fields") >= len(S.BIKE_COLUMNS))
    measures: dict[str, dict[str, Column]] = {}
    for name in S.BIKE_COLUMNS:
        c = F.col(name)
        if name in _CATEGORIES:
            measures[name] = _base(c)
        elif name in _STATION_IDS:
            measures[name] = station_id_measures(c)
        elif name in _TIMES:
            measures[name] = time_measures(c)
        elif name in _COORDINATES:
            measures[name] = coordinate_measures(c, _COORDINATES[name])
        else:
            measures[name] = id_or_name_measures(c)
    return profile_columns(rides, measures, _CATEGORIES)


def malformed_bikes(lines: DataFrame) -> DataFrame:
    """Number of ride lines with fewer than 13 fields."""
    return lines.agg(F.count_if(F.size("fields") < len(S.BIKE_COLUMNS)).alias("malformed_row"))


# -- permitted events (input: read_delimited, no trailing pieces)


def _event_columns(lines: DataFrame) -> DataFrame:
    return lines.select(
        (F.size("fields") == S.EVENT_FIELD_COUNT).alias("well_formed"),
        *[strip_padding(F.get("fields", F.lit(i))).alias(n) for n, i in S.EVENT_FIELDS.items()],
    )


def _with_event_times(rows: DataFrame) -> DataFrame:
    return with_timestamps(rows, {"start_ts": "start_time", "end_ts": "end_time"}, strict=True)


def profile_events(lines: DataFrame) -> DataFrame:
    """Counters as (metric, n); counters that stay 0 are absent."""
    ok = F.col("well_formed")
    counts = {"row_count": F.count(F.lit(1)), "malformed_row": F.count_if(~ok)}
    for name in S.EVENT_FIELDS:
        counts[f"empty_{name}"] = F.count_if(ok & (F.col(name) == ""))
    for side in ("start", "end"):
        unparsed = (F.col(f"{side}_time") != "") & F.col(f"{side}_ts").isNull()
        counts[f"invalid_timestamp_{side}"] = F.count_if(ok & unparsed)
    counts["location_mapping_missing"] = F.count_if(ok & (F.col("event_location") == ""))
    one_row = _with_event_times(_event_columns(lines)).agg(*[c.alias(n) for n, c in counts.items()])
    return _unpivot_counts(one_row, list(counts)).filter(F.col("n") > 0)


def event_value_counts(lines: DataFrame) -> DataFrame:
    """Rows per event type and per raw location: (kind, value, n)."""
    rows = _event_columns(lines).filter("well_formed")
    pairs = [[F.lit(n), F.col(n)] for n in ("event_type", "event_location")]
    return rows.select(spread(["kind", "value"], *pairs)).filter(F.col("value") != "").groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("n"))


def event_time_bounds(lines: DataFrame) -> DataFrame:
    """Earliest and latest start and end among the texts that parse, in one row."""
    rows = _with_event_times(_event_columns(lines).filter("well_formed"))
    return rows.agg(
        F.min("start_ts").alias("min_start_time"), F.max("start_ts").alias("max_start_time"),
        F.min("end_ts").alias("min_end_time"), F.max("end_ts").alias("max_end_time"),
    )


# -- curated tables


def distinct_location_ids(trips: DataFrame, kind: str = "taxi_type") -> DataFrame:
    """Distinct (kind, id) with the sides it occurs on; one small row per id, whatever the trip count."""
    sides = spread(
        ["id", "as_start", "as_end"],
        [F.col("start_location_id"), F.lit(1), F.lit(0)],
        [F.col("end_location_id"), F.lit(0), F.lit(1)],
    )
    return trips.select(F.col(kind).alias("kind"), sides).filter(F.col("id").isNotNull()).groupBy(
        "kind", "id").agg(F.max("as_start").alias("as_start"), F.max("as_end").alias("as_end"))


def audit_location_ids(trips: DataFrame, kind: str = "taxi_type") -> DataFrame:
    """Distinct start, end and combined ids, their bounds and how many are valid, per kind and for ALL."""
    ids = distinct_location_ids(trips, kind)
    overall = ids.groupBy("id").agg(F.max("as_start").alias("as_start"), F.max("as_end").alias("as_end"))
    every = ids.unionByName(overall.withColumn("kind", F.lit("ALL")))
    valid = F.col("id").between(S.ZONE_ID_MIN, S.ZONE_ID_MAX)
    return every.groupBy("kind").agg(
        F.sum("as_start").alias("start_ids"), F.sum("as_end").alias("end_ids"),
        F.count(F.lit(1)).alias("all_ids"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.count_if(valid).alias("in_range"), F.count_if(~valid).alias("out_of_range"),
    )


def location_ids_out_of_range(trips: DataFrame, kind: str = "taxi_type") -> DataFrame:
    """The distinct ids outside the valid range, ordered."""
    bad = distinct_location_ids(trips, kind).filter(~F.col("id").between(S.ZONE_ID_MIN, S.ZONE_ID_MAX))
    return bad.select("id").distinct().orderBy("id")


def partition_counts(table: DataFrame) -> DataFrame:
    """Rows per year and month, ordered."""
    return table.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).orderBy("year", "month")


def preview(table: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the smallest keys: a top-n of each task, not a sort of the table."""
    return table.orderBy(key).limit(n)


def find_by_ids(
    table: DataFrame, key: str, ids: list | DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Rows of the given keys (a list, or a frame with the key column), optionally inside one partition, which
    is then the only one that is scanned."""
    if isinstance(ids, DataFrame):
        picked = table.join(ids.select(key), key, "left_semi")
    else:
        picked = table.filter(F.col(key).isin(*ids))
    if year is not None:
        picked = picked.filter(F.col("year") == year)
    if month is not None:
        picked = picked.filter(F.col("month") == month)
    return picked
