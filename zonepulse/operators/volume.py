"""How much traffic each zone carries, per transport mode."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.functions.plan import spread
from zonepulse.schemas import CITIBIKE, MODES, SUBWAY, TAXI, Mode

_TOTAL_COLUMN = {"taxi": "taxi_passengers", "subway": "subway_ridership", "citibike": "citibike_passengers"}


def zone_volume(trips: DataFrame, mode: Mode) -> DataFrame:
    """Weight per zone over both trip ends; a trip that starts and ends in one zone counts twice.

    Both ends come from one scan, and the partial aggregate leaves one row per zone and task, so a
    zone that holds a third of all trips costs no more than any other.
    """
    ends = [[F.col(z), F.col(mode.weight)] for z in (mode.start_zone, mode.end_zone)]
    return trips.select(spread(["zone_id", "weight"], *ends)).groupBy("zone_id").agg(
        F.sum("weight").cast(mode.weight_type).alias(_TOTAL_COLUMN[mode.name]))


def valid_days(trips: DataFrame, mode: Mode) -> DataFrame:
    """Number of distinct service days, one row."""
    return trips.agg(F.count_distinct(F.to_date(mode.day_time)).alias("days"))


def _one_key_for_nulls(mode: str | Column) -> Column:
    """Full outer joins never match null zones, so each mode keeps its own null-zone row."""
    return F.when(F.col("zone_id").isNull(), mode)


def zone_totals(taxi: DataFrame, subway: DataFrame, citibike: DataFrame) -> DataFrame:
    """The three volume tables side by side; a zone a mode does not serve has 0 there.

    Same rows as a three-way full outer join on the zone, with one shuffle instead of two joins.
    """
    tables = {"taxi": taxi, "subway": subway, "citibike": citibike}
    parts = [
        t.select(
            "zone_id",
            _one_key_for_nulls(F.lit(name)).alias("null_mode"),
            *[(F.col(c) if n == name else F.lit(None).cast(MODES[n].weight_type)).alias(c)
              for n, c in _TOTAL_COLUMN.items()],
        )
        for name, t in tables.items()
    ]
    every = reduce(DataFrame.unionByName, parts)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast(MODES[n].weight_type).alias(c) for n, c in _TOTAL_COLUMN.items()]
    return every.groupBy("zone_id", "null_mode").agg(*sums).drop("null_mode")


def _mode_marks(trips: DataFrame, mode: Mode) -> DataFrame:
    """Three marks per trip: its weight at either end, and the service day."""
    weight = F.col(mode.weight).cast("double")
    no_zone, no_day = F.lit(None).cast("int"), F.lit(None).cast("date")
    marks = spread(
        ["is_day", "zone_id", "day", "weight"],
        *[[F.lit(False), F.col(z).cast("int"), no_day, weight] for z in (mode.start_zone, mode.end_zone)],
        [F.lit(True), no_zone, F.to_date(mode.day_time), F.lit(None).cast("double")],
    )
    return trips.select(F.lit(mode.name).alias("mode"), marks)


def zone_traffic_daily(taxi: DataFrame, subway: DataFrame, citibike: DataFrame) -> DataFrame:
    """Totals, daily averages and shares of every zone that carries traffic.

    Each trip table is read once: zone weights and service days come out of the same aggregate, whose
    result has one row per (mode, zone) and (mode, day). Counts below 2^53 are exact in doubles.
    """
    tables = {TAXI: taxi, SUBWAY: subway, CITIBIKE: citibike}
    marks = reduce(DataFrame.unionByName, [_mode_marks(t, m) for m, t in tables.items()])
    small = marks.groupBy("mode", "is_day", "zone_id", "day").agg(F.sum("weight").alias("weight"))

    def of(mode: Mode) -> Column:
        return F.col("mode") == mode.name

    per_zone = small.groupBy(
        "is_day", "zone_id", F.when(~F.col("is_day"), _one_key_for_nulls(F.col("mode"))).alias("null_mode")
    ).agg(
        *[F.coalesce(F.sum(F.when(of(m), F.col("weight"))), F.lit(0)).cast(m.weight_type).alias(_TOTAL_COLUMN[m.name])
          for m in tables],
        *[F.count_if(of(m) & F.col("day").isNotNull()).alias(f"{m.name}_valid_days") for m in tables],
    )
    # one row per zone is left here, next to the one row that carries the day counts
    everywhere = Window.partitionBy()
    days = {m: F.max(f"{m.name}_valid_days").over(everywhere) for m in tables}
    with_days = per_zone.withColumns({f"{m.name}_valid_days": d for m, d in days.items()}).filter(~F.col("is_day"))

    total = reduce(Column.__add__, [F.col(c) for c in _TOTAL_COLUMN.values()])
    daily = {
        m: F.when(F.col(f"{m.name}_valid_days") > 0,
                  F.col(_TOTAL_COLUMN[m.name]).cast("double") / F.col(f"{m.name}_valid_days")).otherwise(0.0)
        for m in tables
    }
    busy = with_days.withColumn("total_passengers", total).filter(F.col("total_passengers") > 0)
    averaged = busy.withColumns({f"{m.name}_daily_passengers": d for m, d in daily.items()})
    all_daily = reduce(Column.__add__, [F.col(f"{m.name}_daily_passengers") for m in tables])
    averaged = averaged.withColumn("total_daily_passengers", all_daily)
    whole = F.col("total_daily_passengers")
    shares = [
        F.when(whole > 0, F.round(F.col(f"{m.name}_daily_passengers") * 100.0 / whole, 2)).otherwise(0.0)
        .alias(f"{m.name}_percentage_daily")
        for m in tables
    ]
    return averaged.select(
        "zone_id", "total_passengers", *_TOTAL_COLUMN.values(),
        *[f"{m.name}_valid_days" for m in tables],
        *[f"{m.name}_daily_passengers" for m in tables],
        "total_daily_passengers", *shares,
    )
