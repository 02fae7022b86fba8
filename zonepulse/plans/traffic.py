"""Zone volume and temporal patterns on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.operators import temporal as T
from zonepulse.operators import volume as A
from zonepulse.plans.registry import query, rounded
from zonepulse.plans.views import Views
from zonepulse.schemas import CITIBIKE, SUBWAY, TAXI, Mode

_VIEW = {"taxi": "taxi_volume", "subway": "subway_volume", "citibike": "bike_volume"}
_TOTAL = {"taxi": "taxi_passengers", "subway": "subway_ridership", "citibike": "citibike_passengers"}


def _volume_sql(m: Mode) -> str:
    amount = f"CAST(sum(w) AS {m.weight_type})"
    return f"""
SELECT zone_id, {f'round({amount}, 4)' if m is SUBWAY else amount} AS {_TOTAL[m.name]} FROM (
  SELECT {m.start_zone} AS zone_id, {m.weight} AS w FROM {_VIEW[m.name]}
  UNION ALL SELECT {m.end_zone}, {m.weight} FROM {_VIEW[m.name]}) t
GROUP BY zone_id"""


def _days_sql(m: Mode) -> str:
    return f"SELECT count(DISTINCT CAST({m.day_time} AS DATE)) AS days FROM {_VIEW[m.name]}"


for _m in (TAXI, SUBWAY, CITIBIKE):
    query(f"a01_zone_volume_{_m.name}", _volume_sql(_m))(
        lambda v, m=_m: rounded(A.zone_volume(v[_VIEW[m.name]], m)))
    query(f"a02_valid_days_{_m.name}", _days_sql(_m))(lambda v, m=_m: A.valid_days(v[_VIEW[m.name]], m))

TOTALS = f"""
SELECT coalesce(t.zone_id, s.zone_id, c.zone_id) AS zone_id, coalesce(taxi_passengers, 0) AS taxi_passengers,
       coalesce(subway_ridership, 0) AS subway_ridership, coalesce(citibike_passengers, 0) AS citibike_passengers
FROM ({_volume_sql(TAXI)}) t
FULL OUTER JOIN ({_volume_sql(SUBWAY)}) s ON t.zone_id = s.zone_id
FULL OUTER JOIN ({_volume_sql(CITIBIKE)}) c ON coalesce(t.zone_id, s.zone_id) = c.zone_id"""


@query("a03_zone_totals", TOTALS)
def a03(v: Views) -> DataFrame:
    volumes = [A.zone_volume(v[_VIEW[m.name]], m) for m in (TAXI, SUBWAY, CITIBIKE)]
    return rounded(A.zone_totals(*volumes))


@query("a04_zone_traffic_daily", f"""
WITH z AS ({TOTALS}), tv AS ({_days_sql(TAXI)}), sv AS ({_days_sql(SUBWAY)}), cv AS ({_days_sql(CITIBIKE)}),
d AS (
  SELECT z.*, tv.days AS taxi_valid_days, sv.days AS subway_valid_days, cv.days AS citibike_valid_days,
         CASE WHEN tv.days > 0 THEN CAST(taxi_passengers AS DOUBLE) / tv.days ELSE 0.0 END AS td,
         CASE WHEN sv.days > 0 THEN subway_ridership / sv.days ELSE 0.0 END AS sd,
         CASE WHEN cv.days > 0 THEN CAST(citibike_passengers AS DOUBLE) / cv.days ELSE 0.0 END AS cd
  FROM z CROSS JOIN tv CROSS JOIN sv CROSS JOIN cv)
SELECT zone_id, round(taxi_passengers + subway_ridership + citibike_passengers, 4) AS total_passengers,
       taxi_passengers, round(subway_ridership, 4) AS subway_ridership, citibike_passengers,
       taxi_valid_days, subway_valid_days, citibike_valid_days,
       round(td, 4) AS taxi_daily_passengers, round(sd, 4) AS subway_daily_passengers,
       round(cd, 4) AS citibike_daily_passengers, round(td + sd + cd, 4) AS total_daily_passengers,
       CASE WHEN td + sd + cd > 0 THEN round(td * 100.0 / (td + sd + cd), 2) ELSE 0.0 END AS taxi_percentage_daily,
       CASE WHEN td + sd + cd > 0 THEN round(sd * 100.0 / (td + sd + cd), 2) ELSE 0.0 END AS subway_percentage_daily,
       CASE WHEN td + sd + cd > 0 THEN round(cd * 100.0 / (td + sd + cd), 2) ELSE 0.0 END AS citibike_percentage_daily
FROM d WHERE taxi_passengers + subway_ridership + citibike_passengers > 0""")
def a04(v: Views) -> DataFrame:
    return rounded(A.zone_traffic_daily(*[v[_VIEW[m]] for m in ("taxi", "subway", "citibike")]))


# -- weekday and hour patterns

WEEKS = """SELECT DISTINCT year, month, CAST(weekofyear(transit_timestamp) AS INT) AS week_of_year FROM subway_rides"""


def _side_sql(view: str, zone: str, time: str, label: str, amount: str, direction: str, weeks: bool) -> str:
    values = f"{amount} AS population_in, 0 AS population_out" if direction == "in" else (
        f"0 AS population_in, {amount} AS population_out")
    join = f"""JOIN ({WEEKS}) w ON w.year = t.year AND w.month = t.month
      AND w.week_of_year = weekofyear(t.{time})""" if weeks else ""
    return f"""
  SELECT {zone} AS zone_id, '{label}' AS mode, t.year, t.month, CAST(dayofweek({time}) + 1 AS INT) AS day_of_week,
         CAST(hour({time}) AS INT) AS hour_of_day, {values}
  FROM {view} t {join} WHERE {zone} IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6"""


def profile_sql(view: str, m: Mode, label: str, amount: str, weeks: bool) -> str:
    return f"""
SELECT zone_id, mode, year, month, day_of_week, hour_of_day, CAST(sum(population_in) AS BIGINT) AS population_in,
       CAST(sum(population_out) AS BIGINT) AS population_out
FROM ({_side_sql(view, m.start_zone, m.start_time, label, amount, 'out', weeks)}
      UNION ALL {_side_sql(view, m.end_zone, m.end_time, label, amount, 'in', weeks)}) s
GROUP BY ALL"""


@query("a05_temporal_profile_subway", profile_sql(
    "subway_rides", SUBWAY, "subway", "CAST(trunc(sum(estimated_average_ridership)) AS BIGINT)", weeks=False))
def a05(v: Views) -> DataFrame:
    return T.subway_temporal_profile(v["subway_rides"])


def _taxi_kind(kind: str) -> str:
    return f"(SELECT * FROM taxi_rides WHERE taxi_type = '{kind}')"


for _kind, _label in (("yellow", "yellow_taxi"), ("fhv", "fhvhv")):
    query(f"a06_temporal_profile_{_label}", profile_sql(_taxi_kind(_kind), TAXI, _label, "count(*)", weeks=True))(
        lambda v, kind=_kind, label=_label: T.zone_temporal_profile(
            v["taxi_rides"].filter(F.col("taxi_type") == kind), TAXI, label, T.valid_weeks(v["subway_rides"])))

# Green taxis come from the multi-year trips, whose weeks the subway table of those years covers.
_GREEN = "(SELECT * FROM trips_all WHERE taxi_type = 'green')"
query("a06_temporal_profile_green_taxi", profile_sql(_GREEN, TAXI, "green_taxi", "count(*)", weeks=True).replace(
    "subway_rides", "subway_volume"))(
    lambda v: T.zone_temporal_profile(
        v["trips_all"].filter(F.col("taxi_type") == "green"), TAXI, "green_taxi", T.valid_weeks(v["subway_volume"])))


@query("a07_temporal_profile_citibike", profile_sql("bike_rides", CITIBIKE, "citibike", "count(*)", weeks=True))
def a07(v: Views) -> DataFrame:
    return T.zone_temporal_profile(v["bike_rides"], CITIBIKE, "citibike", T.valid_weeks(v["subway_rides"]))


@query("a08_valid_weeks", WEEKS)
def a08(v: Views) -> DataFrame:
    return T.valid_weeks(v["subway_rides"])


@query("a08_trips_in_valid_weeks", f"""
SELECT trip_id, pickup_ts FROM taxi_rides t JOIN ({WEEKS}) w
  ON w.year = t.year AND w.month = t.month AND w.week_of_year = weekofyear(t.pickup_ts)""")
def a08_trips(v: Views) -> DataFrame:
    kept = T.in_valid_weeks(v["taxi_rides"], T.valid_weeks(v["subway_rides"]), "pickup_ts")
    return kept.select("trip_id", "pickup_ts")
