"""Event impact on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from zonepulse.operators import impact as E
from zonepulse.plans.registry import query, rounded, sql_rounded
from zonepulse.plans.views import Views
from zonepulse.schemas import CITIBIKE, SUBWAY, TAXI, Mode
from zonepulse.sources.scratch import materialize

_VIEW = {"taxi": "taxi_rides", "subway": "subway_rides", "citibike": "bike_rides"}
_MODES = (TAXI, SUBWAY, CITIBIKE)

WINDOWS = """
SELECT event_id, event_name, event_type, start_location_id AS zone_id, start_time, end_time,
       start_time - INTERVAL '90' MINUTE AS pre_start_time, end_time + INTERVAL '90' MINUTE AS post_end_time
FROM permits"""


@query("e01_event_windows", WINDOWS)
def e01(v: Views) -> DataFrame:
    return E.event_windows(v["permits"])


def _tables(v: Views) -> list[DataFrame]:
    return [v[_VIEW[m.name]] for m in _MODES]


def _moves(m: Mode, weight: str | None = None, where: str = "true") -> str:
    """Departures and arrivals as rows."""
    sides = (("in", m.end_zone, m.end_time), ("out", m.start_zone, m.start_time))
    return " UNION ALL ".join(
        f"SELECT '{way}' AS way, {zone} AS place, {t} AS t, {weight or m.weight} AS w FROM {_VIEW[m.name]} WHERE {where}" for way, zone, t in sides)


def _spans(last_day: int) -> str:
    """The windows of each event as rows: arrivals k days before, departures k days after."""
    return f"""
SELECT event_id, event_name, event_type, zone_id, start_time, end_time, k, way,
       CASE way WHEN 'in' THEN pre_start_time - to_days(k) ELSE end_time + to_days(k) END AS lo,
       CASE way WHEN 'in' THEN start_time - to_days(k) ELSE post_end_time + to_days(k) END AS hi
FROM ({WINDOWS}) w, (SELECT CAST(unnest(range({last_day + 1})) AS INT) AS k) n, (SELECT unnest(['in', 'out']) AS way) d"""


def _total(condition: str) -> str:
    return f"coalesce(sum(w) FILTER ({condition}), 0)"


def _actual_sql(m: Mode) -> str:
    n, kind = m.name, m.weight_type
    return f"""
SELECT event_id, event_name, event_type, zone_id, CAST({_total("s.way = 'in'")} AS {kind}) AS {n}_inbound_pre,
       CAST({_total("s.way = 'out'")} AS {kind}) AS {n}_outbound_post
FROM ({_spans(0)}) s LEFT JOIN ({_moves(m)}) x ON x.way = s.way AND x.place = s.zone_id AND x.t >= s.lo AND x.t < s.hi
GROUP BY ALL"""


ACTUAL = f"""
SELECT a.event_id, a.event_name, a.event_type, a.zone_id, taxi_inbound_pre, taxi_outbound_post,
       subway_inbound_pre, subway_outbound_post, citibike_inbound_pre, citibike_outbound_post
FROM ({_actual_sql(TAXI)}) a JOIN ({_actual_sql(SUBWAY)}) b USING (event_id)
JOIN ({_actual_sql(CITIBIKE)}) c USING (event_id)"""


@query("e02_event_actual", f"""
SELECT * REPLACE (round(subway_inbound_pre, 4) AS subway_inbound_pre,
                  round(subway_outbound_post, 4) AS subway_outbound_post) FROM ({ACTUAL}) x""")
def e02(v: Views) -> DataFrame:
    return rounded(E.event_actual(v["permits"], *_tables(v)))


EXCLUDED = """
SELECT DISTINCT start_location_id AS zone_id, CAST(start_time AS DATE) AS exclude_date FROM permits
UNION SELECT DISTINCT start_location_id, CAST(end_time AS DATE) FROM permits"""


@query("e03_event_exclude_dates", EXCLUDED)
def e03(v: Views) -> DataFrame:
    return E.event_exclude_dates(v["permits"])


def _clock(t: str) -> str:
    return f"(hour({t}) * 3600 + minute({t}) * 60 + second({t}))"


def _daily_sql(m: Mode, directional: bool = False) -> str:
    """Trips by the zones they touch, on days without events there; a window is 5,400 seconds of the clock's circle from its start."""
    known = f"{m.end_time} AS arrival, {m.start_time} AS departure, {m.end_zone} AS to_zone, {m.start_zone} AS from_zone, {m.weight} AS w FROM {_VIEW[m.name]}"

    def side(t: str, since: str, zone: str) -> str:
        own = f" AND {zone} = zone_id" if directional else ""
        return f"CAST({_total(f'({_clock(t)} - {since} + 86400) % 86400 <= 5400{own}')} AS {m.weight_type})"

    return f"""
SELECT event_id, CAST(arrival AS DATE) AS baseline_date, {side('arrival', 'since_in', 'to_zone')} AS baseline_inbound,
       {side('departure', 'since_out', 'from_zone')} AS baseline_outbound
FROM (SELECT event_id, zone_id, {_clock('pre_start_time')} AS since_in, {_clock('end_time')} AS since_out FROM ({WINDOWS}) w) e
JOIN (SELECT {m.end_zone} AS zone_id, {known} UNION ALL
      SELECT {m.start_zone} AS zone_id, {known} WHERE {m.start_zone} IS DISTINCT FROM {m.end_zone}) p USING (zone_id)
WHERE NOT EXISTS (SELECT 1 FROM ({EXCLUDED}) x WHERE x.zone_id = p.zone_id AND x.exclude_date IN (CAST(arrival AS DATE), CAST(departure AS DATE)))
GROUP BY 1, 2"""


for _id, _m in (("e04", TAXI), ("e05", SUBWAY), ("e06", CITIBIKE)):
    _names = ["baseline_inbound", "baseline_outbound"]
    _sql = f"SELECT event_id, baseline_date, {sql_rounded(_names)} FROM ({_daily_sql(_m)}) d" if _m is SUBWAY else (
        _daily_sql(_m))
    query(f"{_id}_daily_baseline_{_m.name}", _sql)(
        lambda v, m=_m: rounded(E.daily_baseline(v["permits"], v[_VIEW[m.name]], m)))

query("e04_daily_baseline_taxi_directional", _daily_sql(TAXI, directional=True))(
    lambda v: E.daily_baseline(v["permits"], v["taxi_rides"], TAXI, directional=True))


def _average_sql(directional: bool = False) -> str:
    parts = [f"""(SELECT event_id, avg(baseline_inbound) AS baseline_{m.name}_inbound,
       avg(baseline_outbound) AS baseline_{m.name}_outbound FROM ({_daily_sql(m, directional)}) d GROUP BY 1)"""
             for m in _MODES]
    return f"SELECT * FROM {parts[0]} t FULL JOIN {parts[1]} s USING (event_id) FULL JOIN {parts[2]} c USING (event_id)"


_BASELINES = [f"baseline_{m.name}_{side}" for m in _MODES for side in ("inbound", "outbound")]


def _baseline(v: Views, directional: bool = False) -> DataFrame:
    return E.baseline_average(v["permits"], dict(zip(_MODES, _tables(v), strict=True)), directional)


query("e07_baseline_average", f"SELECT event_id, {sql_rounded(_BASELINES, 6)} FROM ({_average_sql()}) b")(
    lambda v: rounded(_baseline(v), 6))
query("e07_baseline_average_directional",
      f"SELECT event_id, {sql_rounded(_BASELINES, 6)} FROM ({_average_sql(True)}) b")(
    lambda v: rounded(_baseline(v, directional=True), 6))


def _ratio(m: Mode, side: str, when: str) -> str:
    n = f"{m.name}_{side}"
    return f"round(CAST({n}_{when} AS DOUBLE) / nullif(baseline_{n}, 0), 2) AS {n}_ratio"


_RATIOS = ", ".join(_ratio(m, s, w) for m in _MODES for s, w in (("inbound", "pre"), ("outbound", "post")))


IMPACT = f"""
SELECT a.* REPLACE (round(subway_inbound_pre, 4) AS subway_inbound_pre,
                    round(subway_outbound_post, 4) AS subway_outbound_post),
       {sql_rounded(_BASELINES, 6)}, {_RATIOS}
FROM ({ACTUAL}) a LEFT JOIN ({_average_sql()}) b USING (event_id)"""


@query("e08_event_impact", IMPACT)
def e08(v: Views) -> DataFrame:
    return impact_of(v, v["permits"])


def impact_of(v: Views, events: DataFrame) -> DataFrame:
    impact = E.event_impact(events, *_tables(v))
    return rounded(rounded(impact, 6, _BASELINES), 4, ["subway_inbound_pre", "subway_outbound_post"])


MID_WEEK = """
WITH d AS (SELECT DISTINCT CAST(transit_timestamp AS DATE) AS day FROM subway_rides
           WHERE transit_timestamp >= DATE '2024-01-01' AND transit_timestamp < DATE '2025-01-01'),
     w AS (SELECT CAST(min(day) + 3 AS DATE) AS mid FROM d GROUP BY year(day), month(day))
SELECT event_id, event_name, event_type, start_location_id, end_location_id, start_time, end_time
FROM permits JOIN w ON CAST(start_time AS DATE) = mid
WHERE start_time >= TIMESTAMP '2024-01-01' AND start_time < TIMESTAMP '2025-01-01'
  AND date_sub('hour', start_time, end_time) <= 5"""


@query("e09_events_on_mid_dates", MID_WEEK)
def e09(v: Views) -> DataFrame:
    return E.events_on_mid_dates(v["permits"], v["subway_rides"])


@query("e09_sample_midweek_events", f"""
SELECT * FROM ({MID_WEEK}) p ORDER BY md5('mobility' || CAST(event_id AS VARCHAR)), event_id, start_time LIMIT 12""")
def e09_sample(v: Views) -> DataFrame:
    return E.sample_midweek_events(v["permits"], v["subway_rides"], salt="mobility")


def _sampled_sql(m: Mode, events: str = "permits") -> str:
    n, kind = m.name, m.weight_type
    year = f"{m.period_time} >= TIMESTAMP '2024-01-01' AND {m.period_time} < TIMESTAMP '2025-01-01'"
    number = (lambda x: f"round({x}, 4)") if m is SUBWAY else (lambda x: x)
    columns = [f"""{number(f"CAST({_total(f"s.way = '{way}' AND k = 0")} AS {kind})")} AS {n}_{name}""" for way, name in (("in", "inbound_pre"), ("out", "outbound_post"))]
    columns += [f"""round(CAST({_total(f"s.way = '{way}' AND k > 0")} AS DOUBLE) / 3.0, 4) AS avg_{n}_{name}_baseline""" for way, name in (("in", "inbound"), ("out", "outbound"))]
    spans = _spans(3).replace("FROM permits", f"FROM {events}")
    return f"""
SELECT event_id, event_name, event_type, zone_id, start_time, end_time, {", ".join(columns)}
FROM ({spans}) s LEFT JOIN ({_moves(m, "1" if m is CITIBIKE else None, year)}) x ON x.way = s.way AND x.place = s.zone_id AND x.t >= s.lo AND x.t < s.hi
GROUP BY 1, 2, 3, 4, 5, 6"""


def _sampled(v: Views, m: Mode, events: DataFrame | None = None) -> DataFrame:
    return E.sampled_impact(v["permits"] if events is None else events, v[_VIEW[m.name]], m)


for _id, _m in (("e10", TAXI), ("e11", SUBWAY), ("e12", CITIBIKE)):
    query(f"{_id}_sampled_impact_{_m.name}", _sampled_sql(_m))(lambda v, m=_m: rounded(_sampled(v, m)))


def _summary_sql(taxi: str, subway: str, citibike: str) -> str:
    columns = {m.name: [f"{m.name}_inbound_pre", f"{m.name}_outbound_post", f"avg_{m.name}_inbound_baseline",
                        f"avg_{m.name}_outbound_baseline"] for m in _MODES}
    shown = ", ".join(f"round(coalesce({c}, 0), 4) AS {c}" if c.startswith(("avg", "subway"))
                      else f"coalesce({c}, 0) AS {c}" for cs in columns.values() for c in cs)
    sums = ["(" + " + ".join(f"coalesce({cs[i]}, 0)" for cs in columns.values()) + ")" for i in range(4)]
    return f"""
SELECT event_id, t.event_name, t.event_type, t.zone_id, t.start_time, t.end_time, {shown},
       round({sums[0]}, 3) AS total_inbound_pre, round({sums[1]}, 3) AS total_outbound_post,
       round({sums[2]}, 3) AS avg_total_inbound_baseline, round({sums[3]}, 3) AS avg_total_outbound_baseline,
       round({sums[0]} - {sums[2]}, 3) AS total_inbound_delta, round({sums[1]} - {sums[3]}, 3) AS total_outbound_delta
FROM ({taxi}) t LEFT JOIN ({subway}) s USING (event_id) LEFT JOIN ({citibike}) c USING (event_id)"""


_TOTALS = ["total_inbound_pre", "total_outbound_post", "avg_total_inbound_baseline", "avg_total_outbound_baseline",
           "total_inbound_delta", "total_outbound_delta"]


def _summary(v: Views, events: DataFrame | None = None) -> DataFrame:
    sampled = E.sampled_impacts(v["permits"] if events is None else events, dict(zip(_MODES, _tables(v), strict=True)))
    out = E.summarize(sampled)
    return rounded(rounded(out, 3, _TOTALS), 4, [n for n, k in out.dtypes if k == "double" and n not in _TOTALS])


@query("e13_event_transit_summary", _summary_sql(*[_sampled_sql(m) for m in _MODES]))
def e13(v: Views) -> DataFrame:
    return _summary(v)


_SAMPLE = f"""(SELECT * FROM ({MID_WEEK}) p
  ORDER BY md5('mobility' || CAST(event_id AS VARCHAR)), event_id, start_time LIMIT 12) picked"""


@query("e13_sampled_transit_summary", _summary_sql(*[_sampled_sql(m, _SAMPLE) for m in _MODES]))
def e13_sampled(v: Views) -> DataFrame:
    """The sample is built once and saved; every mode reads the saved rows."""
    return _summary(v, materialize(E.sample_midweek_events(v["permits"], v["subway_rides"]), "sample"))
