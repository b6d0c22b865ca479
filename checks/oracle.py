"""DuckDB SQL that states each registered query on its own, over the same Parquet tables."""

from __future__ import annotations

import re

from checks.params import (
    CANCELLED_AFTER,
    DAILY_AS_OF,
    DAILY_CUTOFF,
    DEMANDED_AFTER,
    HOURLY_AS_OF,
    HOURLY_CUTOFF,
)

START = "o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT)"

VIEWS = {
    "v_rides": f"""
SELECT n_name AS city_destination, CAST(o_orderkey AS VARCHAR) AS ride_uuid,
 {START} AS booked_start_at_local, {START} - INTERVAL '1' HOUR AS booked_start_at,
 o_orderdate - INTERVAL '1' DAY * CAST((o_orderkey * 7) % 40 AS INT) - INTERVAL '3' HOUR AS created_at,
 CASE WHEN l_returnflag = 'R' THEN {START}
      - INTERVAL '1' DAY * CAST(l_partkey % 35 AS INT) - INTERVAL '90' MINUTE END AS canceled_at,
 CASE l_returnflag WHEN 'R' THEN 'CancelledByCustomer' WHEN 'A' THEN 'Finished' ELSE 'Booked' END AS state,
 CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS corporation_name,
 r_name = 'MIDDLE EAST' AS is_emirates,
 CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS rides_demanded
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_simul_rides": """
SELECT 'city_' || CAST(user_id % 8 AS VARCHAR) AS city_destination,
 CAST(date_trunc('hour', ts) AS TIMESTAMP) AS delivery_timestamp, CAST(event_id AS VARCHAR) AS ride_uuid,
 event_type = 'signup' AS is_emirates, ts AS booked_start_at,
 CASE WHEN event_type = 'error' THEN
   ts - INTERVAL '1' DAY * CAST(event_id % 35 AS INT) - INTERVAL '90' MINUTE END AS canceled_at,
 CASE event_type WHEN 'error' THEN 'Cancelled' WHEN 'purchase' THEN 'Finished' ELSE 'Booked' END AS state
FROM events""",
    "v_past_forecasts": """
SELECT city_destination, CAST(d - INTERVAL '1' DAY * CAST(lead AS INT) AS DATE) AS observation_date,
 d AS delivery_date, CAST(lead AS INT) AS lead_time,
 CAST(n * 10 + (n * 37 + lead * 11 + day(d) * 5) % 17 AS DOUBLE) AS total_booked_cancelation_prediction,
 CAST(floor(n * 10 * (28 - lead) / CAST(28 AS DOUBLE)) AS BIGINT) AS running_sum_bookings,
 CAST(n * 10 + day(d) % 3 AS BIGINT) AS target_demanded
FROM (SELECT n_name AS city_destination, CAST(o_orderdate AS DATE) AS d, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY 1, 2) t CROSS JOIN range(28) AS l(lead)""",
    "v_forecast": """
SELECT city_destination, observation_date, delivery_date AS ride_date,
 running_sum_bookings AS total_bookings, total_booked_cancelation_prediction
FROM v_past_forecasts WHERE lead_time = 1""",
    "v_simul_past_forecasts": """
SELECT city_destination, delivery_timestamp AS booked_start_at_local, CAST(lead AS INT) AS lead_time,
 CAST(floor(n * (7 - lead) / CAST(7 AS DOUBLE)) AS BIGINT) AS total_booked_rs,
 (7 - lead) / CAST(7 AS DOUBLE) AS perc_booked_running_sum, n AS total_h_demand,
 CAST(n + (n * 3 + lead) % 4 AS DOUBLE) AS forecast_demand
FROM (SELECT city_destination, delivery_timestamp, count(*) AS n FROM v_simul_rides GROUP BY 1, 2) t
CROSS JOIN range(7) AS l(lead)""",
    "v_polygons": """
SELECT s_suppkey AS polygon_id, CAST(k AS INT) AS vertex_idx,
 CAST((s_suppkey * 7 + (k % 6) * (k % 6) * 13 + (k % 6) * 5) % 101 AS DOUBLE) AS lon,
 CAST((s_suppkey * 11 + (k % 6) * 29 + (k % 6) * (k % 6) * (k % 6) * 3) % 97 AS DOUBLE) AS lat
FROM supplier CROSS JOIN range(7) AS r(k)""",
    "v_baseline": """
SELECT CAST(o_orderdate AS DATE) AS date_seq, count(*) AS total_rides FROM orders GROUP BY 1""",
}
_NEEDS = {"v_forecast": ["v_past_forecasts"], "v_simul_past_forecasts": ["v_simul_rides"]}


def with_views(sql: str, ctes: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Prefix ``sql`` with the stand-in views it mentions and with ``ctes`` in order."""
    ctes = ctes or {}
    text = sql + " ".join(ctes.values())
    used: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            used += [n for n in _NEEDS.get(name, []) if n not in used]
            if name not in used:
                used.append(name)
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in used]
    parts += [f"{n} AS {'' if n.endswith('gj') else 'MATERIALIZED '}({t})" for n, t in ctes.items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + sql


def ema_sql(value: str, alpha: float, part: str, seq: str = "seqnum") -> str:
    """Closed form over a numbered series, rounded as the library rounds."""
    w = f"OVER (PARTITION BY {part} ORDER BY {seq})"
    return (
        f"round(round((SUM(power(1 / CAST({alpha} AS DOUBLE), {seq}) * {value}) {w}"
        f" + FIRST_VALUE({value}) {w}) / power(1 / CAST({alpha} AS DOUBLE), {seq} + 1), 6))"
    )


def lead_sql(start: str, end: str, cap: int = 28) -> str:
    days = f"date_sub('day', {start}, {end})"
    return f"CAST(CASE WHEN {days} IS NOT NULL THEN least({cap}, {days}) END AS INT)"


def safe_ln_sql(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln(CAST({x} AS DOUBLE)) ELSE 0.0 END"


def calendar_sql(*cols: str) -> str:
    return ", ".join(
        f"CAST(year({c}) AS INT) AS {c}_y, CAST(weekofyear({c}) AS INT) AS {c}_w,"
        f" CAST(isodow({c}) AS INT) AS {c}_d"
        for c in cols
    )


CAL = "observation_date, observation_date_y, observation_date_w, observation_date_d, delivery_date, delivery_date_y, delivery_date_w, delivery_date_d"


def numbered_past(cutoff: str = DAILY_CUTOFF) -> str:
    return f"""
SELECT *, CAST(row_number() OVER (PARTITION BY city_destination, observation_date ORDER BY delivery_date) - 1 AS BIGINT) AS seqnum
FROM v_past_forecasts WHERE observation_date > DATE '{cutoff}'"""


def smoothed_past(names: dict[str, float]) -> str:
    part = "city_destination, observation_date"
    cols = ", ".join(
        f"{ema_sql('total_booked_cancelation_prediction', a, part)} AS {n}" for n, a in names.items()
    )
    return f"SELECT *, {cols}, {calendar_sql('observation_date', 'delivery_date')} FROM numbered"


FIVE = {f"exp_mov_avg{i}": i / 10 for i in (3, 4, 5, 6, 7)}
THREE = {f"exp_mov_avg{i}": i / 10 for i in (4, 5, 6)}

FIVE_CTES = {"numbered": numbered_past(), "smoothed": smoothed_past(FIVE)}
FIVE_SELECT = f"""SELECT city_destination, {CAL}, lead_time, {', '.join(FIVE)},
 total_booked_cancelation_prediction, target_demanded FROM smoothed"""

DEMAND = f"""
SELECT city_destination, CAST(booked_start_at_local AS DATE) AS ride_date, count(DISTINCT ride_uuid) AS total_rides
FROM v_rides WHERE rides_demanded = 1 AND year(booked_start_at_local) > {DEMANDED_AFTER} AND NOT is_emirates
GROUP BY 1, 2"""

DEMAND_AVERAGES = "SELECT *, " + ", ".join(
    f"AVG(total_rides) OVER (ORDER BY city_destination, ride_date ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
    f" AS smoothen_average_pred_{k + 1}"
    for k in (2, 6, 13, 20)
) + " FROM demand"


def curve_ctes(view: str, key: str, key_expr: str) -> dict[str, str]:
    return {
        "cancel_counts": f"""
SELECT city_destination, {key_expr} AS {key}, {lead_sql('canceled_at', 'booked_start_at')} AS cancelation_lead_time,
 count(DISTINCT ride_uuid) AS total_cancelations
FROM {view} WHERE state LIKE '%Cancel%' AND NOT is_emirates AND year(booked_start_at) > {CANCELLED_AFTER}
GROUP BY 1, 2, 3""",
        "cancel_curve": f"""
SELECT *, CAST(SUM(total_cancelations) OVER (PARTITION BY city_destination, {key}
   ORDER BY cancelation_lead_time DESC NULLS LAST) AS BIGINT) AS total_cancelations_rs,
 COALESCE(LAG(cancelation_lead_time) OVER (PARTITION BY city_destination, {key}
   ORDER BY cancelation_lead_time NULLS LAST), -1) AS next_cancelation_lead_time
FROM cancel_counts""",
    }


DAILY_CURVE = curve_ctes("v_rides", "delivery_date", "CAST(booked_start_at_local AS DATE)")
HOURLY_CURVE = curve_ctes("v_simul_rides", "delivery_timestamp", "delivery_timestamp")

BOOKING_CTES = {
    "booking_counts": f"""
SELECT city_destination, CAST(booked_start_at_local AS DATE) AS ride_date,
 {lead_sql('created_at', 'booked_start_at')} AS lead_time, COALESCE(corporation_name, 'b2c') AS booker,
 count(DISTINCT ride_uuid) AS total_bookings
FROM v_rides WHERE booked_start_at_local < TIMESTAMP '{DAILY_AS_OF} 00:00:00' AND NOT is_emirates
GROUP BY 1, 2, 3, 4""",
    "booking_curve": """
SELECT DISTINCT g.city_destination, g.ride_date, CAST(l.lead_time AS INT) AS lead_time, g.booker,
 COALESCE(c.total_bookings, 0) AS total_bookings
FROM booking_counts g CROSS JOIN range(29) AS l(lead_time)
LEFT JOIN booking_counts c ON c.lead_time = l.lead_time AND c.city_destination = g.city_destination
 AND c.ride_date = g.ride_date AND c.booker = g.booker""",
    "running_bookings": """
SELECT *, CAST(SUM(total_bookings) OVER (PARTITION BY city_destination, booker, ride_date
  ORDER BY lead_time DESC) AS BIGINT) AS total_bookings_rs FROM booking_curve""",
    "top_booker": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city_destination, ride_date, lead_time
  ORDER BY total_bookings_rs DESC, booker) AS rn FROM running_bookings) WHERE rn = 1""",
}

FULL_CTES = {
    "numbered": numbered_past(),
    "smoothed": smoothed_past(THREE),
    **DAILY_CURVE,
    **BOOKING_CTES,
}


def full_select(extra: str = "", join: str = "") -> str:
    return f"""
SELECT p.city_destination, {', '.join('p.' + c.strip() for c in CAL.split(','))}, p.lead_time,
 exp_mov_avg4, exp_mov_avg5, exp_mov_avg6, {extra} p.total_booked_cancelation_prediction,
 {safe_ln_sql('p.total_booked_cancelation_prediction')} AS total_booked_cancelation_prediction_log,
 {safe_ln_sql('COALESCE(c.total_cancelations_rs, 0)')} AS total_cancelations_rs_log,
 {safe_ln_sql('COALESCE(b.total_bookings_rs, 0)')} AS total_bookings_rs_log,
 p.running_sum_bookings, COALESCE(c.total_cancelations_rs, 0) AS total_cancelations_rs,
 b.total_bookings_rs AS top_booker_amt, p.target_demanded
FROM smoothed p
LEFT JOIN cancel_curve c ON c.city_destination = p.city_destination AND c.delivery_date = p.delivery_date
 AND c.cancelation_lead_time - 1 >= p.lead_time AND c.next_cancelation_lead_time - 1 < p.lead_time
LEFT JOIN top_booker b ON b.city_destination = p.city_destination AND b.ride_date = p.delivery_date
 AND b.lead_time - 1 = p.lead_time {join}"""


def rounded(sql: str, digits: dict[str, int]) -> str:
    """Round some columns of a query; adding 0 turns a negative zero into zero."""
    cols = ", ".join(f"round({c}, {d}) + 0.0 AS {c}" for c, d in digits.items())
    return f"SELECT * REPLACE ({cols}) FROM ({sql}) t"


LOGS = ["total_booked_cancelation_prediction_log", "total_cancelations_rs_log", "total_bookings_rs_log"]
MEANS = [f"smoothen_average_pred_{k}" for k in (3, 7, 14, 21)]

GRID_CTES = {
    "hour_counts": f"""
SELECT city_destination, delivery_timestamp, count(DISTINCT ride_uuid) AS total_booked
FROM v_simul_rides WHERE NOT is_emirates AND delivery_timestamp < TIMESTAMP '{HOURLY_AS_OF} 00:00:00' GROUP BY 1, 2""",
    "city_hours": f"""
SELECT c.city_destination, h.delivery_timestamp
FROM (SELECT DISTINCT city_destination FROM hour_counts) c
CROSS JOIN (SELECT unnest(generate_series(CAST(DATE '{HOURLY_AS_OF}' - INTERVAL '12' MONTH AS TIMESTAMP),
  TIMESTAMP '{HOURLY_AS_OF} 00:00:00', INTERVAL '1' HOUR)) AS delivery_timestamp) h""",
    "grid": """
SELECT d.delivery_timestamp, d.city_destination, CAST(hour(d.delivery_timestamp) AS INT) AS delivery_timestamp_h,
 CAST(isodow(d.delivery_timestamp) AS INT) AS delivery_timestamp_dow, COALESCE(total_booked, 0) AS total_booked
FROM city_hours d LEFT JOIN hour_counts s ON s.city_destination = d.city_destination
 AND s.delivery_timestamp = d.delivery_timestamp""",
}


def slot_means(pooled: bool) -> str:
    city, tie = ("", ", city_destination") if pooled else ("city_destination, ", "")

    def mean(slot: str, k: int) -> str:
        return (
            f"AVG(total_booked) OVER (PARTITION BY {city}{slot} ORDER BY delivery_timestamp{tie}"
            f" ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
        )

    slot, day = "delivery_timestamp_dow, delivery_timestamp_h", "delivery_timestamp_dow"
    return f"""SELECT *, {mean(slot, 2)} AS rolling_dh_avg2, {mean(slot, 4)} AS rolling_dh_avg4,
 {mean(day, 168)} AS rolling_d_avg7, {mean(day, 336)} AS rolling_d_avg14 FROM grid"""


TRAILING = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY city_destination, observation_date ORDER BY delivery_timestamp) - 1 AS BIGINT) AS seqnum
FROM (SELECT g.*, o.observation_date FROM {{source}} g JOIN (
   SELECT CAST(unnest(generate_series(CAST(DATE '{HOURLY_AS_OF}' - INTERVAL '12' MONTH AS TIMESTAMP),
     TIMESTAMP '{HOURLY_AS_OF} 00:00:00', INTERVAL '1' DAY)) AS DATE) AS observation_date) o
   ON CAST(g.delivery_timestamp AS DATE) BETWEEN o.observation_date - INTERVAL '14' DAY AND o.observation_date
   WHERE o.observation_date > DATE '{HOURLY_CUTOFF}') t"""

SMOOTH_NAMES = {
    f"{m}_exp_smooth{i}": (m, i / 10)
    for m in ("rolling_dh_avg4", "rolling_dh_avg2", "rolling_d_avg7", "rolling_d_avg14")
    for i in (4, 5, 6)
}
PROFILE_CTES = {
    **GRID_CTES,
    "slot_means": slot_means(True),
    "trailing_rows": TRAILING.format(source="slot_means"),
    "smoothed": "SELECT *, "
    + ", ".join(f"{ema_sql(m, a, 'city_destination, observation_date')} AS {n}" for n, (m, a) in SMOOTH_NAMES.items())
    + " FROM trailing_rows",
    "profile": "SELECT city_destination, observation_date, delivery_timestamp_dow, delivery_timestamp_h, "
    + ", ".join(f"AVG({n}) AS avg_{n}" for n in SMOOTH_NAMES)
    + " FROM smoothed GROUP BY 1, 2, 3, 4",
}
PROFILE = [f"avg_{n}" for n in SMOOTH_NAMES]

HOURLY_CTES = {**PROFILE_CTES, **HOURLY_CURVE}
HOURLY_SELECT = f"""
SELECT f.city_destination || strftime(f.booked_start_at_local, '%Y-%m-%d %H:%M:%S') || CAST(f.lead_time AS VARCHAR) AS forecast_id,
 f.city_destination, f.booked_start_at_local,
 CAST(CAST(f.booked_start_at_local AS DATE) - INTERVAL '1' DAY * f.lead_time AS DATE) AS observation_date,
 CAST(isodow(f.booked_start_at_local) > 5 AS INT) AS delivery_date_weekday,
 CAST(isodow(f.booked_start_at_local) AS INT) AS delivery_date_dow,
 CAST(hour(f.booked_start_at_local) AS INT) AS delivery_date_h,
 f.lead_time, f.total_booked_rs, f.perc_booked_running_sum, {', '.join(PROFILE)},
 c.total_cancelations_rs, f.total_h_demand AS target, f.forecast_demand AS old_forecast
FROM v_simul_past_forecasts f
LEFT JOIN profile a ON a.city_destination = f.city_destination
 AND a.delivery_timestamp_dow = isodow(f.booked_start_at_local)
 AND a.delivery_timestamp_h = hour(f.booked_start_at_local)
 AND a.observation_date = CAST(CAST(f.booked_start_at_local AS DATE) - INTERVAL '1' DAY * f.lead_time AS DATE)
LEFT JOIN cancel_curve c ON c.city_destination = f.city_destination
 AND c.delivery_timestamp = f.booked_start_at_local
 AND c.cancelation_lead_time >= f.lead_time AND c.next_cancelation_lead_time < f.lead_time
WHERE f.booked_start_at_local > TIMESTAMP '{HOURLY_CUTOFF} 00:00:00'"""
