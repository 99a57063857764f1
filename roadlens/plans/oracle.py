"""DuckDB SQL twins of the registered queries (the correctness oracle).

The CTEs below rebuild the same telemetry / driving-event / vehicle views
as :mod:`roadlens.sources.testmap` from the pre-registered ``events`` view.
Every computed column is aliased exactly like the Spark side.
"""

from __future__ import annotations

from roadlens import schemas as S
from roadlens.sources.testmap import DTC_SOURCE_TYPE, EVENT_TYPE_MAP, IGNITION_OFF_SOURCE_TYPE

D = "CAST({} AS DOUBLE)".format

VEHICLE_ID = "'veh_' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')"


def uuid_sql(text: str) -> str:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr(md5({text}), {at}, {n})" for at, n in cuts)


_TRIP = uuid_sql("CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)")
TRIP_ID = f"CASE WHEN event_type <> '{IGNITION_OFF_SOURCE_TYPE}' THEN {_TRIP} END"
ARRIVAL = "ts + to_seconds((event_id % 7) * 30)"

TEL_BASE = f"""
  SELECT
    {VEHICLE_ID} AS vehicle_id,
    {TRIP_ID} AS trip_id,
    ts AS event_time,
    {D('-6.3')} + CAST(event_id % 1000 AS DOUBLE) / {D('5000.0')} AS lat,
    {D('106.7')} + CAST(event_id % 977 AS DOUBLE) / {D('4000.0')} AS lon,
    CAST((event_id * 37) % 360 AS DOUBLE) AS heading_deg,
    value AS speed_kmh,
    CAST(1 + event_id % 5 AS INTEGER) AS gear,
    CAST(800 + (event_id * 13) % 5700 AS INTEGER) AS rpm,
    CAST(event_id % 101 AS DOUBLE) AS throttle_pct,
    CAST(CAST(800 + (event_id * 13) % 5700 AS INTEGER) AS DOUBLE) * CAST(event_id % 101 AS DOUBLE) / {D('1000.0')} AS maf_g_per_s,
    CAST(60 + event_id % 50 AS DOUBLE) AS engine_temp_c,
    CAST(60 + event_id % 50 AS DOUBLE) - {D('5.0')} AS coolant_temp_c,
    CAST(30 + event_id % 9 AS DOUBLE) AS intake_air_temp_c,
    least(value, {D('100.0')}) AS fuel_pct,
    event_type <> '{IGNITION_OFF_SOURCE_TYPE}' AS ignition_on,
    event_id AS seq,
    {ARRIVAL} AS arrival_time,
    CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS odometer_km
  FROM events
"""

TEL = f"tel AS (SELECT *, odometer_km / {D('12.5')} AS fuel_consumed_l FROM ({TEL_BASE}))"

_type_case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_TYPE_MAP.items())
_dtc_case = " ".join(f"WHEN {i} THEN '{c} {d}'" for i, (c, d, _s, _e) in enumerate(S.DTC_CATALOG))
EV = f"""ev AS (
  SELECT
    {uuid_sql("CAST(event_id AS VARCHAR)")} AS event_id,
    {VEHICLE_ID} AS vehicle_id,
    {TRIP_ID} AS trip_id,
    ts AS event_time,
    CASE event_type {_type_case} ELSE event_type END AS event_type,
    CASE WHEN event_type = '{DTC_SOURCE_TYPE}' THEN CASE event_id % {len(S.DTC_CATALOG)} {_dtc_case} END END AS detail,
    event_id AS seq,
    {ARRIVAL} AS arrival_time
  FROM events)"""

VEH = f"""veh AS (
  SELECT
    {VEHICLE_ID} AS vehicle_id,
    CASE WHEN user_id % 2 = 0 THEN 'B ' ELSE 'D ' END || CAST(user_id AS VARCHAR) || ' FLT' AS plate_number,
    CASE WHEN user_id % 2 = 0 THEN 'Toyota' ELSE 'Mitsubishi' END AS brand,
    CASE WHEN user_id % 2 = 0 THEN 'Innova Reborn' ELSE 'Xpander' END AS model,
    CAST(2018 + user_id % 5 AS INTEGER) AS year,
    CASE user_id % 3 WHEN 0 THEN 'delivery_van' WHEN 1 THEN 'city_commuter' ELSE 'long_haul' END AS persona,
    CASE WHEN user_id % 2 = 0 THEN 'Pertamax 95' ELSE 'Pertamax 92' END AS fuel_type,
    CASE WHEN user_id % 2 = 0 THEN 'jakarta' ELSE 'bandung' END AS fleet_group,
    CASE WHEN user_id % 2 = 0 THEN 'Jakarta' ELSE 'Bandung' END AS home_city,
    CASE WHEN user_id % 7 = 0 THEN 'diesel' ELSE 'gasoline' END AS engine_type,
    CASE WHEN user_id % 2 = 0 THEN {D('2.7')} ELSE {D('1.5')} END AS displacement_l,
    CASE WHEN user_id % 2 = 0 THEN {D('55.0')} ELSE {D('42.0')} END AS tank_l,
    CASE WHEN user_id % 2 = 0 THEN {D('31.0')} ELSE {D('25.0')} END AS ambient_c
  FROM (SELECT DISTINCT user_id FROM events))"""

HARSH_LIST = ", ".join(f"'{h}'" for h in S.HARSH_TYPES)


def with_views(body: str, *extra: str) -> str:
    """Prefix a query body with the tel / ev / veh CTEs (plus extra CTEs)."""
    ctes = [TEL, EV, VEH, *extra]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def centi_sum(col: str = "speed_kmh") -> str:
    return f"sum(CAST(round({col} * {D('100.0')}) AS BIGINT))"


def exact_mean(sum_expr: str, n_expr: str) -> str:
    return f"CASE WHEN {n_expr} > 0 THEN CAST({sum_expr} AS DOUBLE) / {D('100.0')} / CAST({n_expr} AS DOUBLE) END"


def bucket(width_s: int, col: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '{width_s} seconds', {col})"


VW = "(PARTITION BY vehicle_id ORDER BY event_time, seq)"
VW_RUN = "(PARTITION BY vehicle_id ORDER BY event_time, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def hav_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = S.EARTH_RADIUS_KM) -> str:
    two = D("2.0")
    return (
        f"{D(repr(2.0 * radius))} * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / {two}), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / {two}), 2)))"
    )


def secs_sql(later: str, earlier: str) -> str:
    return f"(CAST(epoch_us({later}) - epoch_us({earlier}) AS DOUBLE) / {D('1000000.0')})"


def pmod_sql(x: str, n: str) -> str:
    return f"(CASE WHEN ({x}) % {n} < 0 THEN (({x}) % {n} + {n}) % {n} ELSE ({x}) % {n} END)"


def exact_km_sql(x: str) -> str:
    return f"CAST(round({x}, 6) AS DECIMAL(18,6))"
