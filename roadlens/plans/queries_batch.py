"""Batch queries over the driver tables, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.geo import bearing_deg
from roadlens.functions.signals import local_hour, quantize, rush_factor, vehicle_state
from roadlens.operators import aggregates as AG
from roadlens.operators import detect as DT
from roadlens.operators import enrich as EN
from roadlens.operators import motion as M
from roadlens.operators import quality as QA
from roadlens.operators import serve as SV
from roadlens.operators import sessions as SS
from roadlens.operators import windows as W
from roadlens.plans.catalog import register
from roadlens.plans.oracle import (
    HARSH_LIST,
    VEHICLE_ID,
    VW,
    VW_RUN,
    bucket,
    centi_sum,
    exact_km_sql,
    exact_mean,
    hav_sql,
    pmod_sql,
    secs_sql,
    with_views,
)
from roadlens.schemas import EVENT_COLUMNS, TELEMETRY_COLUMNS
from roadlens.sources import decode as DC
from roadlens.sources import sinks as SK
from roadlens.sources import testmap as TM

HOUR = "3600 seconds"
FLEET_2H = ("7200 seconds", "1800 seconds")

# ---------------------------------------------------------------------------
# Per-vehicle tumbling windows
# ---------------------------------------------------------------------------


def _vehicle_speed_sql(width_s: int) -> str:
    return with_views(f"""
SELECT vehicle_id, {bucket(width_s)} AS window_start,
       {exact_mean(centi_sum(), 'count(speed_kmh)')} AS avg_speed_kmh,
       max(speed_kmh) AS max_speed_kmh
FROM tel GROUP BY 1, 2""")


@register("vehicle_speed_windows", _vehicle_speed_sql(60))
def q_vehicle_speed_windows(spark, sf):
    return W.vehicle_speed_windows(TM.telemetry_light(spark, sf))


@register(
    "vehicle_harsh_windows",
    with_views(f"""
SELECT vehicle_id, {bucket(60)} AS window_start,
       CAST(sum(CASE WHEN event_type IN ({HARSH_LIST}) THEN 1 ELSE 0 END) AS BIGINT) AS harsh_event_count
FROM ev GROUP BY 1, 2"""),
)
def q_vehicle_harsh_windows(spark, sf):
    return W.vehicle_harsh_windows(TM.driving_events(spark, sf))


def _vehicle_windows_sql(width_s: int) -> str:
    return with_views(f"""
SELECT vehicle_id, {bucket(width_s)} AS window_start,
       {exact_mean(centi_sum(), 'count(speed_kmh)')} AS avg_speed_kmh,
       max(speed_kmh) AS max_speed_kmh,
       CAST(sum(harsh_flag) AS BIGINT) AS harsh_event_count
FROM (
  SELECT vehicle_id, event_time, speed_kmh, CAST(NULL AS INTEGER) AS harsh_flag FROM tel
  UNION ALL
  SELECT vehicle_id, event_time, CAST(NULL AS DOUBLE), CASE WHEN event_type IN ({HARSH_LIST}) THEN 1 ELSE 0 END FROM ev
) GROUP BY 1, 2""")


@register("vehicle_windows", _vehicle_windows_sql(60))
def q_vehicle_windows(spark, sf):
    return W.vehicle_windows(TM.telemetry_light(spark, sf), TM.driving_events(spark, sf))


@register("vehicle_windows_hourly", _vehicle_windows_sql(3600))
def q_vehicle_windows_hourly(spark, sf):
    return W.vehicle_windows(TM.telemetry_light(spark, sf), TM.driving_events(spark, sf), width=HOUR)


# ---------------------------------------------------------------------------
# Fleet sliding windows
# ---------------------------------------------------------------------------


def _slide_expand(src: str, cols: str, width_s: int, slide_s: int) -> str:
    k = width_s // slide_s
    return (
        f"SELECT {cols}, {bucket(slide_s)} - to_seconds(k * {slide_s}) AS window_start "
        f"FROM (SELECT *, unnest(range(0, {k})) AS k FROM {src})"
    )


def _fleet_speed_sql(width_s: int, slide_s: int) -> str:
    return with_views(f"""
SELECT window_start, window_start + to_seconds({width_s}) AS window_end,
       count(DISTINCT vehicle_id) AS vehicles_active,
       {exact_mean(centi_sum(), 'count(speed_kmh)')} AS fleet_avg_speed_kmh
FROM ({_slide_expand('tel', 'vehicle_id, speed_kmh', width_s, slide_s)})
GROUP BY 1""")


@register("fleet_speed_windows", _fleet_speed_sql(300, 30))
def q_fleet_speed_windows(spark, sf):
    return W.fleet_speed_windows(TM.telemetry_light(spark, sf))


def _fleet_harsh_sql(width_s: int, slide_s: int) -> str:
    return with_views(f"""
SELECT window_start, window_start + to_seconds({width_s}) AS window_end,
       CAST(sum(CASE WHEN event_type IN ({HARSH_LIST}) THEN 1 ELSE 0 END) AS BIGINT) AS total_harsh_events
FROM ({_slide_expand('ev', 'event_type', width_s, slide_s)})
GROUP BY 1""")


@register("fleet_harsh_windows", _fleet_harsh_sql(300, 30))
def q_fleet_harsh_windows(spark, sf):
    return W.fleet_harsh_windows(TM.driving_events(spark, sf))


def _fleet_windows_sql(width_s: int, slide_s: int) -> str:
    u = f"""(SELECT vehicle_id, event_time, speed_kmh, CAST(NULL AS INTEGER) AS harsh_flag FROM tel
  UNION ALL
  SELECT vehicle_id, event_time, CAST(NULL AS DOUBLE), CASE WHEN event_type IN ({HARSH_LIST}) THEN 1 ELSE 0 END FROM ev) u"""
    return with_views(f"""
SELECT CAST(window_start AS DATE) AS day_bucket, window_start,
       window_start + to_seconds({width_s}) AS window_end,
       CASE WHEN count(speed_kmh) > 0 THEN count(DISTINCT CASE WHEN speed_kmh IS NOT NULL THEN vehicle_id END) END AS vehicles_active,
       {exact_mean(centi_sum(), 'count(speed_kmh)')} AS fleet_avg_speed_kmh,
       CAST(sum(harsh_flag) AS BIGINT) AS total_harsh_events
FROM ({_slide_expand(u, 'vehicle_id, speed_kmh, harsh_flag', width_s, slide_s)})
GROUP BY window_start""")


@register("fleet_windows", _fleet_windows_sql(300, 30))
def q_fleet_windows(spark, sf):
    return W.fleet_windows(TM.telemetry_light(spark, sf), TM.driving_events(spark, sf))


@register("fleet_windows_2h", _fleet_windows_sql(7200, 1800))
def q_fleet_windows_2h(spark, sf):
    return W.fleet_windows(TM.telemetry_light(spark, sf), TM.driving_events(spark, sf), *FLEET_2H)


# ---------------------------------------------------------------------------
# Sessions and trips
# ---------------------------------------------------------------------------


SESSION_GAP_TEST_S = 6 * 3600  # the driver data is sparse (one reading per vehicle every few hours)
D60 = "CAST(60.0 AS DOUBLE)"


def _sessions_sql(gap_s: float, on_ignition: bool, keep_idle: bool = False) -> str:
    ign = " OR NOT prev_ign" if on_ignition else ""
    open_ = "(end_time = vlast AND last_ign)" if on_ignition else "(end_time = vlast)"
    where = "" if keep_idle else "WHERE first_ign"
    return with_views(f"""
SELECT g.vehicle_id, start_time, end_time,
       {secs_sql('end_time', 'start_time')} / {D60} AS duration_min,
       CAST(dist AS DOUBLE) AS distance_km, max_speed_kmh, samples, {open_} AS is_open
FROM g JOIN lastv USING (vehicle_id) {where}""",
        f"""s1 AS (SELECT *, lag(event_time) OVER {VW} AS prev_t, lag(lat) OVER {VW} AS prev_lat,
                  lag(lon) OVER {VW} AS prev_lon, lag(ignition_on) OVER {VW} AS prev_ign FROM tel)""",
        f"""s2 AS (SELECT *, (prev_t IS NULL OR {secs_sql('event_time', 'prev_t')} > CAST({float(gap_s)} AS DOUBLE){ign}) AS is_start FROM s1)""",
        f"""s3 AS (SELECT *, sum(CAST(is_start AS BIGINT)) OVER {VW_RUN} AS session_no,
                  CASE WHEN is_start THEN CAST(0 AS DECIMAL(18,6)) ELSE {exact_km_sql(hav_sql('prev_lat', 'prev_lon', 'lat', 'lon'))} END AS step_km FROM s2)""",
        """g AS (SELECT vehicle_id, session_no, min(event_time) AS start_time, max(event_time) AS end_time,
                  sum(step_km) AS dist, max(speed_kmh) AS max_speed_kmh, count(*) AS samples,
                  bool_or(CASE WHEN is_start THEN ignition_on END) AS first_ign,
                  arg_max(ignition_on, event_time) AS last_ign FROM s3 GROUP BY 1, 2)""",
        "lastv AS (SELECT vehicle_id, max(event_time) AS vlast FROM tel GROUP BY 1)",
    )


@register("trip_sessions", _sessions_sql(SESSION_GAP_TEST_S, True))
def q_trip_sessions(spark, sf):
    return SS.trip_sessions(TM.telemetry_light(spark, sf), gap_s=SESSION_GAP_TEST_S)


@register("trip_sessions_5min", _sessions_sql(S.SESSION_GAP_S, True))
def q_trip_sessions_5min(spark, sf):
    return SS.trip_sessions(TM.telemetry_light(spark, sf), gap_s=S.SESSION_GAP_S)


@register("trip_sessions_gap_only", _sessions_sql(SESSION_GAP_TEST_S, False, keep_idle=True))
def q_trip_sessions_gap_only(spark, sf):
    return SS.trip_sessions(TM.telemetry_light(spark, sf), gap_s=SESSION_GAP_TEST_S, on_ignition=False, keep_idle=True)


TRIPS_SQL_BODY = """
SELECT vehicle_id, trip_id, min(event_time) AS start_time, max(event_time) AS end_time,
       arg_min(lat, (event_time, seq)) AS start_lat, arg_min(lon, (event_time, seq)) AS start_lon,
       arg_max(lat, (event_time, seq)) AS end_lat, arg_max(lon, (event_time, seq)) AS end_lon,
       count(*) AS samples,
       round(arg_max(odometer_km, (event_time, seq)) - arg_min(odometer_km, (event_time, seq)), 4) AS distance_km
FROM tel WHERE trip_id IS NOT NULL GROUP BY 1, 2"""


@register("trips_by_id", with_views(TRIPS_SQL_BODY))
def q_trips_by_id(spark, sf):
    return SS.trips_by_id(TM.telemetry(spark, sf))


@register(
    "trip_safety",
    with_views(
        f"""
SELECT tr.vehicle_id, tr.trip_id, start_time, end_time, distance_km,
       coalesce(event_count, 0) AS event_count, coalesce(harsh_events, 0) AS harsh_events,
       CASE WHEN distance_km > 0 THEN CAST(coalesce(harsh_events, 0) AS DOUBLE) * CAST(100.0 AS DOUBLE) / distance_km END AS harsh_per_100km
FROM tr LEFT JOIN ec ON tr.vehicle_id = ec.vehicle_id AND tr.trip_id = ec.trip_id""",
        f"tr AS ({TRIPS_SQL_BODY})",
        f"""ec AS (SELECT vehicle_id, trip_id, count(*) AS event_count,
                  CAST(sum(CASE WHEN event_type IN ({HARSH_LIST}) THEN 1 ELSE 0 END) AS BIGINT) AS harsh_events
                  FROM ev WHERE trip_id IS NOT NULL GROUP BY 1, 2)""",
    ),
)
def q_trip_safety(spark, sf):
    return SS.trip_safety(SS.trips_by_id(TM.telemetry(spark, sf)), TM.driving_events(spark, sf))


# ---------------------------------------------------------------------------
# Row-to-row motion signals
# ---------------------------------------------------------------------------


@register(
    "step_distance",
    with_views(f"""
SELECT vehicle_id, event_time,
       CASE WHEN prev_lat IS NULL THEN CAST(0.0 AS DOUBLE) ELSE round({hav_sql('prev_lat', 'prev_lon', 'lat', 'lon')}, 6) END AS step_distance_km
FROM (SELECT *, lag(lat) OVER {VW} AS prev_lat, lag(lon) OVER {VW} AS prev_lon FROM tel)"""),
)
def q_step_distance(spark, sf):
    return M.step_distance(TM.telemetry_light(spark, sf)).select("vehicle_id", "event_time", "step_distance_km")


@register(
    "acceleration",
    with_views(f"""
SELECT vehicle_id, event_time, speed_kmh,
       CASE WHEN {secs_sql('event_time', 'pt')} > 0
            THEN (speed_kmh - ps) / CAST(3.6 AS DOUBLE) / {secs_sql('event_time', 'pt')} END AS accel_mps2
FROM (SELECT *, lag(speed_kmh) OVER {VW} AS ps, lag(event_time) OVER {VW} AS pt FROM tel)"""),
)
def q_acceleration(spark, sf):
    return M.add_acceleration(TM.telemetry_light(spark, sf)).select("vehicle_id", "event_time", "speed_kmh", "accel_mps2")


@register(
    "heading_delta",
    with_views(
        f"""
SELECT vehicle_id, event_time, effective_heading_deg,
       CASE WHEN moving AND prev_h IS NOT NULL
            THEN {pmod_sql('effective_heading_deg - prev_h + CAST(180.0 AS DOUBLE)', 'CAST(360.0 AS DOUBLE)')} - CAST(180.0 AS DOUBLE) END AS heading_delta_deg
FROM (SELECT *, lag(effective_heading_deg) OVER {VW} AS prev_h FROM h2)""",
        f"h1 AS (SELECT *, speed_kmh / CAST(3.6 AS DOUBLE) > CAST({S.HEADING_MIN_SPEED_MPS} AS DOUBLE) AS moving FROM tel)",
        f"h2 AS (SELECT *, last_value(CASE WHEN moving THEN heading_deg END IGNORE NULLS) OVER {VW_RUN} AS effective_heading_deg FROM h1)",
    ),
)
def q_heading_delta(spark, sf):
    return M.add_heading_delta(TM.telemetry_light(spark, sf)).select(
        "vehicle_id", "event_time", "effective_heading_deg", "heading_delta_deg"
    )


TEST_LIMIT_KMH = float(S.ROAD_CLASS_LIMIT_KMH["arterial"])
OVER_KMH = TEST_LIMIT_KMH + S.OVER_SPEED_MARGIN_KMH


@register(
    "sustained_overspeed",
    with_views(
        f"""
SELECT vehicle_id, event_time, speed_kmh,
       CASE WHEN c THEN {secs_sql('event_time', 'anchor')} ELSE CAST(0.0 AS DOUBLE) END AS overspeed_s
FROM (SELECT *, max(CASE WHEN NOT c OR pt IS NULL THEN event_time END) OVER {VW_RUN} AS anchor FROM o1)""",
        f"o1 AS (SELECT *, coalesce(speed_kmh > CAST({OVER_KMH} AS DOUBLE), false) AS c, lag(event_time) OVER {VW} AS pt FROM tel)",
    ),
)
def q_sustained_overspeed(spark, sf):
    t = TM.telemetry_light(spark, sf)
    return M.add_sustained_seconds(t, F.col("speed_kmh") > F.lit(OVER_KMH), "overspeed_s").select(
        "vehicle_id", "event_time", "speed_kmh", "overspeed_s"
    )


@register(
    "rising_edges",
    with_views(f"""
SELECT vehicle_id, event_time, speed_kmh FROM (
  SELECT *, lag(c) OVER {VW} AS pc FROM (SELECT *, coalesce(speed_kmh > CAST({OVER_KMH} AS DOUBLE), false) AS c FROM tel))
WHERE c AND NOT coalesce(pc, false)"""),
)
def q_rising_edges(spark, sf):
    t = TM.telemetry_light(spark, sf)
    return (
        M.add_rising_edge(t, F.col("speed_kmh") > F.lit(OVER_KMH), "edge")
        .where("edge")
        .select("vehicle_id", "event_time", "speed_kmh")
    )


# ---------------------------------------------------------------------------
# Serving queries
# ---------------------------------------------------------------------------


HISTORY_START, HISTORY_END = "2024-01-08 00:00:00", "2024-01-15 00:00:00"
ISO_FMT = "'%Y-%m-%dT%H:%M:%SZ'"

_ORD = "(event_time, seq)"
LATEST_SQL = f"""SELECT vehicle_id, arg_max(lat, {_ORD}) AS lat, arg_max(lon, {_ORD}) AS lon,
       arg_max(speed_kmh, {_ORD}) AS speed_kmh, arg_max(engine_temp_c, {_ORD}) AS engine_temp_c,
       strftime(max(event_time), {ISO_FMT}) AS updated_at
FROM tel GROUP BY 1"""


def scalar(df, col: str, fn=F.max):
    """One aggregate value of ``df`` as a scalar subquery of the same plan."""
    return df.agg(fn(col).alias("v")).scalar()


@register("latest_state", with_views(LATEST_SQL))
def q_latest_state(spark, sf):
    return SV.latest_state(TM.telemetry_light(spark, sf))


@register("latest_blobs", with_views(f"""
SELECT '{S.LATEST_KEY_PREFIX}' || vehicle_id AS key,
       to_json({{'vehicle_id': vehicle_id, 'lat': lat, 'lon': lon, 'speed_kmh': speed_kmh,
                 'engine_temp_c': engine_temp_c, 'updated_at': updated_at}})::VARCHAR AS value
FROM ({LATEST_SQL})"""))
def q_latest_blobs(spark, sf):
    return SV.latest_blobs(SV.latest_state(TM.telemetry_light(spark, sf)))


SNAPSHOT_SHARDS = 16


@register("fleet_snapshot", with_views(f"""
SELECT shard, CAST(count(*) AS INTEGER) AS vehicle_count,
       to_json({{'type': '{S.SNAPSHOT_TYPE}', 'ts': strftime((SELECT max(event_time) FROM tel), {ISO_FMT}),
                 'vehicles': list({{'id': vehicle_id, 'vehicle_id': vehicle_id, 'lat': lat, 'lon': lon, 'speed_kmh': speed_kmh,
                                   'engine_temp_c': engine_temp_c, 'updated_at': updated_at}} ORDER BY vehicle_id)}})::VARCHAR AS message
FROM (SELECT *, CAST(('0x' || substr(md5(vehicle_id), 1, 8))::BIGINT % {SNAPSHOT_SHARDS} AS INTEGER) AS shard FROM ({LATEST_SQL}))
GROUP BY shard"""))
def q_fleet_snapshot(spark, sf):
    t = TM.telemetry_light(spark, sf)
    return SV.fleet_snapshot(SV.latest_state(t), scalar(t, "event_time"), SNAPSHOT_SHARDS)


@register("vehicles_reporting", with_views(f"SELECT count(lat) AS vehicles_reporting FROM ({LATEST_SQL})"))
def q_vehicles_reporting(spark, sf):
    return SV.vehicles_reporting(SV.latest_state(TM.telemetry_light(spark, sf)))


def _top_sql(src: str, cols: str, n: int, order: str) -> str:
    return f"""SELECT {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY {order}) AS rn FROM {src}) WHERE rn <= {n}"""


@register("last_points", with_views(_top_sql("tel", "vehicle_id, event_time, speed_kmh, engine_temp_c", S.LIVE_POINTS, "event_time DESC, seq DESC")))
def q_last_points(spark, sf):
    return SV.last_points(TM.telemetry_light(spark, sf))


LATEST_N = 20


@register("latest_n", with_views(_top_sql("tel", "vehicle_id, event_time, lat, lon, speed_kmh", LATEST_N, "event_time DESC, seq DESC")))
def q_latest_n(spark, sf):
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "seq", "lat", "lon", "speed_kmh")
    return SV.top_n_per_key(t, LATEST_N).drop("seq")


def _vwh_cte() -> str:
    """The hourly vehicle-window rollup as a CTE named vwh."""
    body = _vehicle_windows_sql(3600)
    head = with_views("")
    return f"vwh AS ({body[len(head):]})"


@register("latest_windows", with_views(_top_sql("vwh", "*", 60, "window_start DESC").replace("SELECT * FROM", "SELECT * EXCLUDE (rn) FROM", 1), _vwh_cte()))
def q_latest_windows(spark, sf):
    return SV.latest_windows(q_vehicle_windows_hourly(spark, sf), 60)


@register("history_range", with_views(f"""
SELECT vehicle_id, event_time, lat, lon, speed_kmh FROM tel
WHERE event_time >= TIMESTAMP '{HISTORY_START}' AND event_time < TIMESTAMP '{HISTORY_END}'"""))
def q_history_range(spark, sf):
    t = TM.telemetry_light(spark, sf)
    return SV.history(t, HISTORY_START, HISTORY_END).select("vehicle_id", "event_time", "lat", "lon", "speed_kmh")


@register("event_history", with_views(f"""
SELECT vehicle_id, event_time, event_type, detail FROM ev
WHERE event_time >= TIMESTAMP '{HISTORY_START}' AND event_time <= TIMESTAMP '{HISTORY_END}'"""))
def q_event_history(spark, sf):
    ev = TM.driving_events(spark, sf)
    return SV.history(ev, HISTORY_START, HISTORY_END, closed="both").select("vehicle_id", "event_time", "event_type", "detail")


@register("recent_window", with_views("""
SELECT t.vehicle_id, t.event_time, t.speed_kmh, t.lat, t.lon FROM tel t
JOIN (SELECT vehicle_id, max(event_time) AS last_t FROM tel GROUP BY 1) m USING (vehicle_id)
WHERE t.event_time >= m.last_t - to_seconds(720)"""))
def q_recent_window(spark, sf):
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "speed_kmh", "lat", "lon")
    return SV.recent_window(t, 12)


FLEET_GROUPS = ["jakarta", "bandung"]


def _group_mean_sql(g: str) -> str:
    s = f"sum(CASE WHEN fleet_group = '{g}' THEN CAST(round(speed_kmh * CAST(100.0 AS DOUBLE)) AS BIGINT) END)"
    n = f"count(CASE WHEN fleet_group = '{g}' THEN speed_kmh END)"
    return f"{exact_mean(s, n)} AS {g}"


@register("series_aligned", with_views(f"""
SELECT {bucket(3600)} AS window_start, {', '.join(_group_mean_sql(g) for g in FLEET_GROUPS)}
FROM tel JOIN veh USING (vehicle_id) GROUP BY 1"""))
def q_series_aligned(spark, sf):
    t = TM.telemetry_light(spark, sf).join(TM.vehicles(spark, sf).select("vehicle_id", "fleet_group"), "vehicle_id")
    t = t.withColumn("window_start", F.window("event_time", HOUR).start)
    return SV.align_series(t, "window_start", "fleet_group", FLEET_GROUPS, W.exact_mean(F.sum(W.centi()), F.count("speed_kmh")))


@register("kpi_listing", with_views(
    "SELECT * FROM vwh ORDER BY window_start DESC, vehicle_id LIMIT 10", _vwh_cte()))
def q_kpi_listing(spark, sf):
    return SV.peek(q_vehicle_windows_hourly(spark, sf), 10, [F.col("window_start").desc(), "vehicle_id"])


def _fleet2h_cte() -> str:
    body = _fleet_windows_sql(7200, 1800)
    return f"fw AS ({body[len(with_views('')):]})"


@register("fleet_latest_day", with_views(
    "SELECT * FROM fw WHERE day_bucket = (SELECT max(day_bucket) FROM fw)", _fleet2h_cte()))
def q_fleet_latest_day(spark, sf):
    return SV.latest_day(q_fleet_windows_2h(spark, sf))


@register("extents", with_views(f"""
SELECT vehicle_id, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
       min(event_time) AS time_min, max(event_time) AS time_max,
       min(speed_kmh) * CAST(0.9 AS DOUBLE) AS speed_lo, max(speed_kmh) * CAST(1.1 AS DOUBLE) AS speed_hi
FROM tel GROUP BY 1"""))
def q_extents(spark, sf):
    return SV.extents(TM.telemetry_light(spark, sf))


@register("last_not_null", with_views("""
SELECT vehicle_id, arg_max(harsh_event_count, window_start) AS last_harsh_event_count, max(window_start) AS last_window_start
FROM vwh WHERE harsh_event_count IS NOT NULL GROUP BY 1""", _vwh_cte()))
def q_last_not_null(spark, sf):
    return SV.last_not_null(q_vehicle_windows_hourly(spark, sf), "harsh_event_count")


@register("distinct_vehicles", with_views("SELECT DISTINCT vehicle_id FROM tel"))
def q_distinct_vehicles(spark, sf):
    return SV.distinct_vehicles(TM.telemetry_light(spark, sf))


@register("table_counts", with_views("SELECT CAST(event_time AS DATE) AS day, count(*) AS rows FROM tel GROUP BY 1"))
def q_table_counts(spark, sf):
    return SV.table_counts(TM.telemetry_light(spark, sf), F.to_date("event_time").alias("day"))


@register("silent_vehicles", with_views("""
SELECT * FROM veh WHERE vehicle_id NOT IN (
  SELECT vehicle_id FROM tel WHERE event_time >= (SELECT max(event_time) FROM tel) - INTERVAL 1 DAY)"""))
def q_silent_vehicles(spark, sf):
    t = TM.telemetry_light(spark, sf)
    cutoff = F.timestamp_add("DAY", F.lit(-1), scalar(t, "event_time"))
    recent = SV.latest_state(t.where(F.col("event_time") >= cutoff))
    return SV.silent_vehicles(TM.vehicles(spark, sf), recent)


@register("reporting_vehicles", with_views("""
SELECT * FROM veh WHERE vehicle_id IN (
  SELECT vehicle_id FROM tel WHERE event_time >= (SELECT max(event_time) FROM tel) - INTERVAL 1 DAY)"""))
def q_reporting_vehicles(spark, sf):
    t = TM.telemetry_light(spark, sf)
    cutoff = F.timestamp_add("DAY", F.lit(-1), scalar(t, "event_time"))
    recent = SV.latest_state(t.where(F.col("event_time") >= cutoff))
    return SV.reporting_vehicles(TM.vehicles(spark, sf), recent)


@register("stale_vehicles", with_views(f"""
SELECT vehicle_id, updated_at,
       CAST(epoch_us((SELECT max(event_time) FROM tel)) AS DOUBLE) / 1e6 - CAST(epoch_us(strptime(updated_at, {ISO_FMT})) AS DOUBLE) / 1e6 AS age_s
FROM ({LATEST_SQL})
WHERE CAST(epoch_us((SELECT max(event_time) FROM tel)) AS DOUBLE) / 1e6 - CAST(epoch_us(strptime(updated_at, {ISO_FMT})) AS DOUBLE) / 1e6 > {float(S.FRESHNESS_MAX_AGE_S)}"""))
def q_stale_vehicles(spark, sf):
    t = TM.telemetry_light(spark, sf)
    return SV.stale_vehicles(SV.latest_state(t), scalar(t, "event_time"))


@register("null_counts", with_views("""
SELECT count(*) FILTER (WHERE avg_speed_kmh IS NULL) AS avg_speed_kmh_nulls,
       count(*) FILTER (WHERE max_speed_kmh IS NULL) AS max_speed_kmh_nulls,
       count(*) FILTER (WHERE harsh_event_count IS NULL) AS harsh_event_count_nulls
FROM vwh""", _vwh_cte()))
def q_null_counts(spark, sf):
    return SV.null_counts(q_vehicle_windows_hourly(spark, sf), ["avg_speed_kmh", "max_speed_kmh", "harsh_event_count"])


def _fleet5_cte() -> str:
    body = _fleet_speed_sql(300, 30)
    return f"fs AS ({body[len(with_views('')):]})"


@register("missing_slots", with_views("""
SELECT slot_start FROM (
  SELECT unnest(generate_series((SELECT min(window_start) FROM fs), (SELECT max(window_start) FROM fs), INTERVAL 30 SECOND)) AS slot_start)
WHERE slot_start NOT IN (SELECT window_start FROM fs)""", _fleet5_cte()))
def q_missing_slots(spark, sf):
    return SV.missing_slots(q_fleet_speed_windows(spark, sf), 30)


# ---------------------------------------------------------------------------
# Event detection
# ---------------------------------------------------------------------------


def _dbl(x) -> str:
    return f"CAST({float(x)} AS DOUBLE)"


def _rules_ctes(limit_kmh: float | str, src: str = "tel") -> list[str]:
    """Rule inputs per reading; ``limit_kmh`` is a constant or a SQL column."""
    if isinstance(limit_kmh, str):
        over = f"(CAST({limit_kmh} AS DOUBLE) + {_dbl(S.OVER_SPEED_MARGIN_KMH)})"
    else:
        over = _dbl(limit_kmh + S.OVER_SPEED_MARGIN_KMH)
    c180, c360 = _dbl(180), _dbl(360)
    return [
        f"""d1 AS (SELECT *, lag(speed_kmh) OVER {VW} AS ps, lag(event_time) OVER {VW} AS pt,
                  speed_kmh / {_dbl(3.6)} > {_dbl(S.HEADING_MIN_SPEED_MPS)} AS moving FROM {src})""",
        f"""d2 AS (SELECT *, CASE WHEN {secs_sql('event_time', 'pt')} > 0
                       THEN (speed_kmh - ps) / {_dbl(3.6)} / {secs_sql('event_time', 'pt')} END AS accel,
                  last_value(CASE WHEN moving THEN heading_deg END IGNORE NULLS) OVER {VW_RUN} AS eh,
                  coalesce(speed_kmh > {over}, false) AS os_raw,
                  coalesce(ignition_on AND speed_kmh / {_dbl(3.6)} < {_dbl(S.IDLE_SPEED_MPS)}, false) AS idle_raw FROM d1)""",
        f"""d3 AS (SELECT *, lag(eh) OVER {VW} AS peh,
                  max(CASE WHEN NOT os_raw OR pt IS NULL THEN event_time END) OVER {VW_RUN} AS os_anchor,
                  max(CASE WHEN NOT idle_raw OR pt IS NULL THEN event_time END) OVER {VW_RUN} AS idle_anchor FROM d2)""",
        f"""d4 AS (SELECT *, CASE WHEN moving AND peh IS NOT NULL THEN {pmod_sql(f'eh - peh + {c180}', c360)} - {c180} END AS hd,
                  CASE WHEN os_raw THEN {secs_sql('event_time', 'os_anchor')} ELSE {_dbl(0)} END AS os_s,
                  CASE WHEN idle_raw THEN {secs_sql('event_time', 'idle_anchor')} ELSE {_dbl(0)} END AS idle_s FROM d3)""",
        f"""d5 AS (SELECT *,
                  coalesce(accel > {_dbl(S.HARSH_ACCEL_MPS2)}, false) AS c_harsh_accel,
                  coalesce(accel < {_dbl(S.HARSH_BRAKE_MPS2)}, false) AS c_harsh_braking,
                  coalesce(hd IS NOT NULL AND speed_kmh > {_dbl(S.HARSH_CORNER_SPEED_KMH)} AND abs(hd) > {_dbl(S.HARSH_CORNER_HEADING_DEG)}, false) AS c_harsh_cornering,
                  coalesce(speed_kmh >= {over} AND os_s >= {_dbl(S.OVER_SPEED_SUSTAINED_S)}, false) AS c_over_speed,
                  coalesce(idle_s >= {_dbl(S.IDLING_THRESHOLD_S)}, false) AS c_idling FROM d4)""",
        "d6 AS (SELECT *, " + ", ".join(f"lag(c_{r}) OVER {VW} AS p_{r}" for r in DT.RULES) + " FROM d5)",
    ]


def _detect_sql(limit_kmh: float | str, src: str = "tel", *extra: str) -> str:
    parts = [
        f"SELECT vehicle_id, trip_id, event_time, '{r}' AS event_type FROM d6 WHERE c_{r} AND NOT coalesce(p_{r}, false)"
        for r in DT.RULES
    ]
    parts.append(
        f"""SELECT vehicle_id, trip_id, min(event_time) AS event_time, 'fuel_low' AS event_type FROM tel
        WHERE fuel_pct < {_dbl(S.FUEL_LOW_PCT)} AND trip_id IS NOT NULL GROUP BY vehicle_id, trip_id"""
    )
    return with_views("\nUNION ALL\n".join(parts), *extra, *_rules_ctes(limit_kmh, src))


@register("detect_events", _detect_sql(TEST_LIMIT_KMH))
def q_detect_events(spark, sf):
    return DT.detect_events(TM.telemetry_light(spark, sf), limit_kmh=TEST_LIMIT_KMH)


def _set_sql(prefix: str) -> str:
    items = ", ".join(f"CASE WHEN {prefix}{r} THEN '{r}' END" for r in DT.RULES)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


@register("condition_changes", with_views(f"""
SELECT vehicle_id, event_time, array_to_string(nw, ',') AS newly_active, array_to_string(gone, ',') AS declined FROM (
  SELECT vehicle_id, event_time,
         list_filter(cur, lambda x: NOT list_contains(prv, x)) AS nw,
         list_filter(prv, lambda x: NOT list_contains(cur, x)) AS gone
  FROM (SELECT *, {_set_sql('c_')} AS cur, {_set_sql('coalesce(p_').replace('THEN', ', false) THEN')} AS prv FROM d6))
WHERE len(nw) > 0 OR len(gone) > 0""", *_rules_ctes(TEST_LIMIT_KMH)))
def q_condition_changes(spark, sf):
    return DT.condition_changes(TM.telemetry_light(spark, sf), limit_kmh=TEST_LIMIT_KMH)


@register("ignition_events", with_views(f"""
SELECT vehicle_id, event_time, CASE WHEN ignition_on AND NOT coalesce(pi, false) THEN 'ignition_on' ELSE 'ignition_off' END AS event_type
FROM (SELECT *, lag(ignition_on) OVER {VW} AS pi FROM tel)
WHERE (ignition_on AND NOT coalesce(pi, false)) OR (NOT ignition_on AND coalesce(pi, false))"""))
def q_ignition_events(spark, sf):
    return DT.ignition_events(TM.telemetry_light(spark, sf))


TEMP_LIMIT_C, TEMP_SUSTAIN_S = 100.0, 30.0


@register("temp_alerts", with_views(f"""
SELECT vehicle_id, event_time, engine_temp_c, hot_s FROM (
  SELECT *, lag(al) OVER {VW} AS pal FROM (
    SELECT *, hot_s >= {_dbl(TEMP_SUSTAIN_S)} AS al FROM (
      SELECT *, CASE WHEN c THEN {secs_sql('event_time', 'anchor')} ELSE {_dbl(0)} END AS hot_s FROM (
        SELECT *, max(CASE WHEN NOT c OR pt IS NULL THEN event_time END) OVER {VW_RUN} AS anchor FROM (
          SELECT *, coalesce(engine_temp_c > {_dbl(TEMP_LIMIT_C)}, false) AS c, lag(event_time) OVER {VW} AS pt FROM tel)))))
WHERE al AND NOT coalesce(pal, false)"""))
def q_temp_alerts(spark, sf):
    return DT.temp_alerts(TM.telemetry_light(spark, sf), TEMP_LIMIT_C, TEMP_SUSTAIN_S)


# ---------------------------------------------------------------------------
# Enrichment and lookups
# ---------------------------------------------------------------------------


@register("enrich_vehicle", with_views("""
SELECT t.vehicle_id, t.event_time, t.speed_kmh, v.fleet_group, v.home_city, v.engine_type, v.tank_l
FROM tel t LEFT JOIN veh v USING (vehicle_id)"""))
def q_enrich_vehicle(spark, sf):
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "speed_kmh")
    v = TM.vehicles(spark, sf).select("vehicle_id", "fleet_group", "home_city", "engine_type", "tank_l")
    return EN.enrich_vehicle(t, v)


def _values(rows: list[tuple], cols: str) -> str:
    def lit(x):
        if isinstance(x, str):
            return "'" + x.replace("'", "''") + "'"
        if isinstance(x, (list, tuple)):
            return "[" + ", ".join(lit(y) for y in x) + "]"
        return repr(float(x)) if isinstance(x, float) else str(x)

    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({cols}))"


CAT_CTE = "cat AS " + _values([tuple(r) for r in S.DTC_CATALOG], "code, description, severity, engine_types")
BOX_CTE = "boxes AS " + _values([(c, *b) for c, b in S.CITY_BOXES.items()], "city, lat_min, lat_max, lon_min, lon_max")


@register("enrich_dtc", with_views("""
SELECT e.event_id, e.vehicle_id, e.event_time, split_part(e.detail, ' ', 1) AS code, cat.description, cat.severity,
       v.engine_type, coalesce(list_contains(cat.engine_types, v.engine_type), false) AS is_plausible
FROM ev e LEFT JOIN cat ON split_part(e.detail, ' ', 1) = cat.code LEFT JOIN veh v ON e.vehicle_id = v.vehicle_id
WHERE e.detail IS NOT NULL""", CAT_CTE))
def q_enrich_dtc(spark, sf):
    return EN.enrich_dtc(TM.driving_events(spark, sf), EN.dtc_catalog(spark), TM.vehicles(spark, sf))


@register("geofence_violations", with_views("""
SELECT t.vehicle_id, t.event_time, t.lat, t.lon, v.home_city
FROM tel t LEFT JOIN veh v USING (vehicle_id) LEFT JOIN boxes b ON v.home_city = b.city
WHERE NOT coalesce(t.lat BETWEEN b.lat_min AND b.lat_max AND t.lon BETWEEN b.lon_min AND b.lon_max, false)""", BOX_CTE))
def q_geofence_violations(spark, sf):
    return EN.geofence_violations(TM.telemetry_light(spark, sf), TM.vehicles(spark, sf), EN.city_boxes(spark))


@register("vehicle_state", with_views(f"""
SELECT vehicle_id, event_time,
       CASE WHEN NOT ignition_on THEN 'idle' WHEN speed_kmh < {_dbl(S.IDLE_SPEED_MPS * 3.6)} THEN 'stopped' ELSE 'driving' END AS state
FROM tel"""))
def q_vehicle_state(spark, sf):
    return TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", vehicle_state().alias("state"))


_rush = " OR ".join(f"(h >= {lo} AND h < {hi})" for lo, hi in S.RUSH_HOURS)


@register("rush_factor", with_views(f"""
SELECT vehicle_id, event_time, h AS local_hour,
       CASE WHEN {_rush} THEN {_dbl(S.RUSH_FACTOR)} ELSE {_dbl(S.NON_RUSH_FACTOR)} END AS rush_factor
FROM (SELECT *, CAST(hour(event_time + INTERVAL 7 HOUR) AS INTEGER) AS h FROM tel)"""))
def q_rush_factor(spark, sf):
    t = TM.telemetry_light(spark, sf)
    return t.select("vehicle_id", "event_time", local_hour().alias("local_hour"), rush_factor().alias("rush_factor"))


def _nodes_cte(spacing: float = EN.NODE_SPACING_DEG) -> str:
    parts = []
    for city, (a, b, c, d) in S.CITY_BOXES.items():
        ni = int(round((b - a) / spacing)) + 1
        nj = int(round((d - c) / spacing)) + 1
        parts.append(f"SELECT '{city}' AS city, r // {nj} AS i, r % {nj} AS j FROM range({ni * nj}) t(r)")
    lattice = " UNION ALL ".join(parts)
    return f"""nodes AS (SELECT city, i, j,
      CASE WHEN i % 10 = 0 THEN 'toll' WHEN i % 4 = 0 OR j % 4 = 0 THEN 'arterial'
           WHEN (i + j) % 3 = 0 THEN 'residential' ELSE 'local' END AS road_class,
      CASE WHEN i % 6 = 0 AND j % 6 = 0 THEN 30 END AS override FROM ({lattice}))"""


def _city_sql() -> str:
    return "CASE " + " ".join(
        f"WHEN lat BETWEEN {_dbl(a)} AND {_dbl(b)} AND lon BETWEEN {_dbl(c)} AND {_dbl(d)} THEN '{city}'"
        for city, (a, b, c, d) in S.CITY_BOXES.items()
    ) + " END"


def _lattice_sql(col: str, idx: int, spacing: float = EN.NODE_SPACING_DEG) -> str:
    cases = " ".join(
        f"WHEN city = '{city}' THEN CAST(floor(({col} - {_dbl(box[idx])}) / {_dbl(spacing)} + {_dbl(0.5)}) AS BIGINT)"
        for city, box in S.CITY_BOXES.items()
    )
    return f"CASE {cases} END"


_class_limit = "CASE road_class " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.ROAD_CLASS_LIMIT_KMH.items()) + " END"
ASSIGN_SQL_BODY = f"""
SELECT p.vehicle_id, p.event_time, p.speed_kmh, p.city, n.road_class,
       CAST(coalesce(n.override, {_class_limit.replace('road_class', 'n.road_class')}) AS INTEGER) AS speed_limit_kmh
FROM (SELECT *, {_lattice_sql('lat', 0)} AS i, {_lattice_sql('lon', 2)} AS j FROM (SELECT *, {_city_sql()} AS city FROM tel)) p
LEFT JOIN nodes n ON p.city = n.city AND p.i = n.i AND p.j = n.j"""


@register("assign_limit", with_views(ASSIGN_SQL_BODY, _nodes_cte()))
def q_assign_limit(spark, sf):
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "speed_kmh", "lat", "lon")
    return EN.assign_limit(t, EN.road_nodes(spark)).select(
        "vehicle_id", "event_time", "speed_kmh", "city", "road_class", "speed_limit_kmh"
    )


# ---------------------------------------------------------------------------
# Quality and counters
# ---------------------------------------------------------------------------


def _gear_sql() -> str:
    b = S.GEAR_BANDS_KMH
    whens = " ".join(f"WHEN speed_kmh < {_dbl(x)} THEN {i}" for i, x in enumerate(b, start=1))
    return f"CASE {whens} ELSE {len(b) + 1} END"


_MAF = f"displacement_l * (CAST(rpm AS DOUBLE) / {_dbl(60)}) * (throttle_pct / {_dbl(100)}) * {_dbl(S.AIR_DENSITY_G_PER_L)} * {_dbl(S.MAF_FILL_FACTOR)}"
_FACTOR = "CASE " + " ".join(f"WHEN fuel_type = '{k}' THEN {_dbl(v)}" for k, v in S.FUEL_TYPE_FACTOR.items() if v != 1.0) + f" ELSE {_dbl(1.0)} END"
_LPS = f"greatest(({_MAF}) / {_dbl(S.AIR_FUEL_RATIO)} / {_dbl(S.FUEL_DENSITY_G_PER_L)} * {_FACTOR}, CASE WHEN rpm <= {S.IDLE_RPM} THEN {_dbl(S.IDLE_FUEL_FLOOR_LPS)} ELSE {_dbl(0)} END)"


_THROTTLE_G = f"displacement_l * (CAST(rpm AS DOUBLE) / {_dbl(60)}) * ({_dbl(QA.THROTTLE_HALF_PCT)} / {_dbl(100)}) * {_dbl(S.AIR_DENSITY_G_PER_L)} * {_dbl(S.MAF_FILL_FACTOR)}"
_THROTTLE_LPS = f"({_THROTTLE_G}) / {_dbl(S.AIR_FUEL_RATIO)} / {_dbl(S.FUEL_DENSITY_G_PER_L)}"


def _ecu_sql(src: str, *ctes: str) -> str:
    return with_views(f"""
SELECT vehicle_id, event_time, gear_ok, maf_ok, intake_ok, fuel_ok FROM (
  SELECT vehicle_id, event_time,
         gear = {_gear_sql()} AS gear_ok,
         abs(maf_g_per_s - ({_MAF})) <= {_dbl(QA.MAF_HALF + QA.FLOAT_ROOM)} + {_THROTTLE_G} AS maf_ok,
         abs(intake_air_temp_c - (ambient_c + least({_dbl(S.INTAKE_MAX_RISE_C)}, rpm / {_dbl(S.INTAKE_RPM_DIVISOR)}))) <= {_dbl(QA.TEMP_HALF + QA.FLOAT_ROOM)} AS intake_ok,
         CASE WHEN pt IS NOT NULL THEN abs(fuel_consumed_l - pf - ({_LPS}) * {secs_sql('event_time', 'pt')})
           <= {_dbl(2.0 * QA.FUEL_HALF_L + QA.FLOAT_ROOM)} + {_THROTTLE_LPS} * {secs_sql('event_time', 'pt')} END AS fuel_ok
  FROM (SELECT t.*, v.displacement_l, v.ambient_c, v.fuel_type,
               lag(t.event_time) OVER (PARTITION BY t.vehicle_id ORDER BY t.event_time, t.seq) AS pt,
               lag(t.fuel_consumed_l) OVER (PARTITION BY t.vehicle_id ORDER BY t.event_time, t.seq) AS pf
        FROM {src} t LEFT JOIN veh v USING (vehicle_id)))
WHERE coalesce(NOT gear_ok OR NOT maf_ok OR NOT intake_ok OR NOT coalesce(fuel_ok, true), true)""", *ctes)


@register("ecu_audit", _ecu_sql("tel"))
def q_ecu_audit(spark, sf):
    return QA.ecu_audit(TM.telemetry(spark, sf), TM.vehicles(spark, sf))


# A feed that follows the engine rules but for one kind of fault per source type.
_FEED_CTES = (
    f"""f0 AS (SELECT {VEHICLE_ID} AS vehicle_id, ts AS event_time, event_id AS seq, value AS speed_kmh, event_type AS kind,
          CAST(800 + (event_id * 13) % 5700 AS INTEGER) AS rpm,
          CAST((event_id * 7919) % 100003 AS DOUBLE) / {_dbl(1000.03)} AS throttle_pct FROM events)""",
    "f1 AS (SELECT f0.*, v.displacement_l, v.ambient_c, v.fuel_type, lag(event_time) OVER (PARTITION BY vehicle_id ORDER BY event_time, seq) AS pt FROM f0 JOIN veh v USING (vehicle_id))",
    f"f2 AS (SELECT *, {_MAF} AS maf, CAST(round(coalesce(({_LPS}) * {secs_sql('event_time', 'pt')}, {_dbl(0)}), 9) AS DECIMAL(28,9)) AS step FROM f1)",
    f"""feed AS (SELECT vehicle_id, event_time, seq, speed_kmh, rpm,
          {_gear_sql()} + CASE WHEN kind = '{TM.BROKEN_GEAR}' THEN 1 ELSE 0 END AS gear,
          round(throttle_pct, 2) AS throttle_pct,
          round(maf + CASE WHEN kind = '{TM.BROKEN_MAF}' THEN {_dbl(1)} ELSE {_dbl(0)} END, 3) AS maf_g_per_s,
          round(ambient_c + least({_dbl(S.INTAKE_MAX_RISE_C)}, rpm / {_dbl(S.INTAKE_RPM_DIVISOR)}) + CASE WHEN kind = '{TM.BROKEN_INTAKE}' THEN {_dbl(1)} ELSE {_dbl(0)} END, 2) AS intake_air_temp_c,
          round(CAST(sum(step) OVER (PARTITION BY vehicle_id ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING) AS DOUBLE)
                + CASE WHEN kind = '{TM.BROKEN_FUEL}' THEN {_dbl(50)} ELSE {_dbl(0)} END, 4) AS fuel_consumed_l FROM f2)""",
)


@register("ecu_audit_feed", _ecu_sql("feed", *_FEED_CTES))
def q_ecu_audit_feed(spark, sf):
    return QA.ecu_audit(TM.ecu_feed(spark, sf), TM.vehicles(spark, sf))


@register("late_records", with_views(f"""
SELECT vehicle_id, event_time, arrival_time, window_end, {secs_sql('arrival_time', 'window_end')} AS late_seconds
FROM (SELECT *, {bucket(60)} + to_seconds(60) AS window_end FROM tel)
WHERE arrival_time > window_end + to_seconds(75)"""))
def q_late_records(spark, sf):
    return QA.late_records(TM.telemetry_light(spark, sf))


@register("fuel_usage", with_views("""
SELECT vehicle_id, trip_id,
       round(arg_max(fuel_consumed_l, (event_time, seq)) - arg_min(fuel_consumed_l, (event_time, seq)), 4) AS fuel_used_l,
       round(arg_min(fuel_pct, (event_time, seq)) - arg_max(fuel_pct, (event_time, seq)), 3) AS fuel_pct_drop
FROM tel WHERE trip_id IS NOT NULL GROUP BY 1, 2"""))
def q_fuel_usage(spark, sf):
    return QA.fuel_usage(TM.telemetry(spark, sf))


@register("refuels", with_views(f"""
SELECT vehicle_id, event_time, pf AS fuel_before, fuel_pct AS fuel_after
FROM (SELECT *, lag(fuel_pct) OVER {VW} AS pf FROM tel)
WHERE pf < {_dbl(S.REFUEL_BELOW_PCT)} AND fuel_pct > pf"""))
def q_refuels(spark, sf):
    return QA.refuels(TM.telemetry_light(spark, sf))


RESAMPLE_STEP_S = 3600


def _resample_sql(step_s: int) -> str:
    us = step_s * 1_000_000
    frac = "CAST(g_us - p_us AS DOUBLE) / CAST(c_us - p_us AS DOUBLE)"
    return with_views(f"""
SELECT vehicle_id, make_timestamp(g_us) AS grid_time,
       round(plat + (lat - plat) * {frac}, 6) AS lat, round(plon + (lon - plon) * {frac}, 6) AS lon,
       round(ps + (speed_kmh - ps) * {frac}, 2) AS speed_kmh
FROM (SELECT *, unnest(generate_series(g0, g1, {us})) AS g_us FROM (
  SELECT *, (p_us // {us} + 1) * {us} AS g0, (c_us // {us}) * {us} AS g1 FROM (
    SELECT vehicle_id, lat, lon, speed_kmh, epoch_us(event_time) AS c_us,
           lag(lat) OVER {VW} AS plat, lag(lon) OVER {VW} AS plon, lag(speed_kmh) OVER {VW} AS ps,
           epoch_us(lag(event_time) OVER {VW}) AS p_us FROM tel) WHERE p_us IS NOT NULL) WHERE g1 >= g0)""")


@register("resample", _resample_sql(RESAMPLE_STEP_S))
def q_resample(spark, sf):
    return QA.resample(TM.telemetry_light(spark, sf), RESAMPLE_STEP_S)


# ---------------------------------------------------------------------------
# Decoding and keyed sinks
# ---------------------------------------------------------------------------


TEL_COLS = ", ".join(TELEMETRY_COLUMNS)
EV_COLS = ", ".join(EVENT_COLUMNS)
# Feed messages for the decode tests: telemetry JSON, except two source
# event types whose message is the source ``props`` object (valid JSON without
# the required fields) or that object behind an unterminated ``{"ts": ``.
MISSING_SRC, BROKEN_SRC = "error", "purchase"


def feed_messages(spark, sf):
    t = TM.telemetry(spark, sf, source=True)
    value = (
        F.when(F.col("source_type") == MISSING_SRC, F.col("props"))
        .when(F.col("source_type") == BROKEN_SRC, F.concat(F.lit('{"ts": '), F.col("props")))
        .otherwise(DC.telemetry_json())
    )
    return t.select("seq", value.alias("value"))


@register("decode_telemetry", with_views(f"SELECT {TEL_COLS} FROM tel"))
def q_decode_telemetry(spark, sf):
    msgs = DC.encode_telemetry(TM.telemetry(spark, sf))
    return DC.decode_telemetry(msgs)


@register("decode_event", with_views(f"SELECT {EV_COLS} FROM ev"))
def q_decode_event(spark, sf):
    return DC.decode_event(DC.encode_event(TM.driving_events(spark, sf)))


@register("split_malformed", with_views(f"""
SELECT {TEL_COLS} FROM tel WHERE seq IN (SELECT event_id FROM events WHERE event_type NOT IN ('{MISSING_SRC}', '{BROKEN_SRC}'))"""))
def q_split_malformed(spark, sf):
    good, _bad = DC.split_malformed(feed_messages(spark, sf))
    return good


@register("quarantine", f"""
SELECT CASE WHEN event_type = '{MISSING_SRC}' THEN props ELSE '{{"ts": ' || props END AS raw,
       CASE WHEN event_type = '{MISSING_SRC}' THEN 'missing_field' ELSE 'malformed_json' END AS reason
FROM events WHERE event_type IN ('{MISSING_SRC}', '{BROKEN_SRC}')""")
def q_quarantine(spark, sf):
    _good, bad = DC.split_malformed(feed_messages(spark, sf))
    return bad


_REQ = "[" + ", ".join(f"'{c}'" for c in ["vehicle_id", "ts", "speed_kmh", "ignition_on"]) + "]"


@register("missing_fields", f"""
SELECT event_id AS seq, array_to_string(list_filter({_REQ}, lambda x: NOT list_contains(k, x)), ',') AS missing_fields
FROM (SELECT event_id, CASE WHEN json_valid(v) THEN json_keys(v) ELSE [] END AS k FROM (
  SELECT event_id, CASE WHEN event_type = '{MISSING_SRC}' THEN props ELSE '{{"ts": ' || props END AS v
  FROM events WHERE event_type IN ('{MISSING_SRC}', '{BROKEN_SRC}')))""")
def q_missing_fields(spark, sf):
    msgs = feed_messages(spark, sf)
    m = DC.missing_fields(msgs, "value", ["vehicle_id", "ts", "speed_kmh", "ignition_on"])
    return m.where(F.size("missing_fields") > 0).select("seq", F.array_join("missing_fields", ",").alias("missing_fields"))


@register("read_tagged_jsonl", with_views(f"SELECT {EV_COLS} FROM ev"))
def q_read_tagged_jsonl(spark, sf):
    lines = DC.tag_lines(TM.telemetry(spark, sf), TM.driving_events(spark, sf))
    _t, ev, _bad = DC.demux_tagged(lines)
    return ev


@register("read_tagged_telemetry", with_views(f"SELECT {TEL_COLS} FROM tel"))
def q_read_tagged_telemetry(spark, sf):
    lines = DC.tag_lines(TM.telemetry(spark, sf), TM.driving_events(spark, sf))
    t, _ev, _bad = DC.demux_tagged(lines)
    return t


REDELIVERY_S = 3600


@register("dedup_history", with_views(f"""
SELECT vehicle_id, event_time, speed_kmh + {_dbl(1.0)} AS speed_kmh, arrival_time + to_seconds({REDELIVERY_S}) AS arrival_time FROM tel"""))
def q_dedup_history(spark, sf):
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "speed_kmh", "arrival_time", "seq")
    again = t.select(
        "vehicle_id",
        "event_time",
        (F.col("speed_kmh") + F.lit(1.0)).alias("speed_kmh"),
        F.timestamp_add("SECOND", F.lit(REDELIVERY_S), F.col("arrival_time")).alias("arrival_time"),
        "seq",
    )
    return SK.dedup_latest(t.unionByName(again), ["vehicle_id", "event_time"]).drop("seq")


@register("upsert_columns", _vehicle_windows_sql(3600))
def q_upsert_columns(spark, sf):
    t, ev = TM.telemetry_light(spark, sf), TM.driving_events(spark, sf)
    speed = W.vehicle_speed_windows(t, HOUR).withColumn("harsh_event_count", F.lit(None).cast("long"))
    harsh = W.vehicle_harsh_windows(ev, HOUR)
    return SK.upsert_columns(speed, harsh, ["vehicle_id", "window_start"], ["harsh_event_count"])


# ---------------------------------------------------------------------------
# Storage casts, wire rounding, generic windowed rollup
# ---------------------------------------------------------------------------


_FLOATS = ["speed_kmh", "throttle_pct", "maf_g_per_s", "engine_temp_c", "coolant_temp_c", "intake_air_temp_c", "fuel_pct", "fuel_consumed_l", "odometer_km"]


@register("to_storage", with_views(
    "SELECT " + ", ".join(f"CAST({c} AS FLOAT) AS {c}" if c in _FLOATS else c for c in TELEMETRY_COLUMNS) + " FROM tel"))
def q_to_storage(spark, sf):
    return SK.to_storage(TM.telemetry(spark, sf, extra=False))


@register("quantize", with_views(
    "SELECT " + ", ".join(f"round({c}, {S.QUANTIZE_DP[c]}) AS {c}" if c in S.QUANTIZE_DP else c for c in TELEMETRY_COLUMNS) + " FROM tel"))
def q_quantize(spark, sf):
    return quantize(TM.telemetry(spark, sf, extra=False))


@register("windowed_generic", with_views(f"""
SELECT vehicle_id, {bucket(3600)} AS window_start, {bucket(3600)} + to_seconds(3600) AS window_end,
       count(*) AS samples, min(speed_kmh) AS min_speed_kmh, max(engine_temp_c) AS max_engine_temp_c,
       count(DISTINCT trip_id) AS trips
FROM tel GROUP BY 1, 2"""))
def q_windowed_generic(spark, sf):
    return W.windowed(
        TM.telemetry_light(spark, sf),
        ["vehicle_id"],
        HOUR,
        {
            "samples": F.count(F.lit(1)),
            "min_speed_kmh": F.min("speed_kmh"),
            "max_engine_temp_c": F.max("engine_temp_c"),
            "trips": F.count_distinct("trip_id"),
        },
    )


def _speed_bands_sql(rows: str, width_s: int) -> str:
    """Variance and modal band of speed over ``rows`` of (vehicle_id, window_start, c)."""
    bands = ", ".join(f"count(*) FILTER (WHERE least(c // 3000, 4) = {i})" for i in range(5))
    return with_views(f"""
SELECT vehicle_id, window_start, window_start + to_seconds({width_s}) AS window_end, n AS samples,
       CAST(n * ss - s * s AS DOUBLE) / CAST(n * n AS DOUBLE) / {_dbl(10000)} AS speed_variance,
       CAST(list_position(b, list_max(b)) - 1 AS INTEGER) AS modal_band
FROM (SELECT vehicle_id, window_start, count(*) AS n, sum(c) AS s, sum(c * c) AS ss, [{bands}] AS b FROM ({rows}) GROUP BY 1, 2)""")


_CENTI = f"CAST(round(speed_kmh * {_dbl(100)}) AS BIGINT) AS c"


@register("windowed_custom", _speed_bands_sql(f"SELECT vehicle_id, {bucket(3600)} AS window_start, {_CENTI} FROM tel", 3600))
def q_windowed_custom(spark, sf):
    """A user's aggregate with its own buffer over tumbling windows."""
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "speed_kmh")
    return AG.windowed_custom(t, ["vehicle_id"], HOUR, AG.SpeedBands())


@register("windowed_custom_sliding", _speed_bands_sql(
    f"SELECT vehicle_id, {bucket(1800)} - to_seconds(1800 * i) AS window_start, {_CENTI} FROM tel, (SELECT unnest(range(4)) AS i)", 7200))
def q_windowed_custom_sliding(spark, sf):
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "speed_kmh")
    return AG.windowed_custom(t, ["vehicle_id"], FLEET_2H[0], AG.SpeedBands(), FLEET_2H[1])


# ---------------------------------------------------------------------------
# Bearing from positions (H2) and the raw event history
# ---------------------------------------------------------------------------


def _bearing_sql() -> str:
    x = "sin(radians(lon - plon)) * cos(radians(lat))"
    y = "cos(radians(plat)) * sin(radians(lat)) - sin(radians(plat)) * cos(radians(lat)) * cos(radians(lon - plon))"
    return with_views(f"""
SELECT vehicle_id, event_time,
       CASE WHEN plat IS NOT NULL THEN round({pmod_sql(f'degrees(atan2({x}, {y}))', _dbl(360))}, 1) END AS bearing_deg
FROM (SELECT *, lag(lat) OVER {VW} AS plat, lag(lon) OVER {VW} AS plon FROM tel)""")


@register("bearing", _bearing_sql())
def q_bearing(spark, sf):
    from roadlens.operators.ordered import with_previous

    d = with_previous(TM.telemetry_light(spark, sf), ["vehicle_id"], ["event_time", "seq"], ["lat", "lon"])
    b = F.when(F.col("prev_lat").isNotNull(), F.round(bearing_deg("prev_lat", "prev_lon", "lat", "lon"), 1))
    return d.select("vehicle_id", "event_time", b.alias("bearing_deg"))


@register("dedup_events", with_views("SELECT event_id, vehicle_id, trip_id, event_time, event_type, coalesce(detail, '') AS detail FROM ev"))
def q_dedup_events(spark, sf):
    ev = TM.driving_events(spark, sf)
    again = ev.withColumn("arrival_time", F.timestamp_add("SECOND", F.lit(REDELIVERY_S), F.col("arrival_time")))
    d = SK.dedup_latest(ev.unionByName(again), ["vehicle_id", "event_time", "event_id"])
    return SK.history_rows(d, detail_default=True).select(*EVENT_COLUMNS)


# T10 with the posted limit of the nearest road node (J8 + H15 feeding the over-speed rule).
_TL_CTE = "tl AS (" + ASSIGN_SQL_BODY.replace(
    "SELECT p.vehicle_id, p.event_time, p.speed_kmh, p.city, n.road_class,", "SELECT p.*, n.road_class,"
) + ")"


@register("detect_events_posted_limit", _detect_sql("speed_limit_kmh", "tl", _nodes_cte(), _TL_CTE))
def q_detect_events_posted_limit(spark, sf):
    t = EN.assign_limit(TM.telemetry_light(spark, sf), EN.road_nodes(spark))
    return DT.detect_events(t, limit_kmh="speed_limit_kmh")
