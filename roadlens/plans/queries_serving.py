"""Queries over sparse and irregular views: per-vehicle aligned series, chosen
histories, given road nodes, one-sided windows, faulty messages, keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.operators import enrich as EN
from roadlens.operators import quality as QA
from roadlens.operators import serve as SV
from roadlens.operators import windows as W
from roadlens.plans.catalog import register
from roadlens.plans.oracle import HARSH_LIST, bucket, centi_sum, exact_mean, with_views
from roadlens.plans.queries_batch import EV_COLS, HISTORY_END, HISTORY_START, HOUR, TEL_COLS, _city_sql, _class_limit, _dbl, _resample_sql, _vehicle_windows_sql
from roadlens.schemas import EVENT_COLUMNS, TELEMETRY_COLUMNS
from roadlens.sources import decode as DC
from roadlens.sources import drift as DR
from roadlens.sources import sinks as SK
from roadlens.sources import testmap as TM
from roadlens.sources.tables import KeyedTable
from roadlens.streaming.stream import run_dir

CHOSEN = ["veh_0001", "veh_0002", "veh_0003", "veh_0007"]
NEWEST = 40
_CHOSEN_SQL = ", ".join(f"'{v}'" for v in CHOSEN)

# ---------------------------------------------------------------------------
# Series of chosen vehicles
# ---------------------------------------------------------------------------


def _aligned_sql(src: str, time: str, value: str, *ctes: str) -> str:
    cells = ", ".join(f"max(CASE WHEN vehicle_id = '{v}' THEN {value} END) AS {v}" for v in CHOSEN)
    return with_views(
        f"""SELECT {time}, {cells} FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY {time} DESC, {value} DESC NULLS LAST) AS rn FROM {src} WHERE vehicle_id IN ({_CHOSEN_SQL}))
WHERE rn <= {NEWEST} GROUP BY 1""", *ctes)


def _hourly_cte() -> str:
    return f"vwh AS ({_vehicle_windows_sql(3600)[len(with_views('')):]})"


@register("series_by_vehicle", _aligned_sql("tel", "event_time", "speed_kmh"))
def q_series_by_vehicle(spark, sf):
    return SV.newest_aligned(TM.telemetry_light(spark, sf), CHOSEN, "speed_kmh", NEWEST, "event_time")


def _hourly(spark, sf):
    return W.vehicle_windows(TM.telemetry_light(spark, sf), TM.driving_events(spark, sf), width=HOUR)


@register("windows_aligned", _aligned_sql("vwh", "window_start", "avg_speed_kmh", _hourly_cte()))
def q_windows_aligned(spark, sf):
    return SV.newest_aligned(_hourly(spark, sf), CHOSEN, "avg_speed_kmh", NEWEST, "window_start")


@register("harsh_aligned", _aligned_sql("vwh", "window_start", "harsh_event_count", _hourly_cte()))
def q_harsh_aligned(spark, sf):
    return SV.newest_aligned(_hourly(spark, sf), CHOSEN, "harsh_event_count", NEWEST, "window_start")


@register("history_vehicle", with_views(f"""
SELECT vehicle_id, event_time, lat, lon, speed_kmh FROM tel
WHERE vehicle_id IN ({_CHOSEN_SQL}) AND event_time >= TIMESTAMP '{HISTORY_START}' AND event_time < TIMESTAMP '{HISTORY_END}'"""))
def q_history_vehicle(spark, sf):
    h = SV.history(TM.telemetry_light(spark, sf), HISTORY_START, HISTORY_END, CHOSEN, ascending=True)
    return h.select("vehicle_id", "event_time", "lat", "lon", "speed_kmh")


# ---------------------------------------------------------------------------
# Nearest given road node
# ---------------------------------------------------------------------------


def _nodes_sql() -> str:
    k, (a, b, c, d), (a2, b2, c2, d2) = "s_suppkey", S.CITY_BOXES["Jakarta"], S.CITY_BOXES["Bandung"]
    u = f"CAST((CAST({k} AS BIGINT) * 7919) % 1009 AS DOUBLE) / {_dbl(1009)}"
    v = f"CAST((CAST({k} AS BIGINT) * 104729) % 997 AS DOUBLE) / {_dbl(997)}"
    names = "[" + ", ".join(f"'{x}'" for x in S.ROAD_CLASS_LIMIT_KMH) + "]"
    return f"""rn AS (SELECT 'route_' || CAST(s_nationkey AS VARCHAR) AS route_id,
      CASE WHEN {k} % 2 = 0 THEN 'Jakarta' ELSE 'Bandung' END AS city, CAST({k} AS BIGINT) AS seq,
      CASE WHEN {k} % 2 = 0 THEN {_dbl(a)} + {u} * {_dbl(b - a)} ELSE {_dbl(a2)} + {u} * {_dbl(b2 - a2)} END AS nlat,
      CASE WHEN {k} % 2 = 0 THEN {_dbl(c)} + {v} * {_dbl(d - c)} ELSE {_dbl(c2)} + {v} * {_dbl(d2 - c2)} END AS nlon,
      ({names})[1 + {k} % {len(S.ROAD_CLASS_LIMIT_KMH)}] AS road_class,
      CASE WHEN {k} % 5 = 0 THEN 30 END AS override FROM supplier)"""


_SCALE = "CASE p.city " + " ".join(f"WHEN '{c}' THEN CAST({EN._lon_scale(c)!r} AS DOUBLE)" for c in S.CITY_BOXES) + " END"


@register("assign_limit_nodes", with_views(
    f"""SELECT vehicle_id, event_time, city, route_id, node_seq, road_class, CAST(coalesce(override, {_class_limit}) AS INTEGER) AS speed_limit_kmh FROM (
  SELECT p.vehicle_id, p.event_time, p.seq, p.city, n.route_id, n.seq AS node_seq, n.road_class, n.override,
         row_number() OVER (PARTITION BY p.seq ORDER BY (p.lat - n.nlat) * (p.lat - n.nlat) + ((p.lon - n.nlon) * {_SCALE}) * ((p.lon - n.nlon) * {_SCALE}), n.route_id, n.seq) AS r
  FROM (SELECT *, {_city_sql()} AS city FROM tel) p LEFT JOIN rn n ON p.city = n.city) WHERE r = 1""", _nodes_sql()))
def q_assign_limit_nodes(spark, sf):
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "lat", "lon")
    return EN.assign_limit_nodes(t, TM.road_nodes_from_suppliers(spark, sf)).select(
        "vehicle_id", "event_time", "city", "route_id", "node_seq", "road_class", "speed_limit_kmh"
    )


_SEGMENTS = (
    """rs AS (SELECT route_id, city, seq, nlat AS lat0, nlon AS lon0, coalesce(lat1, nlat) AS lat1, coalesce(lon1, nlon) AS lon1, road_class, override
  FROM (SELECT *, lead(nlat) OVER w AS lat1, lead(nlon) OVER w AS lon1, row_number() OVER w AS r FROM rn WINDOW w AS (PARTITION BY city, route_id ORDER BY seq))
  WHERE lat1 IS NOT NULL OR r = 1)""",
    f"""ps AS (SELECT p.vehicle_id, p.event_time, p.seq AS reading, p.city, s.route_id, s.seq, s.road_class, s.override,
    lat1 - lat0 AS vy, (lon1 - lon0) * {_SCALE} AS vx, p.lat - lat0 AS wy, (p.lon - lon0) * {_SCALE} AS wx
  FROM (SELECT *, {_city_sql()} AS city FROM tel) p LEFT JOIN rs s ON p.city = s.city)""",
    """pd AS (SELECT *, CASE WHEN vy * vy + vx * vx > 0 THEN least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), (wy * vy + wx * vx) / (vy * vy + vx * vx)))
    ELSE CAST(0 AS DOUBLE) END AS f FROM ps)""",
    """pr AS (SELECT *, row_number() OVER (PARTITION BY reading
    ORDER BY (wy - f * vy) * (wy - f * vy) + (wx - f * vx) * (wx - f * vx), route_id, seq) AS r FROM pd)""",
)


@register("assign_limit_segments", with_views(
    f"""SELECT vehicle_id, event_time, city, route_id, seq AS segment_seq, road_class, CAST(coalesce(override, {_class_limit}) AS INTEGER) AS speed_limit_kmh
FROM pr WHERE r = 1""", _nodes_sql(), *_SEGMENTS))
def q_assign_limit_segments(spark, sf):
    """Limit of the nearest segment of the routes' polylines; the SQL tries
    every segment of the city."""
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "lat", "lon")
    return EN.assign_limit_segments(t, EN.road_segments(TM.road_nodes_from_suppliers(spark, sf))).select(
        "vehicle_id", "event_time", "city", "route_id", "segment_seq", "road_class", "speed_limit_kmh"
    )


# ---------------------------------------------------------------------------
# Views in which each side lacks windows of the other
# ---------------------------------------------------------------------------

_T_SPARSE = ", ".join(f"'{x}'" for x in TM.SPARSE_TELEMETRY)
_E_SPARSE = ", ".join(f"'{x}'" for x in TM.SPARSE_EVENTS)
SPARSE_CTES = (
    f"stel AS (SELECT * FROM tel WHERE seq IN (SELECT event_id FROM events WHERE event_type IN ({_T_SPARSE})))",
    f"sev AS (SELECT * FROM ev WHERE seq IN (SELECT event_id FROM events WHERE event_type IN ({_E_SPARSE})))",
    f"""su AS (SELECT vehicle_id, event_time, speed_kmh, CAST(NULL AS INTEGER) AS harsh_flag FROM stel UNION ALL
  SELECT vehicle_id, event_time, CAST(NULL AS DOUBLE), CASE WHEN event_type IN ({HARSH_LIST}) THEN 1 ELSE 0 END FROM sev)""",
)
SPARSE_WINDOWS = f"""SELECT vehicle_id, {bucket(3600)} AS window_start, {exact_mean(centi_sum(), 'count(speed_kmh)')} AS avg_speed_kmh,
  max(speed_kmh) AS max_speed_kmh, CAST(sum(harsh_flag) AS BIGINT) AS harsh_event_count FROM su GROUP BY 1, 2"""


@register("vehicle_windows_sparse", with_views(SPARSE_WINDOWS, *SPARSE_CTES))
def q_vehicle_windows_sparse(spark, sf):
    return W.vehicle_windows(*TM.sparse_sides(spark, sf), width=HOUR)


@register("fleet_windows_sparse", with_views(
    f"""SELECT CAST(window_start AS DATE) AS day_bucket, window_start, window_start + to_seconds(7200) AS window_end,
  CASE WHEN count(speed_kmh) > 0 THEN count(DISTINCT CASE WHEN speed_kmh IS NOT NULL THEN vehicle_id END) END AS vehicles_active,
  {exact_mean(centi_sum(), 'count(speed_kmh)')} AS fleet_avg_speed_kmh, CAST(sum(harsh_flag) AS BIGINT) AS total_harsh_events
FROM (SELECT *, {bucket(1800)} - to_seconds(k * 1800) AS window_start FROM (SELECT *, unnest(range(0, 4)) AS k FROM su)) GROUP BY window_start""",
    *SPARSE_CTES))
def q_fleet_windows_sparse(spark, sf):
    return W.fleet_windows(*TM.sparse_sides(spark, sf), "7200 seconds", "1800 seconds")


@register("upsert_increments", with_views(SPARSE_WINDOWS, *SPARSE_CTES))
def q_upsert_increments(spark, sf):
    """Speed columns and harsh counts of the same windows written one after
    the other into one table; each write keeps the other's columns and rows."""
    t, ev = TM.sparse_sides(spark, sf)
    keys = ["vehicle_id", "window_start"]
    speed = W.vehicle_speed_windows(t, HOUR).withColumn("harsh_event_count", F.lit(None).cast("long"))
    none = F.lit(None).cast("double")
    harsh = W.vehicle_harsh_windows(ev, HOUR).select(*keys, none.alias("avg_speed_kmh"), none.alias("max_speed_kmh"), "harsh_event_count")
    out = f"{run_dir(spark, 'upsert_increments')}/t"
    SK.write_columns(speed, out, keys, ["avg_speed_kmh", "max_speed_kmh"])
    SK.write_columns(harsh, out, keys, ["harsh_event_count"])
    return KeyedTable(spark, out, F.to_date("window_start")).read()


CORRECTED_SRC = "error"
_CORRECTED = f"seq IN (SELECT event_id FROM events WHERE event_type = '{CORRECTED_SRC}')"
CORRECTED_SQL = f"""SELECT vehicle_id, event_time, speed_kmh + CASE WHEN {_CORRECTED} THEN {_dbl(1)} ELSE {_dbl(0)} END AS speed_kmh FROM tel"""


@register("history_increments", with_views(CORRECTED_SQL))
def q_history_increments(spark, sf):
    """Three writes to the same days: part of the readings, the others,
    and corrections of some of them; every key is there once, last write."""
    e = TM.read_table(spark, sf, "events")
    t = TM.light_from(e).select("vehicle_id", "event_time", "speed_kmh", "arrival_time", "seq")
    again = TM.light_from(e.where(F.col("event_type") == CORRECTED_SRC)).select(
        "vehicle_id", "event_time", (F.col("speed_kmh") + F.lit(1.0)).alias("speed_kmh"),
        F.timestamp_add("SECOND", F.lit(3600), F.col("arrival_time")).alias("arrival_time"), "seq")
    late = F.col("arrival_time") > F.timestamp_add("SECOND", F.lit(60), F.col("event_time"))
    out = f"{run_dir(spark, 'history_increments')}/t"
    SK.write_history(t.where(~late), out)
    SK.write_history(t.where(late).unionByName(again), out)
    SK.write_history(again, out)
    return SK.read_history(spark, out).select("vehicle_id", "event_time", "speed_kmh")


# ---------------------------------------------------------------------------
# Faulty messages
# ---------------------------------------------------------------------------

FAULTS = {"view": "bad_uuid", "click": "missing_field", "error": "bad_value"}


def faulty_messages(spark, sf):
    """Telemetry messages; three source types have a fault each, the others
    write the gear as ``3.0`` and the speed as a quoted number."""
    return TM.telemetry(spark, sf, source=True).select("seq", faulty_value())


def faulty_value():
    m = DC.telemetry_json()
    quoted = F.regexp_replace(F.regexp_replace(m, r'"gear":(\d+)', r'"gear":$1.0'), r'"speed_kmh":([0-9.E+-]+)', r'"speed_kmh":"$1"')
    return (
        F.when(F.col("source_type") == "view", F.regexp_replace(m, r'"trip_id":"[^"]*"', '"trip_id":"trip-7"'))
        .when(F.col("source_type") == "click", F.regexp_replace(m, r'"lat":[0-9.E+-]+', '"lat":null'))
        .when(F.col("source_type") == "error", F.regexp_replace(m, r'"rpm":\d+', '"rpm":"fast"'))
        .otherwise(quoted)
        .alias("value")
    )


_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FAULTS.items())
_FAULTY = ", ".join(f"'{k}'" for k in FAULTS)


@register("quarantine_values", f"SELECT event_id AS seq, CASE event_type {_CASES} END AS reason FROM events WHERE event_type IN ({_FAULTY})")
def q_quarantine_values(spark, sf):
    return DC.check_telemetry(faulty_messages(spark, sf), keep=("seq",)).where("reason IS NOT NULL").select("seq", "reason")


@register("decode_lenient", with_views(f"SELECT {TEL_COLS} FROM tel WHERE seq NOT IN (SELECT event_id FROM events WHERE event_type IN ({_FAULTY}))"))
def q_decode_lenient(spark, sf):
    good, _bad = DC.split_malformed(faulty_messages(spark, sf))
    return good.select(*TELEMETRY_COLUMNS)


@register("tagged_quarantine", f"""
SELECT CASE WHEN event_type = 'error' THEN props ELSE '{{"ts": ' || props END AS raw,
       CASE WHEN event_type = 'error' THEN 'unknown_kind' ELSE 'malformed_json' END AS reason
FROM events WHERE event_type IN ('error', 'purchase')""")
def q_tagged_quarantine(spark, sf):
    e = TM.read_table(spark, sf, "events")
    odd = e.where(F.col("event_type") == "error").select(F.col("props").alias("value"))
    broken = e.where(F.col("event_type") == "purchase").select(F.concat(F.lit('{"ts": '), F.col("props")).alias("value"))
    lines = DC.tag_lines(TM.telemetry(spark, sf), TM.driving_events(spark, sf)).unionByName(odd).unionByName(broken)
    _t, _ev, bad = DC.demux_tagged(lines)
    return bad


@register("resample_fine", _resample_sql(300))
def q_resample_fine(spark, sf):
    return QA.resample(TM.telemetry_light(spark, sf), 300)


# ---------------------------------------------------------------------------
# Fields and types that the messages really carry
# ---------------------------------------------------------------------------

_WIRE = ["ts" if c == "event_time" else c for c in TELEMETRY_COLUMNS]
EXPECTED_KINDS = {c: "string" if c in ("vehicle_id", "trip_id", "ts") else "boolean" if c == "ignition_on" else "number" for c in _WIRE}
# What each planted fault changes: a field, and the kind it has then.
_KIND_CASES = " ".join(f"WHEN field = '{f}' AND event_type = '{e}' THEN '{k}'" for f, e, k in (("lat", "click", "null"), ("rpm", "error", "string")))
_PLAIN = ", ".join(f"'{e}'" for e in FAULTS)
_EXPECTED_LIST = "[" + ", ".join(f"{{'field': '{f}', 'want': '{k}'}}" for f, k in EXPECTED_KINDS.items()) + "]"


_NO_TRIP = "field = 'trip_id' AND trip_id IS NULL"


@register("payload_drift", with_views(
    f"""SELECT field, kind, count(*) AS messages, CASE WHEN kind = want THEN 'ok' ELSE 'type' END AS verdict FROM k WHERE NOT ({_NO_TRIP}) GROUP BY field, kind, want
UNION ALL SELECT field, NULL, count(*), 'missing' FROM k WHERE {_NO_TRIP} GROUP BY field""",
    f"m AS (SELECT event_type, trip_id, unnest({_EXPECTED_LIST}, recursive := true) FROM events JOIN tel ON event_id = seq)",
    f"k AS (SELECT field, want, trip_id, CASE {_KIND_CASES} WHEN field = 'speed_kmh' AND event_type NOT IN ({_PLAIN}) THEN 'string' ELSE want END AS kind FROM m)"))
def q_payload_drift(spark, sf):
    """Every message parsed once; per field and JSON type how many carry it."""
    return DR.payload_drift(faulty_messages(spark, sf), EXPECTED_KINDS)


# ---------------------------------------------------------------------------
# Panels over all vehicles, in long form
# ---------------------------------------------------------------------------


def _newest_sql(src: str, time: str, value: str, *ctes: str) -> str:
    return with_views(
        f"""SELECT vehicle_id, {time}, {value} FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY {time} DESC, {value} DESC NULLS LAST) AS rn FROM {src}) WHERE rn <= {NEWEST}""", *ctes)


def _newest(df, time: str, value: str):
    return SV.top_n_per_key(df.select("vehicle_id", time, value), NEWEST, order=[F.col(time).desc(), F.col(value).desc()])


@register("series_newest", _newest_sql("tel", "event_time", "speed_kmh"))
def q_series_newest(spark, sf):
    return _newest(TM.telemetry_light(spark, sf), "event_time", "speed_kmh").select("vehicle_id", "event_time", "speed_kmh")


@register("windows_newest", _newest_sql("vwh", "window_start", "avg_speed_kmh", _hourly_cte()))
def q_windows_newest(spark, sf):
    return _newest(_hourly(spark, sf), "window_start", "avg_speed_kmh").select("vehicle_id", "window_start", "avg_speed_kmh")


@register("harsh_newest", _newest_sql("vwh", "window_start", "harsh_event_count", _hourly_cte()))
def q_harsh_newest(spark, sf):
    return _newest(_hourly(spark, sf), "window_start", "harsh_event_count").select("vehicle_id", "window_start", "harsh_event_count")


# ---------------------------------------------------------------------------
# History of vehicles asked for by a table of requests
# ---------------------------------------------------------------------------


@register("history_vehicles_indexed", with_views(
    """SELECT tel.vehicle_id, event_time, lat, lon, speed_kmh FROM tel
JOIN (SELECT vehicle_id, min(event_time) + to_seconds(86400) AS since FROM tel GROUP BY 1) r ON tel.vehicle_id = r.vehicle_id
WHERE event_time >= since AND event_time < since + to_seconds(172800)"""))
def q_history_vehicles_indexed(spark, sf):
    """Each vehicle's second and third day, from a history table whose file
    index says which files to open; the last readings are not merged yet."""
    t = TM.telemetry_light(spark, sf).select("vehicle_id", "event_time", "lat", "lon", "speed_kmh", "arrival_time", "seq")
    late = F.to_date("event_time") >= F.lit(HISTORY_END).cast("date")
    out = f"{run_dir(spark, 'history_indexed')}/t"
    SK.write_history(t.where(~late), out)
    table = SK.history_table(spark, out)
    table.compact()
    SK.write_history(t.where(late), out)
    since = F.timestamp_add("SECOND", F.lit(86_400), F.min("event_time"))
    requests = t.groupBy("vehicle_id").agg(since.alias("since")).withColumn("until", F.timestamp_add("SECOND", F.lit(172_800), F.col("since")))
    return table.read_requests(requests, "vehicle_id", "event_time").select("vehicle_id", "event_time", "lat", "lon", "speed_kmh")
