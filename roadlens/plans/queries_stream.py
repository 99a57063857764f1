"""Streaming queries: views of the events table as file streams, run to
completion (``availableNow``), compared with the batch oracle restricted to
what the final watermark has closed. Where order matters, the rows are written
as several files in their order of arrival, one micro-batch each."""

from __future__ import annotations

import time
import weakref
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.operators.ordered import fitting_bucket
from roadlens.plans.catalog import register
from roadlens.plans.oracle import secs_sql, with_views
from roadlens.plans.queries_batch import (
    EV_COLS,
    LATEST_SQL,
    SESSION_GAP_TEST_S,
    TEL_COLS,
    TEST_LIMIT_KMH,
    _detect_sql,
    _fleet_windows_sql,
    _sessions_sql,
    _vehicle_windows_sql,
)
from roadlens.plans.queries_serving import CORRECTED_SRC, FAULTS, _FAULTY, _CASES, faulty_value
from roadlens.schemas import EVENT_COLUMNS, SESSION_GAP_S, TELEMETRY_COLUMNS
from roadlens.session import delete_path, free_shuffles
from roadlens.sources import decode as DC
from roadlens.sources import sinks as SK
from roadlens.sources import testmap as TM
from roadlens.streaming import processors as PR
from roadlens.streaming import segments as SG
from roadlens.streaming import stream as ST
from roadlens.streaming.progress import ProgressLog, read_progress

HOLD_S = 75
# Readings arrive up to three minutes late; a hold beyond that drops none.
LONG_HOLD_S = 300


def _wm(hold_s: int) -> str:
    return f"((SELECT max(ts) FROM events) - to_seconds({hold_s}))"


WM = _wm(HOLD_S)


def events_stream(spark, sf_dir: str) -> DataFrame:
    """The events table as a file stream of one micro-batch."""
    return ST.file_source(spark, sf_dir, TM.read_table(spark, sf_dir, "events").schema, glob="events.parquet")


def one_batch(spark, sf_dir: str) -> DataFrame:
    e = events_stream(spark, sf_dir)
    return ST.signals(TM.light_from(e, streaming_ts=True), TM.events_from(e, streaming_ts=True))


SLICES, SLICES_MOST = 5, 200  # micro-batches
FILE_ROWS, SLICE_FILES = 1_000_000, 16  # a slice gets more files only where there are slices enough


@dataclass(frozen=True)
class Feed:
    """Files in order of arrival: ``files`` of them are a micro-batch."""

    path: str
    files: int


def by_arrival(df: DataFrame, name: str, order: str = "arrival_time", fmt: str = "parquet", cols=None, made=None, like: DataFrame | None = None,
               file_rows: int | None = None, slice_rows: int | None = None) -> Feed:
    """Writes ``df`` once, as slices in order of arrival. Slices and their
    files grow in number with the rows, not in size; rows without a time of
    arrival are in the first slice. ``made`` makes ``cols`` (and ``slice``) of
    rows that are dealt out already, so that long texts are not; ``like`` has
    the times of ``df`` at less cost."""
    file_rows = file_rows or FILE_ROWS
    slice_rows = slice_rows or file_rows * SLICE_FILES
    spark = df.sparkSession
    base = f"{ST.run_dir(spark, name)}/in"
    a = F.unix_micros(F.col(order).cast("timestamp"))
    points = [i / SLICES_MOST for i in range(1, SLICES_MOST)]
    rows, quantiles = (df if like is None else like).select(F.count(F.lit(1)), F.percentile_approx(a, points, 10_000)).first()
    slices = min(SLICES_MOST, max(SLICES, -(-rows // slice_rows)))
    files = max(1, -(-rows // (slices * file_rows)))
    bounds = [quantiles[SLICES_MOST * i // slices - 1] for i in range(1, slices)] if quantiles else []
    at = F.lit(0)
    for b in bounds:
        at = at + F.when(a > b, 1).otherwise(0)
    out = df if cols is None or made else df.select(*cols, order)
    out = out.withColumn("slice", at)
    out = out.repartitionById(slices * files, (F.col("slice") * files + F.pmod(F.xxhash64(F.struct(*out.columns)), F.lit(files))).cast("int"))
    if cols is not None:
        out = (made(out) if made else out).select(*cols, "slice")
    out.write.partitionBy("slice").format(fmt).option("compression", "gzip" if fmt == "text" else "zstd").save(base)
    free_shuffles(spark)
    _set_order(spark, base, slices)
    return Feed(base, files)


def _set_order(spark, base: str, slices: int) -> None:
    """A file source takes files by their time of change, oldest first."""
    start = 1000 * (int(time.time()) - slices)
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(base)):
        return  # no batch had a row
    for d in fs.listStatus(jvm.org.apache.hadoop.fs.Path(base)):
        part = d.getPath().getName()
        if part.startswith("slice="):
            for f in fs.listStatus(d.getPath()):
                fs.setTimes(f.getPath(), start + 1000 * int(part.split("=")[1]), -1)


def stream_of(spark, feed: Feed, schema) -> DataFrame:
    return ST.file_source(spark, f"{feed.path}/slice=*", schema, max_files_per_trigger=feed.files)


def _ntz(df, cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


def _body(sql: str) -> str:
    return sql[len(with_views("")):]


@register(
    "stream_vehicle_windows",
    with_views(f"SELECT * FROM vw WHERE window_start + to_seconds(60) <= {WM}", f"vw AS ({_body(_vehicle_windows_sql(60))})"),
)
def q_stream_vehicle_windows(spark, sf):
    u = one_batch(spark, sf)
    out = ST.run_to_parquet(ST.vehicle_windows_stream(u), "vehicle_windows")
    return _ntz(spark.read.parquet(out), ["window_start"])


@register(
    "stream_fleet_windows",
    with_views(f"SELECT * FROM fw WHERE window_end <= {WM}", f"fw AS ({_body(_fleet_windows_sql(300, 30))})"),
)
def q_stream_fleet_windows(spark, sf):
    u = one_batch(spark, sf)
    out = ST.run_to_parquet(ST.fleet_windows_stream(u), "fleet_windows")
    return _ntz(spark.read.parquet(out), ["window_start", "window_end"])


@register(
    "stream_trip_sessions",
    with_views(
        f"""SELECT vehicle_id, min(event_time) AS start_time, max(event_time) AS end_time, max(speed_kmh) AS max_speed_kmh, count(*) AS samples
FROM s2 GROUP BY vehicle_id, sess HAVING max(event_time) + to_seconds({SESSION_GAP_TEST_S}) <= {WM}""",
        f"s1 AS (SELECT *, lag(event_time) OVER (PARTITION BY vehicle_id ORDER BY event_time, seq) AS pt FROM tel)",
        f"""s2 AS (SELECT *, sum(CASE WHEN pt IS NULL OR {secs_sql('event_time', 'pt')} > {float(SESSION_GAP_TEST_S)} THEN 1 ELSE 0 END)
               OVER (PARTITION BY vehicle_id ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING) AS sess FROM s1)""",
    ),
)
def q_stream_trip_sessions(spark, sf):
    t = TM.light_from(events_stream(spark, sf), streaming_ts=True)
    out = ST.run_to_parquet(ST.sessions_stream(t, SESSION_GAP_TEST_S), "trip_sessions")
    return _ntz(spark.read.parquet(out), ["start_time", "end_time"])


@register("stream_dedup_history", with_views("SELECT vehicle_id, event_time, speed_kmh FROM tel"))
def q_stream_dedup_history(spark, sf):
    t = TM.light_from(events_stream(spark, sf), streaming_ts=True).select("vehicle_id", "event_time", "speed_kmh", "arrival_time", "seq")
    out = ST.run_foreach_batch(t, "dedup", ST.history_writer(), mode="append")
    return _ntz(SK.read_history(spark, out), ["event_time"]).select("vehicle_id", "event_time", "speed_kmh")


_FIXED = f"seq IN (SELECT event_id FROM events WHERE event_type = '{CORRECTED_SRC}')"


@register("stream_history", with_views(
    "SELECT " + ", ".join(f"speed_kmh + CASE WHEN {_FIXED} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS speed_kmh" if c == "speed_kmh" else c for c in TELEMETRY_COLUMNS) + " FROM tel"))
def q_stream_history(spark, sf):
    """Readings in order of arrival over several micro-batches, some of
    them twice and some corrected long after the hold; all 18 fields."""
    t = TM.telemetry(spark, sf, source=True)
    t = t.withColumn("event_time", F.col("event_time").cast("timestamp")).withColumn("arrival_time", F.col("arrival_time").cast("timestamp"))
    some = t.where(F.col("source_type") == CORRECTED_SRC)
    fixed = some.withColumn("speed_kmh", F.col("speed_kmh") + F.lit(1.0)).withColumn("arrival_time", F.timestamp_add("HOUR", F.lit(30), F.col("arrival_time")))
    feed = t.unionByName(some).unionByName(fixed).drop("source_type", "props")
    s = stream_of(spark, by_arrival(feed, "history"), feed.schema)
    out = ST.run_foreach_batch(s, "history", ST.history_writer(), mode="append")
    return _ntz(SK.read_history(spark, out), ["event_time"]).select(*TELEMETRY_COLUMNS)


@register(
    "stream_late_records",
    with_views(f"""
SELECT vehicle_id, event_time, arrival_time, window_end, {secs_sql('arrival_time', 'window_end')} AS late_seconds
FROM (SELECT *, time_bucket(INTERVAL '60 seconds', event_time) + to_seconds(60) AS window_end FROM tel)
WHERE arrival_time > window_end + to_seconds({HOLD_S})"""),
)
def q_stream_late_records(spark, sf):
    t = TM.light_from(events_stream(spark, sf), streaming_ts=True)
    out = ST.run_to_parquet(ST.late_stream(t), "late_records")
    return _ntz(spark.read.parquet(out), ["event_time", "arrival_time", "window_end"])


@register("stream_latest_state", with_views(LATEST_SQL))
def q_stream_latest_state(spark, sf):
    t = TM.light_from(events_stream(spark, sf), streaming_ts=True)
    out = ST.run_foreach_batch(t, "latest_state", ST.latest_state_writer, mode="append")
    return ST.read_latest_state(spark, out)


# ---------------------------------------------------------------------------
# Custom stateful processors
# ---------------------------------------------------------------------------


def _detect_before_sql(hold_s: int) -> str:
    body = _body(_detect_sql(TEST_LIMIT_KMH))
    head, sep, tail = body.rpartition("FROM d5)\n")
    return with_views(f"SELECT * FROM de WHERE event_time < {_wm(hold_s)}", (head + sep).lstrip(",\n").rstrip(), f"de AS ({tail})")


@register("stream_detect_events", _detect_before_sql(HOLD_S))
def q_stream_detect_events(spark, sf):
    t = TM.light_from(events_stream(spark, sf), streaming_ts=True)
    with ST.rocksdb_state(spark):
        out = ST.run_to_parquet(PR.detect_events_stream(t, TEST_LIMIT_KMH), "detect_events")
    return _ntz(spark.read.parquet(out), ["event_time"])


def _shuffled(spark, sf, name: str) -> DataFrame:
    """Readings in order of arrival, which is not that of event time."""
    t = TM.light_from(TM.read_table(spark, sf, "events"), streaming_ts=True)
    return stream_of(spark, by_arrival(t, name), t.schema)


@register("stream_detect_events_shuffled", _detect_before_sql(LONG_HOLD_S))
def q_stream_detect_events_shuffled(spark, sf):
    t = _shuffled(spark, sf, "detect_in")
    with ST.rocksdb_state(spark):
        out = ST.run_to_parquet(PR.detect_events_stream(t, TEST_LIMIT_KMH, f"{LONG_HOLD_S} seconds"), "detect_events_shuffled")
    return _ntz(spark.read.parquet(out), ["event_time"])


def _stream_sessions_sql(hold_s: int) -> str:
    # body = "<ctes>\n<select>" after the shared view CTEs; wrap its final select as a CTE.
    head, _, select = _body(_sessions_sql(SESSION_GAP_TEST_S, True)).rpartition("\nSELECT g.vehicle_id")
    wm = _wm(hold_s)
    return with_views(
        f"""SELECT vehicle_id, start_time, end_time, distance_km, max_speed_kmh, samples FROM ts
WHERE (NOT is_open AND end_time < {wm} AND (closed_by_off OR next_t < {wm})) OR end_time + to_seconds({SESSION_GAP_TEST_S}) <= {wm}""",
        head.lstrip(",\n"),
        f"""ts AS (SELECT q.*, NOT l.ignition_on AS closed_by_off, l.next_t FROM (SELECT g.vehicle_id{select}) q
  JOIN (SELECT vehicle_id, event_time, ignition_on, lead(event_time) OVER (PARTITION BY vehicle_id ORDER BY event_time, seq) AS next_t FROM tel) l
  ON q.vehicle_id = l.vehicle_id AND q.end_time = l.event_time)""",
    )


@register("stream_trip_sessions_ignition", _stream_sessions_sql(HOLD_S))
def q_stream_trip_sessions_ignition(spark, sf):
    t = TM.light_from(events_stream(spark, sf), streaming_ts=True)
    with ST.rocksdb_state(spark):
        out = ST.run_to_parquet(PR.trip_sessions_stream(t, SESSION_GAP_TEST_S), "trip_sessions_ignition")
    return _ntz(spark.read.parquet(out), ["start_time", "end_time"])


@register("stream_trip_sessions_shuffled", _stream_sessions_sql(LONG_HOLD_S))
def q_stream_trip_sessions_shuffled(spark, sf):
    t = _shuffled(spark, sf, "sessions_in")
    with ST.rocksdb_state(spark):
        out = ST.run_to_parquet(PR.trip_sessions_stream(t, SESSION_GAP_TEST_S, f"{LONG_HOLD_S} seconds"), "trip_sessions_shuffled")
    return _ntz(spark.read.parquet(out), ["start_time", "end_time"])


SILENCE_S, SLOT_S = 86_400, 1800
# Planted gaps: four days of every fourth vehicle, and three hours of every seventh day.
_QUIET_VEHICLES = "(user_id % 4 = 1 AND extract(day FROM ts) BETWEEN 10 AND 13)"
_QUIET_HOURS = "(extract(day FROM ts) % 7 = 3 AND extract(hour FROM ts) BETWEEN 9 AND 11)"


def _without(spark, sf, quiet: str, name: str) -> DataFrame:
    """Readings in order of arrival, without those of the planted gaps."""
    t = TM.light_from(TM.read_table(spark, sf, "events").where(f"NOT {quiet}"), streaming_ts=True)
    return stream_of(spark, by_arrival(t, name), t.schema)


def _heard(quiet: str) -> tuple[str, str]:
    heard = f"heard AS (SELECT * FROM tel WHERE seq IN (SELECT event_id FROM events WHERE NOT {quiet}))"
    return heard, f"((SELECT max(event_time) FROM heard) - to_seconds({LONG_HOLD_S}))"


_HEARD, _HEARD_WM = _heard(_QUIET_VEHICLES)


@register("stream_stale_vehicles", with_views(
    f"""SELECT vehicle_id, event_time AS last_seen, event_time + to_seconds({SILENCE_S}) AS silent_since
FROM (SELECT *, lead(event_time) OVER (PARTITION BY vehicle_id ORDER BY event_time, seq) AS nxt FROM heard)
WHERE (nxt IS NULL OR nxt > event_time + to_seconds({SILENCE_S})) AND event_time + to_seconds({SILENCE_S}) < {_HEARD_WM}""", _HEARD))
def q_stream_stale_vehicles(spark, sf):
    """T12 live: vehicles that fell silent, told by timers."""
    t = _without(spark, sf, _QUIET_VEHICLES, "silent_in")
    with ST.rocksdb_state(spark):
        out = ST.run_to_parquet(PR.stale_vehicles_stream(t, SILENCE_S, f"{LONG_HOLD_S} seconds"), "stale_vehicles")
    return _ntz(spark.read.parquet(out), ["last_seen", "silent_since"])


_HEARD_SLOTS, _SLOTS_WM = _heard(_QUIET_HOURS)


@register("stream_missing_slots", with_views(
    f"""SELECT slot_start FROM (SELECT unnest(generate_series((SELECT min(slot) FROM slots),
  time_bucket(INTERVAL '{SLOT_S} seconds', {_SLOTS_WM}) - to_seconds({SLOT_S}), INTERVAL '{SLOT_S} seconds')) AS slot_start)
WHERE slot_start NOT IN (SELECT slot FROM slots)""",
    _HEARD_SLOTS, f"slots AS (SELECT DISTINCT time_bucket(INTERVAL '{SLOT_S} seconds', event_time) AS slot FROM heard)"))
def q_stream_missing_slots(spark, sf):
    """T13 live: slots of the fleet that nothing was written for."""
    t = _without(spark, sf, _QUIET_HOURS, "slots_in")
    with ST.rocksdb_state(spark):
        out = ST.run_to_parquet(PR.missing_slots_stream(t, SLOT_S, f"{LONG_HOLD_S} seconds"), "missing_slots")
    return _ntz(spark.read.parquet(out), ["slot_start"])


@register("stream_vehicle_windows_update", _vehicle_windows_sql(60))
def q_stream_vehicle_windows_update(spark, sf):
    """Update mode (changed windows only, open ones included) merged by
    key into the days they lie in; readings in order of arrival over several
    micro-batches, so windows change after they were first written."""
    e = TM.read_table(spark, sf, "events")
    feed = e.withColumn("arrival_time", F.timestamp_add("SECOND", (F.col("event_id") % 7) * 30, F.col("ts")))
    s = stream_of(spark, by_arrival(feed, "update_in"), feed.schema).drop("arrival_time")
    u = ST.signals(TM.light_from(s, streaming_ts=True), TM.events_from(s, streaming_ts=True))
    keys = ["vehicle_id", "window_start"]
    windows = ST.vehicle_windows_stream(u, hold=f"{LONG_HOLD_S} seconds")
    out = ST.run_foreach_batch(windows, "vehicle_windows_update", SK.keyed_merge_writer(keys), mode="update")
    return _ntz(SK.read_history(spark, out), ["window_start"])


def _renamed(spark, old: str, new: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(old).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(new).getParent())
    if not fs.rename(path(old), path(new)):
        raise OSError(f"cannot rename {old}")


def stopped_and_resumed(spark, feed: Feed, schema, start) -> str:
    """Runs ``start(stream, checkpoint)`` over the first slices of a feed, to
    its end, and again from the same checkpoint after the rest has come; the
    checkpoint's folder."""
    names = sorted(f"slice={i}" for i in range(SLICES))
    base = feed.path.removesuffix("/in")
    for part in (names[:2], names[2:]):
        for n in part:
            _renamed(spark, f"{feed.path}/{n}", f"{base}/run/{n}")
        s = ST.file_source(spark, f"{base}/run/slice=*", schema, max_files_per_trigger=feed.files)
        start(s, f"{base}/ckpt").awaitTermination()
    return f"{base}/ckpt"


@register("latest_from_state", with_views(LATEST_SQL))
def q_latest_from_state(spark, sf):
    """Latest state served from the checkpoint of a query that
    was stopped and resumed."""
    t = TM.light_from(TM.read_table(spark, sf, "events"), streaming_ts=True)

    def start(s, ckpt):
        w = ST.latest_state_query(s).writeStream.format("noop").outputMode("update")
        return w.option("checkpointLocation", ckpt).trigger(availableNow=True).start()

    return ST.latest_from_state(spark, stopped_and_resumed(spark, by_arrival(t, "state_in"), t.schema, start))


@register("stream_restart", with_views(f"SELECT * FROM vw WHERE window_start + to_seconds(60) <= {_wm(LONG_HOLD_S)}", f"vw AS ({_body(_vehicle_windows_sql(60))})"))
def q_stream_restart(spark, sf):
    """Tumbling windows of a query that was stopped after some files and
    resumed from its checkpoint equal those of one that never stopped."""
    e = TM.read_table(spark, sf, "events")
    feed = e.withColumn("arrival_time", F.timestamp_add("SECOND", (F.col("event_id") % 7) * 30, F.col("ts")))
    out = f"{ST.run_dir(spark, 'restart_out')}/out"

    def start(s, ckpt):
        s = s.drop("arrival_time")
        u = ST.signals(TM.light_from(s, streaming_ts=True), TM.events_from(s, streaming_ts=True))
        w = ST.vehicle_windows_stream(u, hold=f"{LONG_HOLD_S} seconds").writeStream.format("parquet").option("path", out)
        return w.option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start()

    stopped_and_resumed(spark, by_arrival(feed, "restart"), feed.schema, start)
    return _ntz(spark.read.parquet(out), ["window_start"])


ROUND_TRIP_BATCHES = 4


@register("stream_topic_roundtrip", with_views(
    f"SELECT *, 1 AS copies FROM vw WHERE window_start + to_seconds(60) <= {_wm(LONG_HOLD_S)}", f"vw AS ({_body(_vehicle_windows_sql(60))})"))
def q_stream_topic_roundtrip(spark, sf):
    """Closed windows are published to a topic in several batches,
    and a reader with a record limit gets every one of them once."""
    base = ST.run_dir(spark, "topic")
    e = TM.read_table(spark, sf, "events")
    feed = e.withColumn("arrival_time", F.timestamp_add("SECOND", (F.col("event_id") % 7) * 30, F.col("ts")))
    s = stream_of(spark, by_arrival(feed, "topic_in"), feed.schema).drop("arrival_time")
    w = ST.vehicle_windows_stream(ST.signals(TM.light_from(s, streaming_ts=True), TM.events_from(s, streaming_ts=True)), hold=f"{LONG_HOLD_S} seconds")
    SG.write_topic(w, f"{base}/topic", f"{base}/out_ckpt", trigger={"availableNow": True}).awaitTermination()
    most = -(-sum(SG.Topic(f"{base}/topic").ends().values()) // ROUND_TRIP_BATCHES)
    q = (
        SG.read_topic(spark, f"{base}/topic", max(1, most)).writeStream.format("parquet").option("path", f"{base}/back")
        .option("checkpointLocation", f"{base}/in_ckpt").trigger(processingTime="0 seconds").start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    row = F.from_json("value", w.schema)
    got = spark.read.schema(SG.MESSAGE).parquet(f"{base}/back").groupBy("partition", "offset").agg(F.count(F.lit(1)).cast("int").alias("copies"), F.max("value").alias("value"))
    return _ntz(got.select(row.alias("r"), "copies").select("r.*", "copies"), ["window_start"])


@register("stream_progress", with_views(
    "SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS dropped FROM tel"))
def q_stream_progress(spark, sf):
    """Counters of all batches from the log, which holds more of
    them than the query itself remembers."""
    t = _shuffled(spark, sf, "progress_in")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    path = f"{ST.run_dir(spark, 'progress')}/log"
    try:
        with ProgressLog(spark, path):
            ST.run_to_parquet(ST.sessions_stream(t, SESSION_GAP_TEST_S, f"{LONG_HOLD_S} seconds"), "progress_out")
    finally:
        spark.conf.set(key, before)
    log = read_progress(spark, path)
    return log.agg(F.sum("input_rows").alias("input_rows"), F.sum("dropped_by_watermark").alias("dropped"))


# ---------------------------------------------------------------------------
# The whole pipeline on JSON text
# ---------------------------------------------------------------------------

_PIPELINES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


PARTS_A_FILE = 2  # files of decoded rows to one of messages


def decoded_once(spark, lines: list[Feed], out: str, trigger: dict) -> list[DataFrame]:
    """The messages of a telemetry and an event feed, decoded by one query
    each, as streams of the same slices: decoding is most of a sink's work,
    and the sinks then share it."""
    checked = ST.check_streams(*[ST.text_source(spark, f"{b.path}/slice=*", b.files) for b in lines])
    # A feed of one file a slice may have too few rows for more.
    stored = [Feed(f"{out}/{n}", b.files * PARTS_A_FILE if b.files > 1 else 1) for n, b in zip(("t", "ev"), lines, strict=True)]
    queries = [ST.store_checked(c, f.path, f"{out}/_ckpt_{i}", f.files, trigger) for i, (c, f) in enumerate(zip(checked, stored, strict=True))]
    ST.run_to_end(spark, queries)
    for f in stored:
        _set_order(spark, f.path, SLICES_MOST)
    return [stream_of(spark, f, c.schema) for f, c in zip(stored, checked, strict=True)]


PIPE_FILE, PIPE_SLICE = 250_000, 1_500_000  # messages


def message_feeds(spark, sf: str) -> list[Feed]:
    """Telemetry (with faulty messages) and events as JSON lines in order of
    arrival. A row becomes text where it is written."""
    e = TM.read_table(spark, sf, "events")
    arrivals = e.select("event_id", TM.arrival_time())
    t = TM.with_odometer(e, fitting_bucket(e, ["user_id"], "ts")).join(arrivals, "event_id")
    ev = e.select("event_id", "ts", "user_id", "event_type", TM.arrival_time())

    def telemetry(d: DataFrame) -> DataFrame:
        return TM.telemetry_of(d, keep=("slice",)).select("slice", faulty_value())

    def events(d: DataFrame) -> DataFrame:
        return TM.events_from(d, keep=("slice",)).select("slice", DC.event_json().alias("value"))

    how = {"fmt": "text", "cols": ["value"], "file_rows": PIPE_FILE, "slice_rows": PIPE_SLICE, "like": arrivals}
    return [by_arrival(x, n, made=made, **how) for x, n, made in ((t, "pipe_t", telemetry), (ev, "pipe_ev", events))]


def pipeline_root(spark, sf: str) -> str:
    """Output folder of one pipeline run over the tables of ``sf``. The queries
    below read its tables, so one run serves them all. What a step has read to
    its end goes before the next one; the sink with most state runs first, alone."""
    runs = _PIPELINES.setdefault(spark, {})
    if sf not in runs:
        lines = message_feeds(spark, sf)
        root = ST.run_dir(spark, "pipeline")
        cfg = ST.Pipeline(root, hold=f"{LONG_HOLD_S} seconds", trigger={"availableNow": True})
        streams = decoded_once(spark, lines, f"{root}/_checked", cfg.trigger)
        for f in lines:
            delete_path(spark, f.path)
        starts = ST.pipeline_sinks(*ST.split_streams(*streams), cfg)
        for names in (["fleet_windows"], [n for n in starts if n != "fleet_windows"]):
            with ST.little_state(spark):
                running = [starts[n]() for n in names]
            ST.run_to_end(spark, running)
            for n in names:
                delete_path(spark, f"{root}/_ckpt/{n}")
        delete_path(spark, f"{root}/_checked")
        runs[sf] = root
    return runs[sf]


_GOOD = f"(SELECT * FROM tel WHERE seq NOT IN (SELECT event_id FROM events WHERE event_type IN ({_FAULTY})))"


@register("stream_pipeline_history", with_views(f"SELECT {TEL_COLS} FROM {_GOOD}"))
def q_stream_pipeline_history(spark, sf):
    return _ntz(SK.read_history(spark, f"{pipeline_root(spark, sf)}/telemetry_history"), ["event_time"]).select(*TELEMETRY_COLUMNS)


@register("stream_pipeline_events", with_views("SELECT event_id, vehicle_id, trip_id, event_time, event_type, coalesce(detail, '') AS detail FROM ev"))
def q_stream_pipeline_events(spark, sf):
    return _ntz(SK.read_history(spark, f"{pipeline_root(spark, sf)}/event_history"), ["event_time"]).select(*EVENT_COLUMNS)


@register("stream_pipeline_quarantine", f"SELECT CASE event_type {_CASES} END AS reason, count(*) AS messages FROM events WHERE event_type IN ({_FAULTY}) GROUP BY 1")
def q_stream_pipeline_quarantine(spark, sf):
    bad = spark.read.schema("raw string, reason string").parquet(f"{pipeline_root(spark, sf)}/quarantine")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@register("stream_pipeline_latest", with_views(LATEST_SQL.replace("FROM tel", f"FROM {_GOOD}")))
def q_stream_pipeline_latest(spark, sf):
    return ST.read_latest_state(spark, f"{pipeline_root(spark, sf)}/latest_state")


@register("stream_pipeline_windows", with_views(
    f"SELECT * FROM vw WHERE window_start + to_seconds(60) <= {_wm(LONG_HOLD_S)}",
    f"vw AS ({_body(_vehicle_windows_sql(60)).replace('FROM tel', f'FROM {_GOOD}')})"))
def q_stream_pipeline_windows(spark, sf):
    return _ntz(spark.read.parquet(f"{pipeline_root(spark, sf)}/vehicle_windows"), ["window_start"])


def _good(sql: str) -> str:
    return _body(sql).replace("FROM tel", f"FROM {_GOOD}")


@register("stream_pipeline_fleet", with_views(f"SELECT * FROM fw WHERE window_end <= {_wm(LONG_HOLD_S)}", f"fw AS ({_good(_fleet_windows_sql(300, 30))})"))
def q_stream_pipeline_fleet(spark, sf):
    return _ntz(spark.read.parquet(f"{pipeline_root(spark, sf)}/fleet_windows"), ["window_start", "window_end"])


@register("stream_pipeline_sessions", with_views(
    f"""SELECT vehicle_id, min(event_time) AS start_time, max(event_time) AS end_time, max(speed_kmh) AS max_speed_kmh, count(*) AS samples
FROM s2 GROUP BY vehicle_id, sess HAVING max(event_time) + to_seconds({SESSION_GAP_S}) <= (SELECT max(event_time) FROM {_GOOD}) - to_seconds({LONG_HOLD_S})""",
    f"s1 AS (SELECT *, lag(event_time) OVER (PARTITION BY vehicle_id ORDER BY event_time, seq) AS pt FROM {_GOOD})",
    f"""s2 AS (SELECT *, sum(CASE WHEN pt IS NULL OR {secs_sql('event_time', 'pt')} > CAST({float(SESSION_GAP_S)} AS DOUBLE) THEN 1 ELSE 0 END)
             OVER (PARTITION BY vehicle_id ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING) AS sess FROM s1)"""))
def q_stream_pipeline_sessions(spark, sf):
    return _ntz(spark.read.parquet(f"{pipeline_root(spark, sf)}/trip_sessions"), ["start_time", "end_time"])


@register("stream_pipeline_late", with_views(f"SELECT vehicle_id, count(*) AS late_rows FROM {_GOOD} GROUP BY 1"))
def q_stream_pipeline_late(spark, sf):
    """The feed's files are written long after its readings' times, so
    every good reading is reported."""
    late = spark.read.parquet(f"{pipeline_root(spark, sf)}/late_records")
    return late.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("late_rows"))
