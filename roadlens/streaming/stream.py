"""Structured Streaming jobs.

The same operators as the batch side, on streaming DataFrames:

* one watermark, set **after** the telemetry/event union (T2), so the dense
  telemetry stream moves event time even when the event stream is idle;
* tumbling windows and sessions in ``append`` mode (final rows once the
  watermark passes the window end plus the hold) or ``update`` mode for
  keyed sinks that are re-flushed on late changes (T3, T8);
* fleet sliding windows as two chained aggregations in append mode;
* keyed writes through ``foreachBatch`` so replays after a failure are
  idempotent (S18 re-aimed); raw history takes every reading, however late,
  and only the aggregates drop what is behind the watermark.

Every query keeps its own checkpoint under the shared folder named by
``spark.checkpoint.dir`` (never a machine-local folder).
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.signals import is_harsh
from roadlens.operators.windows import centi, exact_mean
from roadlens.session import ROCKSDB, checkpoint_root, free_shuffles
from roadlens.sources import decode as DC
from roadlens.sources import sinks as SK
from roadlens.sources.tables import last_write


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's output and checkpoint, under the shared
    root; it goes when the application ends."""
    base = f"{checkpoint_root(spark)}/roadlens-stream/{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return base


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------


def file_source(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 (file form): a folder of Parquet/JSON files read as a stream."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int) -> DataFrame:
    """Topic subscribed from the earliest offset; ``value`` is the JSON
    message and ``timestamp`` the broker arrival time (used by T7).
    ``max_offsets_per_trigger`` bounds a micro-batch over all partitions; size
    it by partitions x rate x trigger interval. Needs the Kafka connector on
    the classpath (not present in the test environment)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        .load()
        .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival_time"))
    )


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 (file form): a folder of JSON-lines files, one message a line, with
    the file's modification time as time of arrival."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select("value", F.col("_metadata.file_modification_time").alias("arrival_time"))


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Publish rows as JSON messages keyed by vehicle (windowed fan-out topic)."""
    out = df.select(F.col("vehicle_id").cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    return (
        out.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .start()
    )


def signals(t: DataFrame, ev: DataFrame, harsh=S.HARSH_TYPES) -> DataFrame:
    """Telemetry and driving events as one union (speed on telemetry rows,
    harsh flag on event rows), so one watermark covers both."""
    a = t.select("vehicle_id", "event_time", F.col("speed_kmh").cast("double").alias("speed_kmh"), F.lit(None).cast("int").alias("harsh_flag"))
    b = ev.select("vehicle_id", "event_time", F.lit(None).cast("double").alias("speed_kmh"), F.when(is_harsh("event_type", harsh), 1).otherwise(0).alias("harsh_flag"))
    return a.unionByName(b)


# ---------------------------------------------------------------------------
# Streaming operators
# ---------------------------------------------------------------------------


def vehicle_windows_stream(u: DataFrame, width: str = S.VEHICLE_WINDOW, hold: str = S.LATE_HOLD) -> DataFrame:
    """A3/T3 on a stream: watermark after the union, then one aggregation."""
    r = u.withWatermark("event_time", hold).groupBy("vehicle_id", F.window("event_time", width).alias("w")).agg(
        F.sum(centi()).alias("_s"),
        F.count("speed_kmh").alias("_n"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.sum("harsh_flag").cast("long").alias("harsh_event_count"),
    )
    return r.select(
        "vehicle_id",
        F.col("w.start").alias("window_start"),
        exact_mean(F.col("_s"), F.col("_n")).alias("avg_speed_kmh"),
        "max_speed_kmh",
        "harsh_event_count",
    )


def fleet_windows_stream(u: DataFrame, width: str = S.FLEET_WINDOW, slide: str = S.FLEET_SLIDE, hold: str = S.LATE_HOLD) -> DataFrame:
    """A6/T5 on a stream, as three chained aggregations in append mode: rows
    to (vehicle, pane of one slide), panes to (window, vehicle), windows. Only
    panes are expanded into the width / slide windows that hold them, and the
    first state keeps one record per vehicle and pane."""
    panes = u.withWatermark("event_time", hold).groupBy(F.window("event_time", slide).alias("pane"), "vehicle_id").agg(
        F.sum(centi()).alias("s"), F.count("speed_kmh").alias("n"), F.sum("harsh_flag").alias("h")
    )
    per_vehicle = panes.groupBy(F.window(F.window_time("pane"), width, slide).alias("window"), "vehicle_id").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("h").alias("h")
    )
    r = per_vehicle.groupBy("window").agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("_active"),
        F.sum("s").alias("_s"),
        F.sum("n").alias("_n"),
        F.sum("h").cast("long").alias("total_harsh_events"),
    )
    return r.select(
        F.to_date(F.col("window.start")).alias("day_bucket"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.when(F.col("_n") > 0, F.col("_active")).alias("vehicles_active"),
        exact_mean(F.col("_s"), F.col("_n")).alias("fleet_avg_speed_kmh"),
        "total_harsh_events",
    )


def sessions_stream(t: DataFrame, gap_s: int = S.SESSION_GAP_S, hold: str = S.LATE_HOLD) -> DataFrame:
    """T4 (gap rule) on a stream: ``session_window`` in append mode."""
    r = t.withWatermark("event_time", hold).groupBy("vehicle_id", F.session_window("event_time", f"{gap_s} seconds").alias("s")).agg(
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.count(F.lit(1)).alias("samples"),
    )
    return r.select("vehicle_id", "start_time", "end_time", "max_speed_kmh", "samples")


def history_writer(keys=("vehicle_id", "event_time"), order=("arrival_time", "seq")) -> Callable[[DataFrame, int, str], None]:
    """S9/S10 on a stream: every reading of the batch goes into the history,
    late ones too; of one key the last written stays."""

    def write(batch: DataFrame, epoch: int, out: str) -> None:
        SK.write_history(batch, out, keys, order, epoch)

    return write


def late_stream(t: DataFrame, arrival: str = "arrival_time", width: str = S.VEHICLE_WINDOW, hold: str = S.LATE_HOLD) -> DataFrame:
    """T7 on a stream: stateless filter, its own sink."""
    from roadlens.operators.quality import late_records

    return late_records(t, arrival, width, hold)


# ---------------------------------------------------------------------------
# Running queries
# ---------------------------------------------------------------------------


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's own settings come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def rocksdb_state(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Queries started inside keep their state in RocksDB, which the stateful
    processors need."""
    return _settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB})


def little_state(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Queries started inside keep the state of their last batches only, which
    they can resume from, instead of that of the last hundred."""
    return _settings(spark, {
        "spark.sql.streaming.minBatchesToRetain": "2",
        "spark.sql.streaming.stateStore.minDeltasForSnapshot": "1",
        "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
        "spark.sql.streaming.stateStore.compression.codec": "zstd",
    })


def run_to_end(spark: SparkSession, queries: list, every_s: int = 15) -> None:
    """Waits for queries that end by themselves. The shuffle files of their
    batches go meanwhile."""
    for q in queries:
        while not q.awaitTermination(every_s):
            free_shuffles(spark)
    free_shuffles(spark)


def run_to_parquet(df: DataFrame, name: str, mode: str = "append") -> str:
    """Run a streaming DataFrame over everything available (``availableNow``)
    into a Parquet folder; return the folder."""
    spark = df.sparkSession
    base = run_dir(spark, name)
    q = (
        df.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/ckpt")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return f"{base}/out"


def run_foreach_batch(df: DataFrame, name: str, fn: Callable[[DataFrame, int, str], None], mode: str = "update") -> str:
    """Run with a ``foreachBatch`` writer ``fn(batch, epoch, out_dir)``."""
    spark = df.sparkSession
    base = run_dir(spark, name)
    out = f"{base}/out"
    q = (
        df.writeStream.foreachBatch(lambda b, e: fn(b, e, out))
        .option("checkpointLocation", f"{base}/ckpt")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return out


def latest_state_writer(batch: DataFrame, epoch: int, out: str) -> None:
    """Append the batch's newest row per vehicle to the stored state; the
    newest reading wins, so a late tick never moves a vehicle backwards."""
    cols = ["vehicle_id", "lat", "lon", "speed_kmh", "engine_temp_c", "event_time", *(["seq"] if "seq" in batch.columns else [])]
    order = ["event_time", "seq"]
    newest = SK.dedup_latest(batch.select(*cols), ["vehicle_id"], order)
    table = SK.latest_table(batch.sparkSession, out)
    table.commit_and_compact(newest, last_write(["vehicle_id"], [c for c in order if c in cols]), epoch)


def read_latest_state(spark: SparkSession, out: str) -> DataFrame | None:
    """Stored latest state, projected like ``latest_state``; None if nothing
    was written."""
    from roadlens.functions.signals import iso_utc_seconds

    df = SK.latest_table(spark, out).read()
    return df and df.select(
        "vehicle_id", "lat", "lon", "speed_kmh", "engine_temp_c", iso_utc_seconds(F.col("event_time")).alias("updated_at")
    )


STATE_COLS = ("lat", "lon", "speed_kmh", "engine_temp_c", "event_time")


def latest_state_query(t: DataFrame) -> DataFrame:
    """S14 with nothing stored but the query's own state: each vehicle's newest
    reading. Run it in update mode; :func:`latest_from_state` serves it."""
    newest = F.max(F.struct("event_time", "seq", *[c for c in STATE_COLS if c != "event_time"]))
    return t.groupBy("vehicle_id").agg(newest.alias("newest"))


def latest_from_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Q1 from the checkpoint of a :func:`latest_state_query`, running or not:
    its last committed state, read with the state data source."""
    from roadlens.functions.signals import iso_utc_seconds

    rows = spark.read.format("statestore").load(checkpoint)
    (buffer,) = rows.schema["value"].dataType.names
    rows = rows.select(F.col("key.vehicle_id").alias("vehicle_id"), F.col(f"value.`{buffer}`").alias("newest"))
    at = iso_utc_seconds(F.col("newest.event_time")).alias("updated_at")
    return rows.select("vehicle_id", *[F.col(f"newest.{c}").alias(c) for c in STATE_COLS if c != "event_time"], at)


def progress_rows(query) -> list[dict]:
    """Per-batch counters and watermark from ``recentProgress``."""
    rows = []
    for p in query.recentProgress:
        rows.append(
            {
                "batch_id": p.get("batchId"),
                "input_rows": p.get("numInputRows"),
                "watermark": (p.get("eventTime") or {}).get("watermark"),
                "dropped_by_watermark": sum((s.get("numRowsDroppedByWatermark") or 0) for s in p.get("stateOperators", [])),
            }
        )
    return rows


@dataclass
class Pipeline:
    """Parameters of :func:`start_pipeline`."""

    out_root: str
    width: str = S.VEHICLE_WINDOW
    fleet_width: str = S.FLEET_WINDOW
    fleet_slide: str = S.FLEET_SLIDE
    gap_s: int = S.SESSION_GAP_S
    hold: str = S.LATE_HOLD
    trigger: dict = field(default_factory=lambda: {"processingTime": "5 seconds"})


def check_streams(telemetry: DataFrame, events: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S2-S7 on streams of messages: every message of either kind, decoded,
    with its ``reason`` (null for good ones); ``arrival_time`` is kept."""
    keep = ("arrival_time",)
    return DC.check_telemetry(telemetry, col, ntz=False, keep=keep), DC.check_event(events, col, ntz=False, keep=keep)


def split_streams(t: DataFrame, ev: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Streams of :func:`check_streams`, or what was stored of them, as
    (telemetry, events, quarantine)."""
    return DC.good_rows(t), DC.good_rows(ev), DC.bad_rows(t).unionByName(DC.bad_rows(ev))


def decode_streams(telemetry: DataFrame, events: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """S2-S7 on streams of messages: (telemetry, events, quarantine), decoded
    in one pass each; ``arrival_time`` is kept. Every sink decodes anew; many
    sinks read what :func:`store_checked` wrote instead."""
    return split_streams(*check_streams(telemetry, events, col))


def store_checked(checked: DataFrame, out: str, checkpoint: str, files: int, trigger: dict):
    """Starts the query that decodes each message once, for all sinks: batch n
    of a stream of :func:`check_streams` goes to ``<out>/slice=n``, in ``files``
    files; a batch that is replayed replaces its folder. The text of a good
    message, which no sink reads, is left out."""

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
        rows.repartition(files).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/slice={epoch}")

    return checked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_pipeline(t: DataFrame, ev: DataFrame, quarantine: DataFrame, cfg: Pipeline) -> list:
    """Decoded telemetry and event streams into raw history, event
    history, quarantine, tumbling, sliding, session, late-report and
    latest-state sinks; one query and one checkpoint per sink."""
    return [start() for start in pipeline_sinks(t, ev, quarantine, cfg).values()]


def pipeline_sinks(t: DataFrame, ev: DataFrame, quarantine: DataFrame, cfg: Pipeline) -> dict[str, Callable]:
    """What starts each sink's query of :func:`start_pipeline`, by its name."""
    root = cfg.out_root
    u = signals(t, ev)

    def rows(df, name):
        w = df.writeStream.format("parquet").option("path", f"{root}/{name}").option("compression", "zstd").outputMode("append")
        return w.option("checkpointLocation", f"{root}/_ckpt/{name}").trigger(**cfg.trigger).start()

    def keyed(df, name, write):
        w = df.writeStream.foreachBatch(lambda b, e: write(b, e, f"{root}/{name}"))
        return w.option("checkpointLocation", f"{root}/_ckpt/{name}").trigger(**cfg.trigger).start()

    sinks = {
        "telemetry_history": (keyed, t, history_writer()),
        "event_history": (keyed, ev, history_writer(("vehicle_id", "event_time", "event_id"))),
        "quarantine": (rows, quarantine),
        "vehicle_windows": (rows, vehicle_windows_stream(u, cfg.width, cfg.hold)),
        "fleet_windows": (rows, fleet_windows_stream(u, cfg.fleet_width, cfg.fleet_slide, cfg.hold)),
        "trip_sessions": (rows, sessions_stream(t, cfg.gap_s, cfg.hold)),
        "late_records": (rows, late_stream(t, width=cfg.width, hold=cfg.hold)),
        "latest_state": (keyed, t, latest_state_writer),
    }
    return {name: functools.partial(how, df, name, *write) for name, (how, df, *write) in sinks.items()}


def rows_added(query) -> int:
    """Rows taken in by a query over its recorded batches (the table is
    still growing when this rises between two looks)."""
    return sum(p.get("numInputRows") or 0 for p in query.recentProgress)
