"""Batch = stream, late data, and restart from a checkpoint."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from roadlens.operators import windows as W
from roadlens.sources import testmap as TM
from roadlens.streaming import stream as ST


def _both(es):
    return ST.signals(TM.light_from(es, streaming_ts=True), TM.events_from(es, streaming_ts=True))


def _split_by_day(spark, base):
    """Write the small events table as one file per day, oldest first."""
    e = TM.read_table(spark, SF_SMALL, "events")
    days = [r.d for r in e.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    for i, d in enumerate(days):
        e.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.mode("overwrite").parquet(f"{base}/in/day={i:03d}")
    return e.schema, len(days)


def test_stream_equals_batch_for_closed_windows_and_restart(spark):
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    schema, n_days = _split_by_day(spark, base)

    def run(max_files):
        es = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files)).parquet(f"{base}/in/*")
        q = (
            ST.vehicle_windows_stream(_both(es), width="3600 seconds")
            .writeStream.format("parquet")
            .option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/ckpt")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        return q

    q1 = run(5)
    first = spark.read.parquet(f"{base}/out").count()
    # restart from the checkpoint: nothing new, same result
    run(5)
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == first
    batch = W.vehicle_windows(TM.telemetry_light(spark, SF_SMALL), TM.driving_events(spark, SF_SMALL), width="3600 seconds")
    mx = TM.read_table(spark, SF_SMALL, "events").agg(F.max("ts")).first()[0]
    wm = F.timestamp_add("SECOND", F.lit(-75), F.lit(str(mx)).cast("timestamp_ntz"))
    closed = batch.where(F.timestamp_add("SECOND", F.lit(3600), F.col("window_start")) <= wm)
    g = got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert g.exceptAll(closed.select(*g.columns)).count() == 0
    assert closed.select(*g.columns).exceptAll(g).count() == 0
    assert len(q1.recentProgress) >= 1
    assert ST.rows_added(q1) == 2 * TM.read_table(spark, SF_SMALL, "events").count()  # telemetry + event rows


def test_late_tick_is_dropped_and_reported(spark):
    import datetime as dt

    base = tempfile.mkdtemp(prefix="roadlens-late-")
    e = TM.read_table(spark, SF_SMALL, "events")
    mx = e.agg(F.max("ts")).first()[0]
    e.write.parquet(f"{base}/in/a")
    late = spark.createDataFrame(
        [(10**9, mx - dt.timedelta(minutes=15), 1, "view", 55.0, "{}")], e.schema
    )
    es = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", "1").parquet(f"{base}/in/*")
    out = f"{base}/out"
    q = (
        ST.vehicle_windows_stream(_both(es))
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{base}/ckpt")
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    late.write.parquet(f"{base}/in/b")
    q = (
        ST.vehicle_windows_stream(_both(es))
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{base}/ckpt")
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    dropped = sum(r["dropped_by_watermark"] for r in ST.progress_rows(q))
    assert dropped >= 1
    got = spark.read.parquet(out).where(F.col("vehicle_id") == "veh_0001")
    late_minute = (mx - dt.timedelta(minutes=15)).replace(second=0, microsecond=0)
    assert got.where(F.col("window_start").cast("timestamp_ntz") == F.lit(str(late_minute)).cast("timestamp_ntz")).count() == 0
    # the late report (arrival column = processing time) still sees it
    lt = TM.light_from(late).withColumn("arrival_time", F.lit(str(mx)).cast("timestamp_ntz"))
    from roadlens.operators.quality import late_records

    assert late_records(lt).count() == 1


def test_stream_detect_events_over_many_batches_equals_batch(spark):
    """The stateful detector seeded from its state at every micro-batch
    (previous reading, carried heading, clocks, rule set, fuel trip) gives
    the batch result."""
    from roadlens.operators import detect as DT
    from roadlens.plans.queries_batch import TEST_LIMIT_KMH
    from roadlens.streaming import processors as PR

    base = tempfile.mkdtemp(prefix="roadlens-test-")
    schema, _n_days = _split_by_day(spark, base)
    es = spark.readStream.schema(schema).option("maxFilesPerTrigger", "3").parquet(f"{base}/in/*")
    q = (
        PR.detect_events_stream(TM.light_from(es, streaming_ts=True), TEST_LIMIT_KMH)
        .writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/ckpt")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert sum(1 for p in q.recentProgress if p.get("numInputRows")) >= 3
    cols = ["vehicle_id", "trip_id", "event_time", "event_type"]
    got = spark.read.parquet(f"{base}/out").withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).select(*cols)
    mx = TM.read_table(spark, SF_SMALL, "events").agg(F.max("ts")).first()[0]
    wm = F.timestamp_add("SECOND", F.lit(-75), F.lit(str(mx)).cast("timestamp_ntz"))
    exp = DT.detect_events(TM.telemetry_light(spark, SF_SMALL), limit_kmh=TEST_LIMIT_KMH).select(*cols).where(F.col("event_time") < wm)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert exp.count() > 10


def test_stream_trip_sessions_over_many_batches_equals_batch(spark):
    """Gap + ignition sessions carried across micro-batches (open session in
    state, one event-time timer) equal the batch sessions that the final
    watermark has closed."""
    from roadlens.operators import sessions as SS
    from roadlens.plans.queries_batch import SESSION_GAP_TEST_S
    from roadlens.streaming import processors as PR

    base = tempfile.mkdtemp(prefix="roadlens-test-")
    schema, _n_days = _split_by_day(spark, base)
    es = spark.readStream.schema(schema).option("maxFilesPerTrigger", "3").parquet(f"{base}/in/*")
    q = (
        PR.trip_sessions_stream(TM.light_from(es, streaming_ts=True), SESSION_GAP_TEST_S)
        .writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/ckpt")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert sum(1 for p in q.recentProgress if p.get("numInputRows")) >= 3
    cols = ["vehicle_id", "start_time", "end_time", "distance_km", "max_speed_kmh", "samples"]
    got = spark.read.parquet(f"{base}/out")
    got = got.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_time") else F.col(c) for c in cols])
    mx = TM.read_table(spark, SF_SMALL, "events").agg(F.max("ts")).first()[0]
    wm = F.timestamp_add("SECOND", F.lit(-75), F.lit(str(mx)).cast("timestamp_ntz"))
    batch = SS.trip_sessions(TM.telemetry_light(spark, SF_SMALL), gap_s=SESSION_GAP_TEST_S)
    closed = batch.where(~F.col("is_open") | (F.timestamp_add("SECOND", F.lit(int(SESSION_GAP_TEST_S)), F.col("end_time")) <= wm))
    exp = closed.select(*cols)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert exp.count() > 10


def _feed(spark, base, batches):
    """Readings (seconds, speed, ignition) of one vehicle, one file a batch."""
    from conftest import tel

    schema = None
    for i, rows in enumerate(batches):
        df = tel(spark, [{"t": t, "speed": s, "ign": g, "seq": int(t * 10)} for t, s, g in rows])
        df = df.withColumn("event_time", F.col("event_time").cast("timestamp"))
        schema = df.schema
        df.coalesce(1).write.parquet(f"{base}/in/b={i}")
    return ST.file_source(spark, f"{base}/in/*", schema, max_files_per_trigger=1)


def _run(df, base):
    q = (
        df.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q, df.sparkSession.read.schema(df.schema).parquet(f"{base}/out")


def test_readings_out_of_order_inside_the_hold_are_kept(spark):
    from roadlens.streaming import processors as PR

    base = tempfile.mkdtemp(prefix="roadlens-test-")
    es = _feed(spark, base, [[(0, 10, True), (10, 20, True), (60, 30, True)], [(30, 90, True), (70, 40, True)], [(2000, 1, True)], [(2010, 1, True)]])
    q, out = _run(PR.trip_sessions_stream(es, 300), base)
    rows = out.collect()
    assert [(r.samples, r.max_speed_kmh) for r in rows] == [(5, 90.0)]
    assert sum(r["dropped_by_watermark"] for r in ST.progress_rows(q)) == 0


def test_edges_are_found_in_event_time_order(spark):
    from conftest import tel
    from roadlens.operators import detect as DT
    from roadlens.streaming import processors as PR

    rows = [(t, s, True) for t, s in enumerate([60, 49, 38, 38, 52, 66, 66, 40, 40, 70])]
    shuffled = [[rows[i] for i in part] for part in ([2, 0, 5], [1, 4, 3], [9, 6], [8, 7])]
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    es = _feed(spark, base, [*shuffled, [(5000, 0, True)], [(5001, 0, True)]])
    _, out = _run(PR.detect_events_stream(es, 200.0), base)
    t = tel(spark, [{"t": t, "speed": s, "seq": t * 10} for t, s, _ in rows])
    want = DT.detect_events(t, limit_kmh=200.0).withColumn("event_time", F.col("event_time").cast("timestamp"))
    key = lambda d: sorted((r.event_time, r.event_type) for r in d.where("event_time < timestamp'2024-01-01 00:30:00'").collect())
    assert key(out) == key(want) and len(key(want)) > 3


def test_late_reading_is_dropped_from_sessions_but_kept_in_history(spark):
    from roadlens.sources import sinks as SK
    from roadlens.streaming import processors as PR

    base = tempfile.mkdtemp(prefix="roadlens-test-")
    batches = [[(0, 10, True), (900, 10, True)], [(901, 5, True)], [(20, 77, True)], [(5000, 1, True)], [(5001, 1, True)]]
    es = _feed(spark, base, batches)
    q, out = _run(PR.trip_sessions_stream(es, 300), base)
    assert max(r.max_speed_kmh for r in out.collect()) == 10.0
    assert sum(r["dropped_by_watermark"] for r in ST.progress_rows(q)) == 1
    path = ST.run_foreach_batch(es, "test_history", ST.history_writer(), mode="append")
    assert SK.read_history(spark, path).count() == 6


def test_processors_ask_for_rocksdb(spark):
    import pytest

    from roadlens.streaming import processors as PR

    key = "spark.sql.streaming.stateStore.providerClass"
    es = _feed(spark, tempfile.mkdtemp(prefix="roadlens-test-"), [[(0, 1, True)]])
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            PR.trip_sessions_stream(es)
    finally:
        spark.conf.set(key, before)
