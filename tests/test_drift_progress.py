"""Payload drift, the progress log and serving from a query's state."""

import tempfile

from roadlens.plans import queries_stream as QS
from roadlens.sources import drift as DR
from roadlens.streaming import progress as PG
from roadlens.streaming import stream as ST
from test_stream import _feed


def test_payload_drift(spark):
    rows = ['{"a": 1, "b": "x"}', '{"a": 2.5, "b": null, "new": [1]}', '{"a": "1"}', "{broken", "[1]", "7", None, "{}"]
    m = spark.createDataFrame([(r,) for r in rows], "value string")
    drift = DR.payload_drift(m, {"a": "number", "b": "string", "c": "boolean"}).select("verdict", "messages", "field", "kind")
    assert {tuple(r) for r in drift.where("field IS NOT NULL").collect()} == {
        ("ok", 2, "a", "number"), ("type", 1, "a", "string"), ("ok", 1, "b", "string"), ("type", 1, "b", "null"), ("unknown", 1, "new", "array"),
        ("missing", 5, "a", None), ("missing", 6, "b", None), ("missing", 8, "c", None),
    }
    bad = {(r.kind, r.messages) for r in DR.payload_drift(m, {}).where("field IS NULL").collect()}
    assert bad == {("malformed", 2), ("array", 1), ("number", 1)}
    assert DR.payload_drift(m.limit(0), {"a": "number"}).collect() == []


def test_progress_log_keeps_every_batch(spark):
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    es = _feed(spark, base, [[(t, 1, True)] for t in (0, 5000, 10_000, 15_000)] + [[(20, 1, True), (20_000, 1, True)]])
    with PG.ProgressLog(spark, f"{base}/log"):
        ST.run_to_parquet(ST.sessions_stream(es, 300), "log_test")
    log = PG.read_progress(spark, f"{base}/log").collect()
    assert sum(r.input_rows for r in log) == 6 and sum(r.dropped_by_watermark for r in log) == 1
    assert len({r.batch_id for r in log}) >= 5 and len({r.run_id for r in log}) == 1


def test_feed_keeps_rows_without_arrival(spark, monkeypatch):
    monkeypatch.setattr(QS, "FILE_ROWS", 10)
    monkeypatch.setattr(QS, "SLICE_FILES", 2)
    d = spark.range(200).selectExpr("id", "CASE WHEN id % 7 > 0 THEN timestamp_seconds(1000 - id) END AS arrival_time")
    feed = QS.by_arrival(d, "feed_test")
    assert feed.files == 2
    back = spark.read.parquet(feed.path)
    assert back.count() == 200 and back.where("arrival_time IS NULL AND slice > 0").count() == 0
    low = {r.slice: (r.a, r.b) for r in back.groupBy("slice").agg({"arrival_time": "min"}).withColumnRenamed("min(arrival_time)", "a")
           .join(back.groupBy("slice").agg({"arrival_time": "max"}).withColumnRenamed("max(arrival_time)", "b"), "slice").collect()}
    assert len(low) == 10 and all(low[i][1] < low[i + 1][0] for i in range(9))
    assert QS.stream_of(spark, feed, d.schema).isStreaming
