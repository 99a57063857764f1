"""Keyed tables, the generic windowed rollup with a pandas UDF, and the
multi-sink streaming pipeline."""

import datetime as dt
import tempfile

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL, tel
from roadlens.operators import windows as W
from roadlens.plans import queries_stream as QS
from roadlens.plans.queries_serving import faulty_messages
from roadlens.schemas import EVENT_COLUMNS, TELEMETRY_COLUMNS
from roadlens.sources import decode as DC
from roadlens.sources import sinks as SK
from roadlens.sources import testmap as TM
from roadlens.sources.tables import KeyedTable, last_write
from roadlens.streaming import stream as ST

TRIP = "0123abcd-0000-4000-8000-0123456789ab"


def _path(name):
    return f"{tempfile.mkdtemp(prefix='roadlens-table-')}/{name}"


def _reading(spark, rows):
    """rows: (seconds, speed, arrival)"""
    t = tel(spark, [{"t": t, "speed": s, "seq": i} for i, (t, s, _) in enumerate(rows)])
    a = spark.createDataFrame([(i, x) for i, (_, _, x) in enumerate(rows)], "seq long, arrival_time long")
    return t.join(a, "seq").select("vehicle_id", "event_time", "speed_kmh", "arrival_time", "seq")


def test_writes_to_one_day_keep_both(spark):
    p = _path("h")
    SK.write_history(_reading(spark, [(t, t, 0) for t in range(5)]), p)
    SK.write_history(_reading(spark, [(t, 99, 1) for t in (3, 7, 90_000)]), p)
    got = {int((r.event_time - min(x.event_time for x in SK.read_history(spark, p).collect())).total_seconds()): r.speed_kmh for r in SK.read_history(spark, p).collect()}
    assert got == {0: 0.0, 1: 1.0, 2: 2.0, 3: 99.0, 4: 4.0, 7: 99.0, 90_000: 99.0}


def test_earlier_arrival_does_not_replace_a_later_one(spark):
    p = _path("h")
    SK.write_history(_reading(spark, [(1, 50, 10), (1, 60, 20)]), p)
    SK.write_history(_reading(spark, [(1, 70, 15)]), p)
    assert [r.speed_kmh for r in SK.read_history(spark, p).collect()] == [60.0]


def _bytes(spark, path):
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration())
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def _day_of(t, day):
    return t.where(F.to_date("event_time") == F.lit(day).cast("date"))


def test_replay_and_untouched_days(spark):
    p = _path("h")
    t = TM.telemetry_light(spark, SF_SMALL)
    SK.write_history(t, p, version=0)
    SK.write_history(t.limit(3), p, version=0)  # replay of epoch 0: nothing happens
    assert SK.read_history(spark, p).count() == t.count()
    table = SK.history_table(spark, p)
    assert len(table.compact()) == len(table.state().bases) > 3
    day = str(t.agg(F.min(F.to_date("event_time"))).first()[0])
    SK.write_history(_day_of(t, day), p, version=1)
    assert table.state().deltas[1].keys() == {day}
    assert table.compact() == [day]
    # Only that day was written again.
    assert [d for d, (b, _) in table.state().bases.items() if b == 1] == [day]
    SK.write_history(_day_of(t, day), p, version=1)  # replay after its entry was merged
    assert not table.state().deltas
    SK.write_history(_day_of(t, day), p, version=2)
    table.compact()
    # The first base lost that day; its other days are still in use.
    assert not table._exists(f"{p}/base/b=0/_day={day}") and len(table._children(f"{p}/base/b=0")) > 3
    assert not table._exists(f"{p}/delta/v=0") and not table._exists(f"{p}/log/0.json")
    got = SK.read_history(spark, p)
    assert got.count() == t.count() and got.exceptAll(t.select(*got.columns)).count() == 0


def test_a_batch_writes_its_own_rows_only(spark):
    p = _path("h")
    t = TM.telemetry_light(spark, SF_SMALL)
    SK.write_history(t, p)
    SK.history_table(spark, p).compact()
    whole = _bytes(spark, p)
    row = t.orderBy("event_time").limit(1)
    SK.write_history(row, p)
    one = _bytes(spark, p) - whole
    for _ in range(3):
        SK.write_history(row, p)
    more = _bytes(spark, p) - whole
    assert one < whole / 10 and more < 4.5 * one
    assert SK.read_history(spark, p).count() == t.count()


def test_compaction_waits_for_days_with_many_deltas(spark):
    p = _path("h")
    SK.write_history(_reading(spark, [(t, t, 0) for t in range(50)] + [(90_000, 1, 0)]), p)
    table = SK.history_table(spark, p)
    assert len(table.compact()) == 2
    SK.write_history(_reading(spark, [(3, 99, 1), (90_001, 2, 1)]), p)
    assert len(table.compact()) == 1  # the second day has as many new rows as old ones
    assert sum(table.state().deltas[1].values()) == 1
    got = {r.speed_kmh for r in SK.read_history(spark, p).collect()}
    assert got == {*map(float, range(50)), 99.0} - {3.0}
    days = sorted(table.state().days())
    assert SK.read_history(spark, p, days[1:]).count() == 2 and SK.read_history(spark, p, ["2000-01-01"]) is None


def test_index_leaves_files_closed(spark):
    p = _path("h")
    rows = [{"t": 60 * i, "v": f"veh_{v:04d}", "speed": v, "seq": 100 * v + i} for v in range(40) for i in range(20)]
    t = tel(spark, rows).select("vehicle_id", "event_time", "speed_kmh", "seq")
    SK.write_history(t, p)
    table = SK.history_table(spark, p)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # several files of a small day
    try:
        table.compact()
    finally:
        spark.conf.set(key, "true")
    files = [f for d in table._children(f"{p}/base/b=0") if d.startswith("_day=") for f in table._children(f"{p}/base/b=0/{d}") if f.startswith("part-")]
    assert len(files) >= 4
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    asked = spark.createDataFrame(
        [("veh_0003", at(60), at(240)), ("veh_0004", at(0), at(61)), ("veh_0004", at(0), at(1)), ("nobody", at(0), at(10**6)), ("veh_0039", at(10**6), at(2 * 10**6))],
        "vehicle_id string, since timestamp_ntz, until timestamp_ntz")
    assert 0 < len(table.files_for(asked, "vehicle_id", "event_time")) < len(files)
    read = lambda: sorted((r.vehicle_id, r.seq % 100) for r in table.read_requests(asked, "vehicle_id", "event_time").collect())
    want = [("veh_0003", 1), ("veh_0003", 2), ("veh_0003", 3), ("veh_0004", 0), ("veh_0004", 0), ("veh_0004", 1)]
    assert read() == want
    SK.write_history(tel(spark, [{"t": 100, "v": "veh_0003", "speed": 1, "seq": 350}]).select(*t.columns), p)
    assert read() == sorted([*want, ("veh_0003", 50)])  # a day with deltas is merged
    assert table.files_for(asked.limit(0), "vehicle_id", "event_time") == []


def test_sink_compacts_now_and_then(spark, monkeypatch):
    from roadlens.sources import tables

    monkeypatch.setattr(tables, "COMPACT_EVERY", 3)
    p = _path("h")
    for i in range(7):
        SK.write_history(_reading(spark, [(i, i, i), (0, 10 * i, i)]), p, version=i)
    st = SK.history_table(spark, p).state()
    assert [n for _, n in st.bases.values()] == [6] and sorted(st.deltas) == [6] and st.through == 6
    got = {r.speed_kmh for r in SK.read_history(spark, p).collect()}
    assert got == {60.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0}


def test_unreadable_state_fails_the_read(spark):
    p = _path("h")
    SK.write_history(_reading(spark, [(1, 1, 0)]), p)
    table = SK.history_table(spark, p)
    table._delete(f"{p}/delta/v=0")
    SK.write_history(_reading(spark, [(2, 2, 0)]), p)
    with pytest.raises(AnalysisException):
        SK.read_history(spark, p)
    with pytest.raises(AnalysisException):
        table.compact()


def test_half_written_batch_is_not_read(spark):
    p = _path("h")
    SK.write_history(_reading(spark, [(1, 1, 0)]), p)
    _reading(spark, [(1, 5, 9)]).write.parquet(f"{p}/delta/v=1")
    table = SK.history_table(spark, p)
    table._fs(p)[0].create(table._fs(f"{p}/log/1.json.tmp")[1], True).close()
    assert table.version() == 0
    SK.write_history(_reading(spark, [(2, 2, 0)]), p)
    assert sorted(r.speed_kmh for r in SK.read_history(spark, p).collect()) == [1.0, 2.0]


def test_rows_without_a_day_are_refused(spark):
    table = KeyedTable(spark, _path("h"), F.to_date("event_time"))
    bad = _reading(spark, [(1, 1, 0)]).withColumn("event_time", F.lit(None).cast("timestamp_ntz"))
    with pytest.raises(ValueError, match="day"):
        table.commit(bad, last_write(["vehicle_id"], ["arrival_time"]))
    assert SK.read_history(spark, table.path) is None


def test_columns_of_one_row_from_two_writers(spark):
    p = _path("w")
    keys = ["vehicle_id", "window_start"]
    rows = lambda v: spark.createDataFrame([(k, dt.datetime(2024, 1, 1), a, h) for k, a, h in v], "vehicle_id string, window_start timestamp_ntz, a double, h long")
    SK.write_columns(rows([("x", 1.0, None), ("y", 2.0, None)]), p, keys, ["a"])
    SK.write_columns(rows([("y", None, 5), ("z", None, 6)]), p, keys, ["h"])
    SK.write_columns(rows([("x", 7.0, None)]), p, keys, ["a"])
    table = KeyedTable(spark, p, F.to_date("window_start"), keys)
    assert len(table.compact()) == 1
    SK.write_columns(rows([("y", None, 9)]), p, keys, ["h"])
    SK.write_columns(rows([("y", None, 5)]), p, keys, ["h"])
    got = {r.vehicle_id: (r.a, r.h) for r in SK.read_history(spark, p).collect()}
    assert got == {"x": (7.0, None), "y": (2.0, 5), "z": (None, 6)}


def test_fleet_windows_in_two_writes(spark):
    p = _path("f")
    fw = W.fleet_windows(TM.telemetry_light(spark, SF_SMALL), TM.driving_events(spark, SF_SMALL), "7200 seconds", "1800 seconds")
    early = F.hour("window_start") < 12
    SK.write_fleet_windows(fw.where(early), p)
    SK.write_fleet_windows(fw.where(~early), p)
    SK.write_fleet_windows(fw, p)
    got = SK.read_history(spark, p)
    assert got.count() == fw.count() and got.exceptAll(fw.select(*got.columns)).count() == 0


def test_windowed_accepts_pandas_grouped_agg(spark):
    @F.pandas_udf("double")
    def spread(v: pd.Series) -> float:
        return float(v.max() - v.min())

    t = tel(spark, [{"t": 1, "speed": 10}, {"t": 2, "speed": 40}, {"t": 70, "speed": 5}])
    # Spark does not mix pandas aggregates with built-in ones in one groupBy.
    out = W.windowed(t, ["vehicle_id"], "60 seconds", {"spread": spread("speed_kmh")})
    got = sorted(r.spread for r in out.collect())
    assert got == [0.0, 30.0]


def test_pipeline_fills_all_sinks(spark):
    root = QS.pipeline_root(spark, SF_SMALL)
    n = TM.read_table(spark, SF_SMALL, "events").count()
    history = SK.read_history(spark, f"{root}/telemetry_history")
    bad = spark.read.parquet(f"{root}/quarantine").count()
    assert history.count() + bad == n and bad > 0
    assert len(history.columns) == 19  # 18 fields and the time of arrival
    assert SK.read_history(spark, f"{root}/event_history").count() == n
    for name in ("vehicle_windows", "fleet_windows", "late_records"):
        assert spark.read.parquet(f"{root}/{name}").count() > 0
    assert ST.read_latest_state(spark, f"{root}/latest_state").count() == TM.vehicles(spark, SF_SMALL).count()


def test_messages_are_decoded_once_for_all_sinks(spark):
    """the sinks read stored rows, in the slices of the messages,
    and none of them parses text."""
    ts = lambda i: f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}Z"
    tel_ = [f'{{"vehicle_id":"v{i % 3}","ts":"{ts(i)}","lat":1,"lon":2,"heading_deg":0,"speed_kmh":"{i}","gear":3.0,"rpm":900,"throttle_pct":1,"maf_g_per_s":1,'
            f'"engine_temp_c":80,"coolant_temp_c":75,"intake_air_temp_c":30,"fuel_pct":50,"ignition_on":true,"odometer_km":1,"fuel_consumed_l":1}}' for i in range(100)]
    tel_[7], tel_[8], tel_[60] = tel_[7][:-1], tel_[8].replace('"rpm":900', '"rpm":"fast"'), tel_[9]
    ev = [f'{{"event_id":"{TRIP}","vehicle_id":"v1","ts":"{ts(i)}","event_type":"idling"}}' if i else "no message" for i in range(50)]
    feeds = []
    for name, lines in (("once_t", tel_), ("once_ev", ev)):
        df = spark.createDataFrame([(v, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i, v in enumerate(lines)], "value string, arrival_time timestamp")
        feeds.append(QS.by_arrival(df, name, fmt="text", cols=["value"]))
    out = _path("checked")
    t, e = QS.decoded_once(spark, feeds, out, {"availableNow": True})
    assert t.columns == ["arrival_time", *TELEMETRY_COLUMNS, "raw", "reason"] and e.columns == ["arrival_time", *EVENT_COLUMNS, "raw", "reason"]
    sinks = ST.split_streams(t, e)
    assert all("from_json" not in s._jdf.queryExecution().analyzed().toString() for s in sinks)
    seen = []
    ST.run_foreach_batch(sinks[0], "once", lambda b, epoch, _: seen.append((epoch, sorted(r.speed_kmh for r in b.collect()))), "append")
    want = sorted(float(i) if i != 60 else 9.0 for i in range(100) if i not in (7, 8))
    assert sorted(x for _, part in seen for x in part) == want
    assert len(seen) == QS.SLICES and [x for x in seen[0][1]] == [float(i) for i in range(len(seen[0][1]) + 2) if i not in (7, 8)]
    bad = spark.read.schema("raw string, reason string").parquet(ST.run_to_parquet(sinks[2], "once_bad"))
    assert sorted(map(tuple, bad.collect())) == sorted([(tel_[7], "malformed_json"), (tel_[8], "bad_value"), ("no message", "malformed_json")])


def test_pipeline_leaves_only_its_tables(spark):
    """Feeds, decoded rows and checkpoints go once they were read to
    their end."""
    root = QS.pipeline_root(spark, SF_SMALL)
    table = KeyedTable(spark, root, F.lit(None))
    tables = {"telemetry_history", "event_history", "quarantine", "vehicle_windows", "fleet_windows", "trip_sessions", "late_records", "latest_state"}
    assert set(table._children(root)) - {"_ckpt"} == tables
    assert table._children(f"{root}/_ckpt") == []
    files = [f for f in table._children(f"{root}/vehicle_windows") if f.startswith("part-")]
    assert files and all(".zstd." in f for f in files)


def test_message_feeds_are_the_joined_messages(spark):
    """Texts are made after rows were dealt out, packed, and are those
    of the views; keys that repeat give the same rows as the join did."""
    src = _path("sf")
    e = TM.read_table(spark, SF_SMALL, "events").limit(200)
    odd = e.limit(3).unionByName(e.limit(1).withColumn("event_id", F.lit(None).cast("long"))).unionByName(e.limit(2).withColumn("user_id", F.lit(None).cast("long")))
    e.unionByName(odd).coalesce(1).write.parquet(f"{src}/events.parquet")
    feeds = QS.message_feeds(spark, src)
    t = faulty_messages(spark, src).join(TM.telemetry_light(spark, src).select("seq"), "seq").select("value")
    ev = TM.driving_events(spark, src).select(DC.event_json().alias("value"))
    for feed, want in zip(feeds, (t, ev), strict=True):
        table = KeyedTable(spark, feed.path, F.lit(None))
        slices = [n for n in table._children(feed.path) if n.startswith("slice=")]
        assert all(f.endswith(".gz") for s in slices for f in table._children(f"{feed.path}/{s}") if f.startswith("part-"))
        got = spark.read.text(feed.path).select("value")
        assert got.count() == want.count() > 200 and got.exceptAll(want).count() == 0
        assert len(slices) == QS.SLICES


def test_text_of_good_messages_is_not_stored(spark):
    src, out = _path("src"), _path("checked")
    good = f'{{"event_id":"{TRIP}","vehicle_id":"v1","ts":"2024-01-01T00:00:00Z","event_type":"idling"}}'
    spark.createDataFrame([(good,), ("[",)], "value string").coalesce(1).write.text(src)
    _, ev = ST.check_streams(*[ST.text_source(spark, src)] * 2)
    ST.store_checked(ev, out, _path("ckpt"), 1, {"availableNow": True}).awaitTermination()
    got = sorted(((r.vehicle_id, r.raw, r.reason) for r in spark.read.parquet(f"{out}/slice=0").collect()), key=str)
    assert got == [("v1", None, None), (None, "[", "malformed_json")]


def test_a_replayed_batch_of_decoded_rows_replaces_its_folder(spark):
    """Its checkpoint lost, the query writes batch 0 again and doubles nothing."""
    src, out = _path("src"), _path("checked")
    spark.createDataFrame([("{}",), ("[",), ("{}",)], "value string").coalesce(1).write.text(src)
    for n in ("a", "b"):
        t, _ = ST.check_streams(*[ST.text_source(spark, src)] * 2)
        ST.store_checked(t, out, _path(n), 1, {"availableNow": True}).awaitTermination()
    got = spark.read.parquet(f"{out}/slice=0")
    assert sorted(r.reason for r in got.collect()) == ["malformed_json", "missing_field", "missing_field"]


def test_no_state_yet(spark):
    assert ST.read_latest_state(spark, _path("l")) is None
