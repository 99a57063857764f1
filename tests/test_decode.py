import datetime as dt

from pyspark.sql import functions as F

from conftest import T0, tel
from roadlens.functions.signals import rush_factor
from roadlens.sources import decode as DC
from roadlens.sources import sinks as SK


def _msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


GOOD = (
    '{"vehicle_id":"veh_0001","trip_id":null,"ts":"%s","lat":-6.2,"lon":106.8,"heading_deg":90.0,'
    '"speed_kmh":55.0,"gear":3,"rpm":2500,"throttle_pct":40.0,"maf_g_per_s":12.0,"engine_temp_c":90.0,'
    '"coolant_temp_c":85.0,"intake_air_temp_c":30.0,"fuel_pct":60.0,"fuel_consumed_l":1.2,"odometer_km":1000.0,"ignition_on":true}'
)


def test_timestamp_forms_are_equal(spark):
    df = DC.decode_telemetry(_msgs(spark, [GOOD % "2024-01-01T00:00:00Z", GOOD % "2024-01-01T00:00:00+00:00", GOOD % "2024-01-01T07:00:00+07:00"]))
    assert {r.event_time for r in df.collect()} == {T0}


def test_bad_json_is_quarantined(spark):
    good, bad = DC.split_malformed(_msgs(spark, [GOOD % "2024-01-01T00:00:00Z", '{"ts":', '{"vehicle_id":"v"}']))
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["malformed_json", "missing_field"]


def test_encode_decode_round_trip(spark):
    t = tel(spark, [{"t": 1.5, "speed": 12.34, "trip": "6f9619ff-8b86-d011-b42d-00c04fc964ff"}]).select(
        "vehicle_id", "trip_id", "event_time", "lat", "lon", "heading_deg", "speed_kmh",
        F.lit(2).alias("gear"), F.lit(900).alias("rpm"), F.lit(5.0).alias("throttle_pct"), F.lit(1.0).alias("maf_g_per_s"),
        "engine_temp_c", F.lit(80.0).alias("coolant_temp_c"), F.lit(30.0).alias("intake_air_temp_c"), "fuel_pct",
        F.lit(0.5).alias("fuel_consumed_l"), F.lit(10.0).alias("odometer_km"), "ignition_on",
    )
    back = DC.decode_telemetry(DC.encode_telemetry(t))
    assert back.collect() == t.collect()


def test_latest_keeps_newer_event_time(spark):
    from roadlens.operators.serve import latest_state

    t = tel(spark, [{"t": 100, "speed": 1, "seq": 0}, {"t": 50, "speed": 2, "seq": 1}])  # older arrives later
    r = latest_state(t).first()
    assert r.speed_kmh == 1.0 and r.updated_at == "2024-01-01T00:01:40Z"


def test_duplicate_tick_collapses(spark):
    t = tel(spark, [{"t": 5, "speed": 1, "seq": 0}, {"t": 5, "speed": 2, "seq": 1}]).withColumn(
        "arrival_time", F.col("event_time")
    )
    out = SK.dedup_latest(t, ["vehicle_id", "event_time"]).collect()
    assert len(out) == 1 and out[0].speed_kmh == 2.0


def test_rush_hour_in_local_time(spark):
    t = tel(spark, [{"t": dt.datetime(2024, 1, 1, 0, 30)}, {"t": dt.datetime(2024, 1, 1, 3, 0)}])
    got = [r.f for r in t.orderBy("event_time").select(rush_factor().alias("f")).collect()]
    assert got == [0.6, 0.95]


def test_missing_fields(spark):
    m = DC.missing_fields(_msgs(spark, ['{"a":1,"b":2}', '{"a":1}', "nope"]), "value", ["a", "b"])
    assert [r.missing_fields for r in m.collect()] == [[], ["b"], ["a", "b"]]


def test_upsert_columns(spark):
    target = spark.createDataFrame([("k1", 1.0, None), ("k2", 2.0, None)], "k string, a double, h long")
    upd = spark.createDataFrame([("k2", 5), ("k3", 7)], "k string, h long")
    out = {r.k: (r.a, r.h) for r in SK.upsert_columns(target, upd, ["k"], ["h"]).collect()}
    assert out == {"k1": (1.0, None), "k2": (2.0, 5), "k3": (None, 7)}


def test_clean_uuid(spark):
    df = spark.createDataFrame([("",), ("6F9619FF-8B86-D011-B42D-00C04FC964FF",), ("nope",), (None,)], "u string")
    got = [(r.c, r.bad) for r in df.select(DC.clean_uuid("u").alias("c"), DC.uuid_is_bad("u").alias("bad")).collect()]
    assert got == [(None, False), ("6f9619ff-8b86-d011-b42d-00c04fc964ff", False), (None, True), (None, False)]


def test_load_vehicles(spark, tmp_path):
    from conftest import SF_SMALL
    from roadlens.sources import testmap as TM

    v = TM.vehicles(spark, SF_SMALL)
    v.write.parquet(str(tmp_path / "veh"))
    back = SK.load_vehicles(spark, str(tmp_path / "veh"))
    assert back.count() == v.count() and back.columns == v.columns


def test_each_fault_has_its_reason(spark):
    ok = GOOD % "2024-01-01T00:00:00Z"
    cases = {
        ok: None,
        ok.replace('"gear":3,', '"gear":3.0,').replace('"speed_kmh":55.0', '"speed_kmh":"55"'): None,
        ok.replace('"lat":-6.2', '"lat":null'): "missing_field",
        ok.replace('"rpm":2500', '"rpm":"fast"'): "bad_value",
        ok.replace('"speed_kmh":55.0', '"speed_kmh":"NaN"'): "bad_value",
        ok.replace('"trip_id":null', '"trip_id":"trip-7"'): "bad_uuid",
        ok.replace('"trip_id":null', '"trip_id":""'): None,
        GOOD % "yesterday": "bad_value",
        "[1]": "malformed_json",
        "": "malformed_json",
        "nonsense": "malformed_json",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, value string")
    got = {r.i: r.reason for r in DC.check_telemetry(df, keep=("i",)).collect()}
    assert got == dict(enumerate(cases.values()))
    good, bad = DC.split_malformed(_msgs(spark, list(cases)))
    assert good.count() == 3 and bad.count() == 8
    assert {(r.gear, r.speed_kmh) for r in good.collect()} == {(3, 55.0)}


def test_tagged_lines_none_is_lost(spark, tmp_path):
    lines = ['{"kind":"telemetry",' + (GOOD % "2024-01-01T00:00:00Z")[1:], '{"kind":"event","event_id":"x"}', '{"kind":"other"}', '{"a":1}', "nope"]
    (tmp_path / "f.jsonl").write_text("\n".join(lines))
    t, ev, bad = DC.read_tagged_jsonl(spark, str(tmp_path))
    assert t.count() == 1 and ev.count() == 0
    assert sorted(r.reason for r in bad.collect()) == ["malformed_json", "missing_field", "unknown_kind", "unknown_kind"]


def test_latest_state_takes_one_reading(spark):
    from roadlens.operators.serve import latest_state

    t = tel(spark, [{"t": 5, "speed": 1, "lat": 1, "seq": 0}, {"t": 5, "speed": 2, "lat": 2, "seq": 1}])
    r = latest_state(t).first()
    assert (r.speed_kmh, r.lat) == (2.0, 2.0)
