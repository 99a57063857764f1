"""Serving queries, road nodes, engine rules and the slot grid."""

import random

from conftest import SF_SMALL, T0, tel
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.operators import enrich as EN
from roadlens.operators import quality as QA
from roadlens.operators import serve as SV
from roadlens.sources import testmap as TM


def test_valid_readings_break_no_rule(spark):
    assert QA.ecu_audit(TM.ecu_feed(spark, SF_SMALL, broken=False), TM.vehicles(spark, SF_SMALL)).count() == 0


def test_broken_readings_are_found(spark):
    feed = TM.ecu_feed(spark, SF_SMALL)
    kinds = TM.read_table(spark, SF_SMALL, "events").select("event_id", "event_type")
    bad = QA.ecu_audit(feed, TM.vehicles(spark, SF_SMALL)).join(feed.select("vehicle_id", "event_time", "seq"), ["vehicle_id", "event_time"])
    rows = bad.join(kinds, bad["seq"] == kinds["event_id"]).collect()
    of = {k: [r for r in rows if r.event_type == k] for k in (TM.BROKEN_GEAR, TM.BROKEN_MAF, TM.BROKEN_INTAKE)}
    assert all(not r.gear_ok for r in of[TM.BROKEN_GEAR]) and len(of[TM.BROKEN_GEAR]) == kinds.where(f"event_type = '{TM.BROKEN_GEAR}'").count()
    assert all(not r.maf_ok for r in of[TM.BROKEN_MAF]) and of[TM.BROKEN_MAF]
    assert all(not r.intake_ok for r in of[TM.BROKEN_INTAKE]) and of[TM.BROKEN_INTAKE]
    # A counter that jumps shows at the jump and on the way back.
    assert sum(r.fuel_ok is False for r in rows) > 0


def test_history_order(spark):
    t = tel(spark, [{"t": x, "v": v} for v in "BA" for x in (5, 1, 3)])
    up = [(r.vehicle_id, (r.event_time - T0).seconds) for r in SV.history(t, ascending=True).collect()]
    assert up == [("A", 1), ("A", 3), ("A", 5), ("B", 1), ("B", 3), ("B", 5)]
    down = [(r.vehicle_id, (r.event_time - T0).seconds) for r in SV.history(t, vehicles=["A"], ascending=False).collect()]
    assert down == [("A", 5), ("A", 3), ("A", 1)]


def test_snapshot_records(spark):
    import json

    t = tel(spark, [{"t": i, "v": f"veh_{i:04d}"} for i in range(9)])
    got = SV.fleet_snapshot(SV.latest_state(t), t.agg(F.max("event_time")).scalar(), shards=3).collect()
    msgs = [json.loads(r.message) for r in got]
    assert {m["type"] for m in msgs} == {"snapshot"} and sum(r.vehicle_count for r in got) == 9
    for m in msgs:
        assert [v["id"] for v in m["vehicles"]] == sorted(v["id"] for v in m["vehicles"])
        for v in m["vehicles"]:
            assert v["id"] == v["vehicle_id"] and set(S.LATEST_FIELDS) <= set(v)


def test_nearest_node_wherever_the_nodes_lie(spark):
    rnd = random.Random(3)
    a, b, c, d = S.CITY_BOXES["Jakarta"]
    for n in (1, 3, 60):  # one far node, empty surroundings, many
        nodes = [(f"r{i % 4}", "Jakarta", i, rnd.uniform(a, b), rnd.uniform(c, d), rnd.choice(list(S.ROAD_CLASS_LIMIT_KMH)), None) for i in range(n)]
        nodes += [("tie", "Jakarta", 900, *nodes[0][3:5], "toll", 77)]
        df = spark.createDataFrame(nodes, "route_id string, city string, seq int, lat double, lon double, road_class string, speed_limit_kmh int")
        points = [(i, rnd.uniform(a, b), rnd.uniform(c, d)) for i in range(150)] + [(150, a, c), (151, b, d), (152, 0.0, 0.0)]
        t = spark.createDataFrame(points, "i int, lat double, lon double")
        k = EN._lon_scale("Jakarta")
        for r in EN.assign_limit_nodes(t, df).collect():
            if r.i == 152:
                assert r.route_id is None and r.speed_limit_kmh is None
                continue
            best = min(nodes, key=lambda x: ((r.lat - x[3]) ** 2 + ((r.lon - x[4]) * k) ** 2, x[0], x[2]))
            assert (r.route_id, r.node_seq) == (best[0], best[2])
            assert r.speed_limit_kmh == (best[6] or S.ROAD_CLASS_LIMIT_KMH[best[5]])


def _to_segment(y, x, s, k):
    """Squared distance by trying the projection and both ends."""
    (ay, ax), (by, bx) = (s[0], s[1] * k), (s[2], s[3] * k)
    x *= k
    size = (by - ay) ** 2 + (bx - ax) ** 2
    ends = [(y - ay) ** 2 + (x - ax) ** 2, (y - by) ** 2 + (x - bx) ** 2]
    f = ((y - ay) * (by - ay) + (x - ax) * (bx - ax)) / size if size else 0.0
    if 0 < f < 1:
        ends.append((y - ay - f * (by - ay)) ** 2 + (x - ax - f * (bx - ax)) ** 2)
    return min(ends)


def test_nearest_segment(spark):
    rnd = random.Random(5)
    a, b, c, d = S.CITY_BOXES["Jakarta"]
    k = EN._lon_scale("Jakarta")
    for n, reach, cell in ((1, 0.0, 0.01), (2, 1.0, 0.01), (40, 0.05, 0.01), (40, 1.0, 0.003), (30, 0.02, 0.2)):
        segments = []
        for i in range(n):
            y, x = rnd.uniform(a, b), rnd.uniform(c, d)
            segments.append((f"r{i}", "Jakarta", i, y, x, y + reach * rnd.uniform(a - b, b - a), x + reach * rnd.uniform(c - d, d - c), "local", 10 + i))
        segments.append(("far", "Jakarta", 99, a - 3.0, c + 2.0, a - 2.0, c + 2.0, "toll", 99))
        df = spark.createDataFrame(segments, "route_id string, city string, seq int, lat0 double, lon0 double, lat1 double, lon1 double, road_class string, speed_limit_kmh int")
        points = [(i, rnd.uniform(a, b), rnd.uniform(c, d)) for i in range(120)] + [(120, a, c), (121, b, d), (122, 0.0, 0.0), (123, None, c)]
        t = spark.createDataFrame(points, "i int, lat double, lon double")
        rows = EN.assign_limit_segments(t, df, cell).collect()
        assert len(rows) == len(points)
        for r in rows:
            if r.i >= 122:
                assert r.route_id is None and r.speed_limit_kmh is None
                continue
            best = min(segments, key=lambda s: _to_segment(r.lat, r.lon, s[3:7], k))
            assert r.route_id == best[0] and r.speed_limit_kmh == best[8]


def test_segments_of_routes(spark):
    rows = [("x", "Jakarta", 3, 0.0, 3.0), ("x", "Jakarta", 1, 0.0, 1.0), ("x", "Bandung", 2, 9.0, 9.0), ("x", "Jakarta", 2, 0.0, 2.0)]
    n = spark.createDataFrame([(*r, "local", None) for r in rows], "route_id string, city string, seq int, lat double, lon double, road_class string, speed_limit_kmh int")
    got = sorted((r.city, r.seq, r.lon0, r.lon1) for r in EN.road_segments(n).collect())
    assert got == [("Bandung", 2, 9.0, 9.0), ("Jakarta", 1, 1.0, 2.0), ("Jakarta", 2, 2.0, 3.0)]


def test_missing_slots(spark):
    w = spark.createDataFrame([(0,), (30,), (120,), (200_010,)], "s long").select(F.timestamp_seconds("s").cast("timestamp_ntz").alias("window_start"))
    got = {r.s for r in SV.missing_slots(w, 30).select(F.unix_seconds(F.col("slot_start").cast("timestamp")).alias("s")).collect()}
    assert got == set(range(0, 200_011, 30)) - {0, 30, 120, 200_010}
    assert SV.missing_slots(w.limit(0), 30).count() == 0


def test_resample_over_a_long_gap(spark):
    t = tel(spark, [{"t": 0, "speed": 0}, {"t": 5000, "speed": 50}])
    got = QA.resample(t, 1, ("speed_kmh",)).orderBy("grid_time").collect()
    assert len(got) == 5000 and got[0].speed_kmh == 0.01 and got[-1].speed_kmh == 50.0


def test_reading_of_an_unknown_vehicle_is_outside(spark):
    t = tel(spark, [{"t": 0, "v": "nobody"}])
    v = spark.createDataFrame([("veh_0001", "Jakarta")], "vehicle_id string, home_city string")
    assert EN.geofence_violations(t, v, EN.city_boxes(spark)).count() == 1


def test_nearest_segments_need_few_distances(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    lat, lon = rng.random(3000), rng.random(3000)
    lat[100:200], lon[100:200] = lat[0], lon[0]  # one place many times
    ends = rng.random((4, 2000))
    ends[2:, ::2] = ends[:2, ::2]  # every other one is a point
    ends[:, 1000:1010] = ends[:, :10]  # equally near: the first wins
    plain, count = EN._distances2, []

    def counted(y, x, s, k):
        count.append(len(y) * s.shape[1])
        return plain(y, x, s, k)

    monkeypatch.setattr(EN, "_distances2", counted)
    monkeypatch.setattr(EN, "_PAIRS", 1 << 10)
    assert (EN._nearest(lat, lon, ends, 0.9) == np.argmin(plain(lat, lon, ends, 0.9), axis=1)).all()
    assert sum(count) < lat.size * 2000 / 4
