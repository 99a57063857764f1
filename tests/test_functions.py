"""Scalar column functions against plain-Python formulas."""

import math

import pytest
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.geo import bearing_deg, haversine_km, haversine_m, kmh_to_mps, mps_to_kmh, wrap_angle
from roadlens.functions.signals import build_key, split_key

POINTS = [(-6.2, 106.8, -6.9, 107.6), (0.0, 0.0, 0.0, 1.0), (10.0, 20.0, 10.0, 20.0), (-6.3, 106.7, -6.1, 106.5)]


def _hav(lat1, lon1, lat2, lon2, r):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * r * math.asin(math.sqrt(a))


def _bearing(lat1, lon1, lat2, lon2):
    p1, p2, dl = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    x = math.sin(dl) * math.cos(p2)
    y = math.cos(p1) * math.sin(p2) - math.sin(p1) * math.cos(p2) * math.cos(dl)
    return math.degrees(math.atan2(x, y)) % 360.0


def test_haversine_and_bearing(spark):
    df = spark.createDataFrame(POINTS, "a double, b double, c double, d double")
    rows = df.select(
        haversine_km("a", "b", "c", "d").alias("km"), haversine_m("a", "b", "c", "d").alias("m"), bearing_deg("a", "b", "c", "d").alias("brg")
    ).collect()
    for (a, b, c, d), r in zip(POINTS, rows):
        assert r.km == pytest.approx(_hav(a, b, c, d, S.EARTH_RADIUS_KM), rel=1e-12, abs=1e-12)
        assert r.m == pytest.approx(_hav(a, b, c, d, S.EARTH_RADIUS_M), rel=1e-12, abs=1e-9)
        assert r.m == pytest.approx(r.km * 1000.0, rel=1e-12, abs=1e-9)
        assert 0.0 <= r.brg < 360.0 and r.brg == pytest.approx(_bearing(a, b, c, d), abs=1e-9)


@pytest.mark.parametrize("delta,exp", [(0.0, 0.0), (190.0, -170.0), (-190.0, 170.0), (180.0, -180.0), (-180.0, -180.0), (359.0, -1.0)])
def test_wrap_angle(spark, delta, exp):
    assert spark.range(1).select(wrap_angle(F.lit(delta)).alias("w")).first().w == pytest.approx(exp)


def test_speed_units_round_trip(spark):
    r = spark.range(1).select(kmh_to_mps(F.lit(36.0)).alias("mps"), mps_to_kmh(kmh_to_mps(F.lit(72.0))).alias("kmh")).first()
    assert r.mps == pytest.approx(10.0) and r.kmh == pytest.approx(72.0)


def test_key_build_and_split(spark):
    df = spark.createDataFrame([("veh_0001",), ("a:b",)], "vehicle_id string")
    rows = df.select(build_key(S.LATEST_KEY_PREFIX).alias("k")).select("k", split_key("k").alias("id")).collect()
    assert rows[0].k == S.LATEST_KEY_PREFIX + "veh_0001" and rows[0].id == "veh_0001"
    assert rows[1].id == "b"  # the id part is what follows the last ':'
