import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from roadlens.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, app="roadlens-tests")
    yield s
    s.stop()


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)

TEL_SCHEMA = (
    "vehicle_id string, event_time timestamp_ntz, seq long, speed_kmh double, lat double, lon double, "
    "heading_deg double, ignition_on boolean, trip_id string, fuel_pct double, engine_temp_c double"
)


def tel(spark, rows):
    """rows: dicts with at least vehicle_id, t (seconds after T0 or datetime), speed."""
    out = []
    for i, r in enumerate(rows):
        t = r["t"] if isinstance(r["t"], dt.datetime) else T0 + dt.timedelta(seconds=r["t"])
        out.append(
            (
                r.get("v", "veh_0001"),
                t,
                r.get("seq", i),
                float(r.get("speed", 0.0)),
                float(r.get("lat", -6.2)),
                float(r.get("lon", 106.8)),
                float(r.get("heading", 0.0)),
                bool(r.get("ign", True)),
                r.get("trip", "trip-1"),
                float(r.get("fuel", 50.0)),
                float(r.get("temp", 90.0)),
            )
        )
    return spark.createDataFrame(out, TEL_SCHEMA)


EV_SCHEMA = "event_id string, vehicle_id string, trip_id string, event_time timestamp_ntz, event_type string, detail string"


def events(spark, rows):
    out = []
    for i, r in enumerate(rows):
        t = T0 + dt.timedelta(seconds=r["t"])
        out.append((str(i), r.get("v", "veh_0001"), r.get("trip", "trip-1"), t, r["type"], r.get("detail")))
    return spark.createDataFrame(out, EV_SCHEMA)
