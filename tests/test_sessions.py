import pandas as pd
import pytest

from conftest import tel
from roadlens.operators import sessions as SS


def test_gap_tie_is_strict(spark):
    one = tel(spark, [{"t": 0, "speed": 10}, {"t": 300, "speed": 10}])
    two = tel(spark, [{"t": 0, "speed": 10}, {"t": 300.001, "speed": 10}])
    assert SS.trip_sessions(one, gap_s=300).count() == 1
    assert SS.trip_sessions(two, gap_s=300).count() == 2


def test_ignition_off_closes_trip(spark):
    t = tel(spark, [{"t": 0, "ign": True}, {"t": 1, "ign": True}, {"t": 2, "ign": False}, {"t": 3, "ign": True}])
    rows = SS.trip_sessions(t).orderBy("start_time").collect()
    assert len(rows) == 2 and rows[0].samples == 3 and not rows[0].is_open and rows[1].is_open


def test_parked_rows_make_no_trips(spark):
    t = tel(spark, [{"t": 0, "ign": False}, {"t": 1, "ign": False}, {"t": 2, "ign": False}])
    assert SS.trip_sessions(t).count() == 0
    assert SS.trip_sessions(t, keep_idle=True).count() == 3


def test_sessions_partition_rows_and_distance_nonnegative(spark):
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    from roadlens.sources import testmap as TM

    t = TM.telemetry_light(spark, SF_SMALL)
    s = SS.trip_sessions(t, gap_s=6 * 3600, on_ignition=False, keep_idle=True)
    agg = s.agg(F.sum("samples").alias("n"), F.min("distance_km").alias("d")).first()
    assert agg.n == t.count() and agg.d >= 0


def test_trip_distance_from_odometer(spark):
    from pyspark.sql import functions as F

    t = tel(spark, [{"t": 0}, {"t": 10}]).withColumn("odometer_km", F.when(F.col("seq") == 0, 100.0).otherwise(100.25))
    r = SS.trips_by_id(t).first()
    assert r.distance_km == 0.25 and r.samples == 2


def _numbered_sessions(rows, gap_s):
    """A reading starts a session if it is its vehicle's first, comes more than
    ``gap_s`` after the one before, or that one had the ignition off. Starts
    are numbered, and each number's readings summed up."""
    df = pd.DataFrame(rows).sort_values(["v", "t"], kind="stable")
    before = df.groupby("v")[["t", "ign"]].shift()
    first = before["t"].isna()
    df["start"] = first | (df["t"] - before["t"] > gap_s) | (before["ign"] == False)  # noqa: E712
    df["no"] = df["start"].cumsum()
    g = df.groupby("no").agg(v=("v", "first"), a=("t", "min"), b=("t", "max"), n=("t", "size"), mx=("speed", "max"))
    return sorted(g.itertuples(index=False, name=None))


@pytest.mark.parametrize("bucket_s", [7, 300, 3600])
def test_sessions_match_row_by_row_rule(spark, bucket_s):
    import random

    from conftest import T0

    rnd = random.Random(7)
    rows, t = [], 0
    for i in range(300):
        t += rnd.choice([1, 2, 5, 100, 400])
        rows.append({"v": rnd.choice("AB"), "t": t, "speed": float(rnd.randint(0, 100)), "ign": rnd.random() > 0.15, "seq": i})
    df = tel(spark, rows)
    got = sorted(
        (r.vehicle_id, int((r.start_time - T0).total_seconds()), int((r.end_time - T0).total_seconds()), r.samples, r.max_speed_kmh)
        for r in SS.trip_sessions(df, gap_s=300, keep_idle=True, bucket_s=bucket_s).collect()
    )
    assert got == _numbered_sessions(rows, 300)


def test_sessions_with_lineage_cut_are_equal(spark):
    from conftest import SF_SMALL
    from roadlens.sources import testmap as TM

    t = TM.telemetry_light(spark, SF_SMALL)
    a = SS.trip_sessions(t, gap_s=6 * 3600, checkpoint=False)
    b = SS.trip_sessions(t, gap_s=6 * 3600, checkpoint=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("on_ignition", [True, False])
def test_bucket_width_does_not_change_sessions(spark, on_ignition):
    """Every column (boundary step distances, is_open included) is the same
    with tiny buckets as with a single bucket per vehicle."""
    import random

    rnd = random.Random(11)
    rows, t = [], 0.0
    for i in range(400):
        t += rnd.choice([1, 2, 5, 100, 400])
        rows.append(
            {"v": rnd.choice("AB"), "t": t, "speed": float(rnd.randint(0, 100)), "ign": rnd.random() > 0.1, "seq": i,
             "lat": -6.2 + rnd.random() / 50, "lon": 106.8 + rnd.random() / 50}
        )
    df = tel(spark, rows)
    one = SS.trip_sessions(df, gap_s=300, on_ignition=on_ignition, keep_idle=True, bucket_s=10**9)
    for b in (7, 120, 3600):
        many = SS.trip_sessions(df, gap_s=300, on_ignition=on_ignition, keep_idle=True, bucket_s=b)
        assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0, b
    assert one.where("distance_km > 0").count() > 5


def test_quick_rounding_is_that_of_spark(spark):
    import random

    from pyspark.sql import functions as F
    from roadlens.operators.quality import _rounded

    rng = random.Random(9)
    values = [rng.uniform(-200, 200) for _ in range(3000)] + [rng.randrange(-10**9, 10**9) / 2e6 for _ in range(3000)] + [n / 8 + 0.005 for n in range(-400, 400)]
    values += [None, float("nan"), float("inf"), -0.0, -1e-9, 1e-9, 1.005, 2.5e-7, 5e-7, 1e300, -1e15, 2.0**52 + 0.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 6):
        plan = df.select("v", _rounded(F.col("v"), digits).alias("a"), F.round("v", digits).alias("b"))
        assert plan.where("NOT (hex(cast(a AS string)) <=> hex(cast(b AS string)))").collect() == []
