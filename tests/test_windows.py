import datetime as dt

from conftest import T0, events, tel
from roadlens.operators import windows as W


def test_window_edge_splits(spark):
    t = tel(spark, [{"t": 59.999, "speed": 10}, {"t": 60.0, "speed": 20}])
    rows = W.vehicle_speed_windows(t).orderBy("window_start").collect()
    assert [r.window_start for r in rows] == [T0, T0 + dt.timedelta(minutes=1)]


def test_mean_counts_parked_tick(spark):
    t = tel(spark, [{"t": 1, "speed": 0}, {"t": 2, "speed": 30}, {"t": 3, "speed": 60}])
    r = W.vehicle_speed_windows(t).first()
    assert r.avg_speed_kmh == 30.0 and r.max_speed_kmh == 60.0


def test_combined_row_null_versus_zero(spark):
    t = tel(spark, [{"t": 5, "speed": 40}, {"t": 130, "speed": 50}])
    ev = events(spark, [{"t": 10, "type": "idling"}, {"t": 200, "type": "harsh_braking"}])
    rows = {r.window_start: r for r in W.vehicle_windows(t, ev).collect()}
    w0, w2, w3 = T0, T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=3)
    assert rows[w0].harsh_event_count == 0  # only a non-harsh event
    assert rows[w2].harsh_event_count is None  # telemetry only
    assert rows[w3].avg_speed_kmh is None and rows[w3].max_speed_kmh is None  # events only
    assert rows[w3].harsh_event_count == 1


def test_fleet_mean_is_sample_weighted(spark):
    t = tel(
        spark,
        [{"v": "A", "t": 1, "speed": 10}, {"v": "A", "t": 2, "speed": 10}, {"v": "A", "t": 3, "speed": 10}, {"v": "B", "t": 4, "speed": 50}],
    )
    r = W.fleet_speed_windows(t).where(f"window_start = timestamp_ntz'{T0}'").first()
    assert r.fleet_avg_speed_kmh == 20.0 and r.vehicles_active == 2


def test_one_tick_in_ten_sliding_windows(spark):
    t = tel(spark, [{"t": 1000, "speed": 10}])
    assert W.fleet_speed_windows(t).count() == 10


def test_sum_of_tumbling_counts_equals_rows(spark):
    from conftest import SF_SMALL
    from roadlens.sources import testmap as TM
    from pyspark.sql import functions as F

    t = TM.telemetry_light(spark, SF_SMALL)
    n = t.count()
    g = t.groupBy("vehicle_id", F.window("event_time", "60 seconds")).count().agg(F.sum("count")).first()[0]
    assert g == n
    # every row lies in exactly width/slide sliding windows
    panes = W.fleet_speed_windows(t, "7200 seconds", "1800 seconds")
    assert panes.count() > 0


def test_each_row_in_width_over_slide_windows(spark):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from roadlens.sources import testmap as TM

    t = TM.telemetry_light(spark, SF_SMALL)
    w = W.windowed(t, [], "300 seconds", {"n": F.count(F.lit(1))}, slide="30 seconds")
    assert w.agg(F.sum("n")).first()[0] == 10 * t.count()
