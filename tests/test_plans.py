"""Plan-shape guards: no cross joins, top-k limited before the shuffle,
range filters pushed to the scan, no row-at-a-time Python in batch queries."""

import pytest

from conftest import SF_SMALL
from roadlens.plans.catalog import load_all

BATCH = [n for n in load_all() if not n.startswith("stream_")]


def _plan(spark, name):
    df = load_all()[name][0](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_or_python_udf(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_top_k_is_limited_before_shuffle(spark):
    p = _plan(spark, "last_points")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_time_range_reaches_scan(spark):
    p = _plan(spark, "history_range")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in scan


def test_fleet_windows_aggregate_partially(spark):
    p = _plan(spark, "fleet_windows")
    assert p.count("partial_sum") >= 3


def test_ordered_scan_partitions_by_time_bucket(spark):
    p = _plan(spark, "step_distance")
    windows = [line for line in p.splitlines() if "Window [" in line]
    assert any("_scan_bucket" in line.split("windowspecdefinition(")[1] for line in windows if "windowspecdefinition(" in line)


def test_detect_events_with_lineage_cut(spark):
    from conftest import tel
    from roadlens.operators import detect as DT

    t = tel(spark, [{"t": i, "speed": s} for i, s in enumerate([60.0, 49.2, 38.4, 38.4, 27.6])])
    a = sorted(tuple(r) for r in DT.detect_events(t, limit_kmh=200.0, checkpoint=False).collect())
    b = sorted(tuple(r) for r in DT.detect_events(t, limit_kmh=200.0, checkpoint=True).collect())
    assert a == b and len(a) == 2


def test_trip_sessions_shuffle_rows_once(spark):
    """The row stage has one exchange (rows by vehicle and bucket); after
    the fragment checkpoint no plan node reads the source table again."""
    from roadlens.operators import sessions as SS
    from roadlens.sources import testmap as TM

    t = TM.telemetry_light(spark, SF_SMALL)
    rows = SS.session_fragments(t)._jdf.queryExecution().executedPlan().toString()
    assert rows.count("Exchange hashpartitioning") == 1
    after = SS.trip_sessions(t)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in after and "ExistingRDD" in after


def test_detect_events_shuffle_rows_once(spark):
    """After the changed-row checkpoint, the edge step does not shuffle rows
    by (vehicle, bucket) again; only the fuel-low aggregate reads the table."""
    p = _plan(spark, "detect_events")
    assert "Exchange hashpartitioning(vehicle_id, _scan_bucket" not in p
    assert p.count("FileScan") == 1
