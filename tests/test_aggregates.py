import collections
import datetime as dt

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import T0, tel
from roadlens.operators import aggregates as AG


def distinct():
    """Defined in here, so that it travels to the workers by value."""

    class Distinct(AG.Aggregate):
        """Trips of a window, as a sorted list: a buffer that is no number."""

        inputs = ("trip_id", "vehicle_id")
        buffer = "trips binary"
        result = "trip_list string"

        def new(self, n):
            out = np.empty(n, object)
            out[:] = b""
            return {"trips": out}

        def _add(self, state, found):
            for g, names in found.items():
                state["trips"][g] = b",".join(sorted(names | set(filter(None, state["trips"][g].split(b",")))))

        def accumulate(self, state, rows, group):
            found = collections.defaultdict(set)
            for g, t in zip(group.tolist(), rows.column("trip_id").to_pylist(), strict=True):
                found[g].add((t or "-").encode())
            self._add(state, found)

        def merge(self, state, other, group):
            found = collections.defaultdict(set)
            for g, t in zip(group.tolist(), other["trips"], strict=True):
                found[g] |= set(filter(None, t.split(b",")))
            self._add(state, found)

        def finish(self, state):
            return {"trip_list": pa.array([t.decode() for t in state["trips"]], pa.string())}

    return Distinct()


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    yield
    spark.conf.set(key, before)


def _rows(spark):
    rows = [{"v": "hot" if i % 3 else f"v{i % 5}", "t": i * 7, "speed": (i * 37) % 160 + i % 100 / 100, "trip": f"t{i % 4}"} for i in range(600)]
    return rows, tel(spark, rows).repartition(6)


@pytest.mark.parametrize("held", [4, 1 << 16])
def test_equals_plain_grouping(spark, small_batches, held):
    rows, t = _rows(spark)
    want = collections.defaultdict(list)
    trips = collections.defaultdict(set)
    for r in rows:
        for k in range(3):
            start = T0 + dt.timedelta(seconds=(r["t"] // 60 - k) * 60)
            want[r["v"], start].append(round(r["speed"] * 100))
            trips[r["v"], start].add(r["trip"])
    got = AG.windowed_custom(t, ["vehicle_id"], "180 seconds", AG.SpeedBands(), "60 seconds", held=held).collect()
    assert len(got) == len({(r.vehicle_id, r.window_start) for r in got}) == len(want)
    for r in got:
        c = want[r.vehicle_id, r.window_start]
        assert r.samples == len(c) and r.window_end - r.window_start == dt.timedelta(seconds=180)
        assert abs(r.speed_variance - np.var(np.array(c) / 100)) < 1e-6
        bands = [sum(min(x // 3000, 4) == i for x in c) for i in range(5)]
        assert r.modal_band == bands.index(max(bands))
    lists = AG.windowed_custom(t, ["vehicle_id"], "180 seconds", distinct(), "60 seconds", held=held).collect()
    assert {(r.vehicle_id, r.window_start): r.trip_list for r in lists} == {k: ",".join(sorted(v)) for k, v in trips.items()}


def test_a_hot_key_is_not_one_group(spark):
    """Of 200,000 rows of one vehicle each task sends one buffer a window."""
    t = spark.range(0, 200_000, 1, 8).selectExpr("'hot' AS vehicle_id", "timestamp_ntz'2024-01-01 00:00:00' AS event_time", "cast(id % 150 AS double) AS speed_kmh")
    seen = spark.sparkContext.accumulator(0)

    class Counted(AG.SpeedBands):
        def merge(self, state, other, group):
            if len(group) > len(state["n"]):
                seen.add(len(group))
            AG.SpeedBands.merge(self, state, other, group)

    r = AG.windowed_custom(t, ["vehicle_id"], "60 seconds", Counted()).collect()
    assert len(r) == 1 and r[0].samples == 200_000
    # Eight tasks' own batches (of 10,000 rows) and eight partial buffers.
    assert seen.value <= 8 * 3 + 8


def test_nulls_and_empty(spark):
    t = tel(spark, [{"t": 1, "speed": 10}, {"t": 2, "speed": 20}])
    t = t.withColumn("speed_kmh", F.lit(None).cast("double")).withColumn("vehicle_id", F.lit(None).cast("string"))
    t = t.union(t.withColumn("event_time", F.lit(None).cast("timestamp_ntz")))
    r = AG.windowed_custom(t, ["vehicle_id"], "60 seconds", AG.SpeedBands()).collect()
    assert [tuple(x) for x in r] == [(None, T0, T0 + dt.timedelta(seconds=60), 0, None, None)]
    assert AG.windowed_custom(t.limit(0), ["vehicle_id"], "60 seconds", AG.SpeedBands()).collect() == []
    with pytest.raises(ValueError, match="multiple"):
        AG.windowed_custom(t, ["vehicle_id"], "60 seconds", AG.SpeedBands(), "25 seconds")
    with pytest.raises(ValueError, match="named like"):
        AG.windowed_custom(t.withColumnRenamed("vehicle_id", "samples"), ["samples"], "60 seconds", AG.SpeedBands())
