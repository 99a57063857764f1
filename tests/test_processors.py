"""Stateful processors on a state of plain lists, and on small streams."""

import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadlens.streaming import processors as PR
from roadlens.streaming import stream as ST
from test_stream import _feed, _run


class State:
    """List, value and timer states that count the calls made."""

    def __init__(self, calls):
        self.calls, self.value = calls, None

    def _count(self, name):
        self.calls.append(name)

    def exists(self):
        self._count("exists")
        return self.value is not None

    def get(self):
        self._count("get")
        return iter(list(self.value or [])) if isinstance(self.value, list) or self.value is None else self.value

    def update(self, v):
        self._count("update")
        self.value = v

    def clear(self):
        self._count("clear")
        self.value = None

    def appendValue(self, v):
        self._count("append")
        self.value = [*(self.value or []), v]

    def appendList(self, v):
        self._count("append")
        self.value = [*(self.value or []), *v]

    put = update


class Handle:
    def __init__(self):
        self.calls, self.timers = [], set()

    def getListState(self, *_):
        return State(self.calls)

    getValueState = getListState

    def registerTimer(self, at):
        self.calls.append("register")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls.append("delete")
        self.timers.discard(at)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


class Echo(PR.OrderedProcessor):
    columns = ["t", "seq"]

    def process(self, key, pdf):
        return list(zip(pdf["t_us"].tolist(), pdf["seq"].tolist(), strict=True))


def drive(proc, batches, marks):
    """Feeds batches of (t, seq) and fires timers as the watermark goes on."""
    handle = Handle()
    proc.init(handle)
    out, costs = [], []
    for rows, mark in zip(batches, marks, strict=True):
        handle.calls.clear()
        if rows:
            pdf = pd.DataFrame({"t_us": [t for t, _ in rows], "seq": [s for _, s in rows]})
            for part in proc.handleInputRows(("v",), iter([pdf]), Clock(0)):
                assert part.empty
        while handle.timers and min(handle.timers) <= mark:
            handle.timers.remove(min(handle.timers))
            for part in proc.handleExpiredTimer(("v",), Clock(mark), None):
                out += list(part.itertuples(index=False, name=None))
        costs.append(len(handle.calls))
    return out, costs, handle


@pytest.mark.parametrize("run_rows,merge_rows", [(65_536, 1 << 20), (3, 5), (1, 1)])
def test_readings_come_in_order_whatever_the_arrival(monkeypatch, run_rows, merge_rows):
    monkeypatch.setattr(PR, "RUN_ROWS", run_rows)
    monkeypatch.setattr(PR, "MERGE_ROWS", merge_rows)
    rng = random.Random(run_rows)
    rows = [(rng.choice(range(0, 60_000_000, 500)), i) for i in range(200)]
    batches = [sorted(rows[i : i + 40], key=lambda _: rng.random()) for i in range(0, 200, 40)]
    # Nothing is due before the last batch, then a part, then all.
    out, _, handle = drive(Echo(), [*batches, [], []], [0] * 5 + [30_000, 61_000])
    assert out == sorted(rows)
    assert not handle.timers


def test_state_calls_do_not_grow_with_readings():
    def calls(n):
        rows = [(1000 * i, i) for i in range(n)]
        return drive(Echo(), [rows, [], rows[:1], []], [0, n // 2, n // 2, 10 * n])[1]

    assert calls(10) == calls(5000) and max(calls(5000)) <= 12


def test_silent_vehicle_is_told_once(spark):
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    batches = [[(0, 1, True), (5, 1, True)], [(40, 1, True), (12, 1, True)], [(300, 1, True)], [(302, 1, True)], [(900, 1, True)], [(901, 1, True)]]
    es = _feed(spark, base, batches)
    _, out = _run(PR.stale_vehicles_stream(es, 15), base)
    got = sorted(out.select(F.unix_seconds("last_seen") - 1_704_067_200, F.unix_seconds("silent_since") - F.unix_seconds("last_seen")).collect())
    assert [tuple(r) for r in got] == [(12, 15), (40, 15), (302, 15)]


def test_slots_nothing_was_written_for(spark):
    base = tempfile.mkdtemp(prefix="roadlens-test-")
    batches = [[(0, 1, True), (95, 1, True)], [(200, 1, True)], [(800, 1, True)], [(801, 1, True)]]
    es = _feed(spark, base, batches)
    with ST.rocksdb_state(spark):
        _, out = _run(PR.missing_slots_stream(es, 30), base)
    got = sorted(r[0] for r in out.select(F.unix_seconds("slot_start") - 1_704_067_200).collect())
    # Closed up to 801 - 75 = 726 s.
    assert got == [x for x in range(0, 720, 30) if x not in (0, 90, 180)]


def test_state_store_setting_comes_back(spark):
    key, other = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, other)
    try:
        with ST.rocksdb_state(spark):
            assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")
        assert spark.conf.get(key) == other
    finally:
        spark.conf.set(key, before)


def test_state_calls_do_not_grow_with_vehicles():
    def run(vehicles):
        handle, proc = Handle(), PR.SilentProcessor(15)
        proc.init(handle)
        out, calls = [], 0
        for t, mark in ((0, 10_000), (5_000_000, 30_000), (60_000_000, 90_000)):
            pdf = pd.DataFrame([(f"v{v}", t + v, v) for v in range(vehicles)], columns=["vehicle_id", "t_us", "seq"])
            for part in proc.handleInputRows((0,), iter([pdf]), Clock(0)):
                assert part.empty
            while handle.timers and min(handle.timers) <= mark:
                handle.timers.remove(min(handle.timers))
                for part in proc.handleExpiredTimer((0,), Clock(mark), None):
                    out += list(part.itertuples(index=False, name=None))
            calls = max(calls, len(handle.calls))
            handle.calls.clear()
        return calls, sorted(out)

    few, many = run(1), run(300)
    assert few[1] == [("v0", 5_000_000), ("v0", 60_000_000)]
    assert many[1] == sorted((f"v{v}", t + v) for v in range(300) for t in (5_000_000, 60_000_000))
    assert many[0] == few[0] <= 20
