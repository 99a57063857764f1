"""Custom stateful stream operators (T10, T4 with the ignition rule, live T12
and T13).

Spark has no streaming ``lag``, no session window that closes on a column
value and no operator that tells of what did not come, so these run as
``transformWithStateInPandas`` processors. Everything else in the library is
built-in Spark.

A state call costs far more than the arithmetic on a vehicle's few readings of
a micro-batch, so vehicles are dealt by hash to a fixed number of buckets, and
a bucket, not a vehicle, is what Spark keeps state and timers for.

Readings may arrive in any order within the hold. What a micro-batch brings of
a bucket is appended to its state as one sorted run (a list state, nothing
read or rewritten); an event-time timer then merges the runs once and hands on
all readings that the watermark has passed, in one call and in order, and the
rest goes back as one run. So no reading inside the hold is skipped, a bucket
costs a fixed number of state calls a batch, however many vehicles and readings
it has, and state holds no more than the hold's readings plus one record per
vehicle. Where the runs of one bucket are longer than fits a worker, they are
merged one stretch of time after the other. Readings behind the watermark are dropped by
Spark, which counts them (``numRowsDroppedByWatermark``); ``late_records``
reports them.

The arithmetic mirrors the batch operators exactly, so a stream and the
batch table give the same events.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from roadlens import schemas as S
from roadlens.operators.detect import RULES

DETECT_OUT = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("t_us", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)

DETECT_STATE = T.StructType(
    [
        T.StructField("last_us", T.LongType()),
        T.StructField("last_seq", T.LongType()),
        T.StructField("last_speed", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("first_us", T.LongType()),
        T.StructField("over_false_us", T.LongType()),
        T.StructField("idle_false_us", T.LongType()),
        T.StructField("conds", T.StringType()),
        T.StructField("fuel_trip", T.StringType()),
    ]
)


def _pmod_arr(x: np.ndarray, n: float) -> np.ndarray:
    """Positive remainder, as Spark's ``pmod`` on doubles."""
    r = np.fmod(x, n)
    return np.where(r < 0, np.fmod(r + n, n), r)


def _ffill_seeded(values: np.ndarray, seed) -> np.ndarray:
    """Last non-NaN value up to each position, starting from ``seed``
    (position 0 of the result is the seed, position i+1 covers values[i])."""
    arr = np.concatenate([[np.nan if seed is None else float(seed)], values])
    return pd.Series(arr).ffill().to_numpy(np.float64)


_RUN = T.StructType(
    [
        T.StructField("low_us", T.LongType()),
        T.StructField("high_us", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("rows", T.BinaryType()),
    ]
)
_TIMER = T.StructType([T.StructField("at_ms", T.LongType())])
RUN_ROWS = 65_536  # rows of one element of a run
MERGE_ROWS = 1 << 20  # rows of one bucket that are merged at once
BUCKETS = 256  # of vehicles; part of a query's checkpoint, more of them for a larger fleet
_BLOB = T.StructType([T.StructField("rows", T.BinaryType())])


def _pack(pdf: pd.DataFrame) -> bytes:
    sink = io.BytesIO()
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue()


def _unpack(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(blob)).read_pandas()


def _ordered(parts: list[pd.DataFrame]) -> pd.DataFrame:
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return pdf.sort_values(["t_us", "seq"], kind="stable")


def _run_of(pdf: pd.DataFrame) -> list[tuple]:
    """The elements of one run of readings, in order of time."""
    pdf = _ordered([pdf])
    t = pdf["t_us"].to_numpy(np.int64)
    return [
        (int(t[at]), int(t[at : at + RUN_ROWS].max()), min(RUN_ROWS, len(t) - at), _pack(pdf.iloc[at : at + RUN_ROWS]))
        for at in range(0, len(t), RUN_ROWS)
    ]


class OrderedProcessor(StatefulProcessor):
    """Hands a key's readings to :meth:`process` in (time, seq) order, each
    once the watermark has passed it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getListState("runs", _RUN)
        self.timer = handle.getValueState("timer", _TIMER)

    # To be given by the operator -----------------------------------------

    columns: list[str] = []

    def process(self, key, pdf: pd.DataFrame) -> list[tuple]:
        """Output rows for the next readings of the key, in order."""
        raise NotImplementedError

    def passed(self, key, watermark_ms: int) -> list[tuple]:
        """Output rows that are due since no reading before the watermark is
        to come."""
        return []

    def due_ms(self) -> int | None:
        """When :meth:`passed` has something to say, if nothing arrives."""
        return None

    def settle(self) -> None:
        """Called at the end of a timer, to store what the operator keeps."""

    # ----------------------------------------------------------------------

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        low = None
        for pdf in rows:  # one Arrow batch at a time
            if pdf.empty:
                continue
            run = _run_of(pdf.drop(columns=["bucket", "event_time"], errors="ignore"))
            if len(run) == 1:
                self.runs.appendValue(run[0])
            else:
                self.runs.appendList(run)
            low = run[0][0] if low is None else min(low, run[0][0])
        if low is not None:
            self._wake(low // 1000 + 1)
        yield pd.DataFrame([], columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        rest: list[tuple] = []
        due = False
        for ready, rest in self._merged(mark * 1000):
            due = True
            yield pd.DataFrame(self.process(key, ready), columns=self.columns)
        if due:
            if rest:
                self.runs.put(rest)
            else:
                self.runs.clear()
        late = self.passed(key, mark)
        if late:
            yield pd.DataFrame(late, columns=self.columns)
        self.settle()
        wake = [x for x in (rest[0][0] // 1000 + 1 if rest else None, self.due_ms()) if x is not None]
        if wake:
            at = max(min(wake), mark + 1)
            self.timer.update((at,))
            self.handle.registerTimer(at)
        else:
            self.timer.clear()

    def _merged(self, end_us: int) -> Iterator[tuple[pd.DataFrame, list[tuple]]]:
        """The readings before ``end_us`` in order, each time with what is
        left of the runs behind that (complete with the last part)."""
        held: list[tuple] | None = []
        times, n = [], 0
        for e in self.runs.get():
            n += e[2]
            if n > MERGE_ROWS:
                held = None
            if held is not None:
                held.append(tuple(e))
            times.append(e[:3])
        if held is not None:
            if not held:
                return
            pdf = _ordered([_unpack(e[3]) for e in held])
            t = pdf["t_us"].to_numpy(np.int64)
            passed = t < end_us
            if pdf["t_us"].hasnans:  # readings without a time come after a vehicle's others
                vehicle = pd.factorize(pdf["vehicle_id"].to_numpy(object), use_na_sentinel=False)[0]
                by = np.argsort(vehicle, kind="stable")
                for own in np.split(by, np.cumsum(np.bincount(vehicle))[:-1]):
                    passed[own] = np.arange(len(own)) < (np.searchsorted(t[own], end_us) if t[own[0]] < end_us else 0)
            ready, rest = pdf[passed], [] if passed.all() else _run_of(pdf[~passed])
            if len(ready):
                yield ready, rest
            return
        # Too much at once: stretches of time, each read from the runs anew.
        all_t = np.sort(np.concatenate([_unpack(e[3])["t_us"].to_numpy(np.int64) for e in self.runs.get() if e[0] < end_us]))
        bounds = [*np.unique(all_t[all_t < end_us][MERGE_ROWS::MERGE_ROWS]).tolist(), end_us]
        rest = []
        for e in self.runs.get():
            if e[1] >= end_us:
                tail = _unpack(e[3])
                rest += _run_of(tail[tail["t_us"] >= end_us])
        rest.sort(key=lambda e: e[0])
        low = None
        for high in bounds:
            parts = [_unpack(e[3]) for e in self.runs.get() if e[0] < high and (low is None or e[1] >= low)]
            parts = [p[(p["t_us"] < high) & (True if low is None else p["t_us"] >= low)] for p in parts]
            yield _ordered(parts), rest
            low = high

    def _wake(self, at_ms: int) -> None:
        """One timer per key, at the earliest time asked for."""
        if self.timer.exists():
            (old,) = self.timer.get()
            if old <= at_ms:
                return
            self.handle.deleteTimer(old)
        self.timer.update((at_ms,))
        self.handle.registerTimer(at_ms)

    def close(self) -> None:
        pass


class VehiclesProcessor(OrderedProcessor):
    """An ordered processor of a bucket of vehicles: :meth:`step` takes one
    vehicle's next readings. The records of the bucket's vehicles are one
    value, read and written once a timer."""

    record: T.StructType  # what is kept of a vehicle

    def step(self, vehicle: str | None, rows: dict[str, np.ndarray], s: tuple | None) -> tuple[list[tuple], tuple | None]:
        """Output rows for the next readings of a vehicle, in order, and what
        is kept of it, given what was."""
        raise NotImplementedError

    def due_us(self, s: tuple) -> int | None:
        """Time behind which :meth:`lapsed` takes over, if nothing arrives."""
        return None

    def lapsed(self, vehicle: str | None, s: tuple) -> list[tuple]:
        """Output rows of a vehicle that is forgotten, as its time has passed."""
        return []

    def arrays(self, pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        """The columns that :meth:`step` takes."""
        return {"t_us": pdf["t_us"].to_numpy(np.int64)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.blob = handle.getValueState("vehicles", _BLOB)
        self.kept: dict | None = None

    def _records(self) -> dict:
        if self.kept is None:
            self.kept = {}
            if self.blob.exists():
                (blob,) = self.blob.get()
                cols = pa.ipc.open_stream(bytes(blob)).read_all().to_pydict()
                self.kept = dict(zip(cols["vehicle_id"], zip(*(cols[f.name] for f in self.record.fields), strict=True), strict=True))
        return self.kept

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.kept = None  # another bucket's
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)

    def process(self, key, pdf: pd.DataFrame) -> list[tuple]:
        kept = self._records()
        code, names = pd.factorize(pdf["vehicle_id"].to_numpy(object), use_na_sentinel=False)
        by = np.argsort(code, kind="stable")
        cols = {c: x[by] for c, x in self.arrays(pdf).items()}
        ends = np.cumsum(np.bincount(code, minlength=len(names))).tolist()
        out: list[tuple] = []
        lo = 0
        for name, hi in zip(names.tolist(), ends, strict=True):
            vehicle = name if isinstance(name, str) else None
            rows, s = self.step(vehicle, {c: x[lo:hi] for c, x in cols.items()}, kept.get(vehicle))
            out += rows
            if s is None:
                kept.pop(vehicle, None)
            else:
                kept[vehicle] = s
            lo = hi
        return out

    def passed(self, key, watermark_ms: int) -> list[tuple]:
        out: list[tuple] = []
        kept = self._records()
        for vehicle, s in list(kept.items()):
            due = self.due_us(s)
            if due is not None and watermark_ms * 1000 >= due:
                out += self.lapsed(vehicle, s)
                del kept[vehicle]
        return out

    def due_ms(self) -> int | None:
        due = [x for x in map(self.due_us, self._records().values()) if x is not None]
        return -(-min(due) // 1000) if due else None  # the first millisecond not before it

    def settle(self) -> None:
        kept = self._records()
        if not kept:
            self.blob.clear()
            return
        cols = {"vehicle_id": pa.array(kept, pa.string())}
        for f, values in zip(self.record.fields, zip(*kept.values(), strict=True), strict=True):
            cols[f.name] = pa.array(values, to_arrow_type(f.dataType))
        table = pa.table(cols)
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        self.blob.update((sink.getvalue(),))


class DetectProcessor(VehiclesProcessor):
    """T10 on a stream: the six telemetry rules, edge-triggered, per vehicle."""

    columns = ["vehicle_id", "trip_id", "t_us", "event_type"]
    record = DETECT_STATE

    def __init__(self, limit_kmh: float):
        self.limit = float(limit_kmh)

    def arrays(self, pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        cols = {c: pdf[c].to_numpy(np.float64) for c in ("speed_kmh", "heading_deg", "fuel_pct")}
        trip = pdf["trip_id"].astype(object).where(pdf["trip_id"].notna(), None).to_numpy(object)
        return {**super().arrays(pdf), **cols, "seq": pdf["seq"].to_numpy(), "ignition_on": pdf["ignition_on"].to_numpy(bool), "trip_id": trip}

    def step(self, vehicle: str | None, rows: dict[str, np.ndarray], s: tuple | None) -> tuple[list[tuple], tuple | None]:
        if s is not None:
            (last_us, _last_seq, last_speed, heading, first_us, over_f, idle_f, conds, fuel_trip) = s
            prev = set(conds.split(",")) if conds else set()
        else:
            last_us = last_speed = heading = first_us = over_f = idle_f = None
            prev, fuel_trip = set(), None
        # Vectorised over the readings; the state seeds the first row (previous reading, carried heading, clocks).
        t, speed, head, ign, trip = (rows[c] for c in ("t_us", "speed_kmh", "heading_deg", "ignition_on", "trip_id"))
        n = len(t)
        first_us = int(t[0]) if first_us is None else first_us
        prev_t, prev_speed = np.empty(n, np.int64), np.empty(n, np.float64)
        prev_t[1:], prev_speed[1:] = t[:-1], speed[:-1]
        has_prev = np.ones(n, bool)
        if last_us is None:
            has_prev[0], prev_t[0], prev_speed[0] = False, t[0], np.nan
        else:
            prev_t[0], prev_speed[0] = last_us, last_speed
        dt = (t - prev_t).astype(np.float64) / 1e6
        with np.errstate(divide="ignore", invalid="ignore"):
            accel = np.where(has_prev & (dt > 0), (speed - prev_speed) / 3.6 / dt, np.nan)
        moving = speed / 3.6 > S.HEADING_MIN_SPEED_MPS
        carried = _ffill_seeded(np.where(moving, head, np.nan), heading)
        h_before = carried[:-1]
        delta = np.where(moving & ~np.isnan(h_before), _pmod_arr(head - h_before + 180.0, 360.0) - 180.0, np.nan)
        over_lim = self.limit + S.OVER_SPEED_MARGIN_KMH
        over_c = speed > over_lim
        idle_c = ign & (speed / 3.6 < S.IDLE_SPEED_MPS)
        tf = t.astype(np.float64)
        over_false = _ffill_seeded(np.where(~over_c, tf, np.nan), over_f)
        idle_false = _ffill_seeded(np.where(~idle_c, tf, np.nan), idle_f)
        over_s = np.where(over_c, (tf - np.where(np.isnan(over_false[1:]), first_us, over_false[1:])) / 1e6, 0.0)
        idle_s = np.where(idle_c, (tf - np.where(np.isnan(idle_false[1:]), first_us, idle_false[1:])) / 1e6, 0.0)
        with np.errstate(invalid="ignore"):
            cur = {
                "harsh_accel": accel > S.HARSH_ACCEL_MPS2,
                "harsh_braking": accel < S.HARSH_BRAKE_MPS2,
                "harsh_cornering": ~np.isnan(delta) & (speed > S.HARSH_CORNER_SPEED_KMH) & (np.abs(delta) > S.HARSH_CORNER_HEADING_DEG),
                "over_speed": (speed >= over_lim) & (over_s >= S.OVER_SPEED_SUSTAINED_S),
                "idling": idle_s >= S.IDLING_THRESHOLD_S,
            }
        out = []
        for name in RULES:
            c = cur[name]
            before = np.empty(n, bool)
            before[0], before[1:] = name in prev, c[:-1]
            for i in np.nonzero(c & ~before)[0]:
                out.append((vehicle, trip[i], int(t[i]), name))
        # Fuel low: the first low reading of each trip (a low reading sets the
        # reported trip, so it fires when its trip differs from the previous low one).
        fuel = rows["fuel_pct"]
        low = np.nonzero(np.array([x is not None for x in trip]) & (fuel < S.FUEL_LOW_PCT))[0]
        for i in low:
            if trip[i] != fuel_trip:
                out.append((vehicle, trip[i], int(t[i]), "fuel_low"))
                fuel_trip = trip[i]
        last_heading = carried[-1]
        state = (
            int(t[-1]),
            int(rows["seq"][-1]),
            float(speed[-1]),
            None if np.isnan(last_heading) else float(last_heading),
            first_us,
            None if np.isnan(over_false[-1]) else int(over_false[-1]),
            None if np.isnan(idle_false[-1]) else int(idle_false[-1]),
            ",".join(sorted(r for r in RULES if cur[r][-1])),
            fuel_trip,
        )
        return out, state


SESSION_OUT = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("start_us", T.LongType()),
        T.StructField("end_us", T.LongType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("max_speed_kmh", T.DoubleType()),
        T.StructField("samples", T.LongType()),
    ]
)

SESSION_STATE = T.StructType(
    [
        T.StructField("start_us", T.LongType()),
        T.StructField("last_us", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("micro_km", T.LongType()),
        T.StructField("max_speed", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("first_ign", T.BooleanType()),
    ]
)


def _micro_km(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle steps in whole micro-kilometres (six decimals, halves up),
    so that their sum is exact, as the batch operator's decimals are."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin(np.radians(lat2 - lat1) / 2.0) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2.0) ** 2
    return np.floor(2.0 * S.EARTH_RADIUS_KM * np.arcsin(np.sqrt(a)) * 1e6 + 0.5).astype(np.int64)


class TripSessionProcessor(VehiclesProcessor):
    """T4 on a stream: trip sessions that close on a gap longer than
    ``gap_s`` or after an ignition-off reading. A session is emitted when it
    closes: on the next reading, right after an ignition-off reading, or when
    the watermark passes ``last + gap`` with no reading in between."""

    columns = [f.name for f in SESSION_OUT.fields]
    record = SESSION_STATE  # of an open trip: its last reading had the ignition on

    def __init__(self, gap_s: float, keep_idle: bool):
        self.gap_us = int(gap_s * 1_000_000)
        self.keep_idle = keep_idle

    def arrays(self, pdf: pd.DataFrame) -> dict[str, np.ndarray]:
        cols = {c: pdf[c].to_numpy(np.float64) for c in ("lat", "lon", "speed_kmh")}
        return {**super().arrays(pdf), **cols, "ignition_on": pdf["ignition_on"].to_numpy(bool)}

    def _row(self, vehicle: str | None, s: tuple) -> list[tuple]:
        start_us, last_us, _lat, _lon, micro, mx, n, first_ign = s
        return [(vehicle, start_us, last_us, micro / 1e6, mx, n)] if first_ign or self.keep_idle else []

    def step(self, vehicle: str | None, rows: dict[str, np.ndarray], s: tuple | None) -> tuple[list[tuple], tuple | None]:
        t, lat, lon, speed, ign = (rows[c] for c in ("t_us", "lat", "lon", "speed_kmh", "ignition_on"))
        before = (t[0], lat[0], lon[0]) if s is None else s[1:4]
        prev_t, prev_lat, prev_lon = (np.concatenate(([b], x[:-1])) for b, x in zip(before, (t, lat, lon), strict=True))
        start = (t - prev_t > self.gap_us) | np.concatenate(([s is None], ~ign[:-1]))
        micro = np.where(start, 0, _micro_km(prev_lat, prev_lon, lat, lon))
        cuts = np.flatnonzero(np.concatenate(([True], start[1:])))  # first reading of each run
        ends = np.append(cuts[1:], len(t))
        km, mx = np.add.reduceat(micro, cuts), np.maximum.reduceat(speed, cuts)
        out: list[tuple] = []
        if s is not None and start[0]:
            out += self._row(vehicle, s)
            s = None
        for i, (a, b) in enumerate(zip(cuts.tolist(), ends.tolist(), strict=True)):
            goes_on = s is not None and i == 0
            trip = (
                s[0] if goes_on else int(t[a]),
                int(t[b - 1]),
                float(lat[b - 1]),
                float(lon[b - 1]),
                int(km[i]) + (s[4] if goes_on else 0),
                max(float(mx[i]), s[5]) if goes_on else float(mx[i]),
                b - a + (s[6] if goes_on else 0),
                s[7] if goes_on else bool(ign[a]),
            )
            if b < len(t) or not ign[b - 1]:
                out += self._row(vehicle, trip)
            else:
                return out, trip
        return out, None

    def due_us(self, s: tuple) -> int:
        return s[1] + self.gap_us

    def lapsed(self, vehicle: str | None, s: tuple) -> list[tuple]:
        return self._row(vehicle, s)


SILENT_OUT = T.StructType([T.StructField("vehicle_id", T.StringType()), T.StructField("last_us", T.LongType())])
_LAST = T.StructType([T.StructField("last_us", T.LongType())])


class SilentProcessor(VehiclesProcessor):
    """T12 on a stream: tells of a vehicle once the watermark has passed its
    last reading by ``silence_s``, whether or not another one ever comes."""

    columns = [f.name for f in SILENT_OUT.fields]
    record = _LAST  # of a vehicle not yet reported

    def __init__(self, silence_s: float):
        self.silence_us = int(silence_s * 1_000_000)

    def step(self, vehicle: str | None, rows: dict[str, np.ndarray], s: tuple | None) -> tuple[list[tuple], tuple | None]:
        t = rows["t_us"]
        if s is not None:
            t = np.concatenate((s, t))
        return [(vehicle, int(x)) for x in t[:-1][np.diff(t) > self.silence_us]], (int(t[-1]),)

    def due_us(self, s: tuple) -> int:
        return s[0] + self.silence_us + 1  # more than the silence

    def lapsed(self, vehicle: str | None, s: tuple) -> list[tuple]:
        return [(vehicle, s[0])]


GAP_OUT = T.StructType([T.StructField("first_us", T.LongType()), T.StructField("last_us", T.LongType())])
_SLOT = T.StructType([T.StructField("next_us", T.LongType())])


class SlotProcessor(StatefulProcessor):
    """T13 on a stream: ranges of slots that the watermark has closed and that
    no row came for. Its input is one row per slot, not per reading; its state
    is the first slot that isn't settled yet."""

    def __init__(self, slide_s: int):
        self.slide_us = int(slide_s) * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", _SLOT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slots = np.unique(np.concatenate([pdf["slot_us"].to_numpy(np.int64) for pdf in rows]))
        known = self.next.exists()
        due = self.next.get()[0] if known else int(slots[0])
        slots = slots[slots >= due]
        out = []
        for slot in slots.tolist():
            if slot > due:
                out.append((due, slot - self.slide_us))
            due = slot + self.slide_us
        self._expect(due, timerValues.getCurrentWatermarkInMs(), None if not known else self.next.get()[0])
        yield pd.DataFrame(out, columns=[f.name for f in GAP_OUT.fields])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (due,) = self.next.get()
        mark = timerValues.getCurrentWatermarkInMs()
        closed = mark * 1000 // self.slide_us * self.slide_us  # slots before this one are over
        if closed <= due:
            return
        self._expect(closed, mark, None)
        yield pd.DataFrame([(due, closed - self.slide_us)], columns=[f.name for f in GAP_OUT.fields])

    def _expect(self, due: int, mark: int, before: int | None) -> None:
        if before is not None and before != due:
            self.handle.deleteTimer(self._alarm(before))
        self.next.update((due,))
        self.handle.registerTimer(max(self._alarm(due), mark + 1))

    def _alarm(self, due: int) -> int:
        """When the slot ``due`` is over."""
        return (due + self.slide_us) // 1000 + 1

    def close(self) -> None:
        pass


def _need_rocksdb(t: DataFrame) -> None:
    provider = t.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    if not provider.endswith("RocksDBStateStoreProvider"):
        raise ValueError(
            "processors need the RocksDB state store: set spark.sql.streaming.stateStore.providerClass "
            "(build_session and apply_cluster_defaults do)"
        )


def _by_bucket(t: DataFrame, hold: str, cols: list[str], buckets: int) -> GroupedData:
    _need_rocksdb(t)
    marked = t.withWatermark("event_time", hold)
    bucket = F.pmod(F.xxhash64("vehicle_id"), F.lit(buckets)).cast("int").alias("bucket")
    t_us = F.unix_micros(F.col("event_time").cast("timestamp")).alias("t_us")
    return marked.select(bucket, "vehicle_id", "event_time", t_us, "seq", *cols).groupBy("bucket")


def detect_events_stream(t: DataFrame, limit_kmh: float, hold: str = S.LATE_HOLD, buckets: int = BUCKETS) -> DataFrame:
    """T10 (stream): driving events from a telemetry stream, in event-time
    order whatever the order of arrival within ``hold``."""
    d = _by_bucket(t, hold, ["trip_id", "speed_kmh", "heading_deg", "ignition_on", "fuel_pct"], buckets)
    out = d.transformWithStateInPandas(
        statefulProcessor=DetectProcessor(limit_kmh), outputStructType=DETECT_OUT, outputMode="Append", timeMode="EventTime"
    )
    return out.select("vehicle_id", "trip_id", F.timestamp_micros("t_us").alias("event_time"), "event_type")


def trip_sessions_stream(t: DataFrame, gap_s: float = S.SESSION_GAP_S, hold: str = S.LATE_HOLD, keep_idle: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """T4 (stream): gap + ignition sessions, in event-time order whatever the
    order of arrival within ``hold``."""
    d = _by_bucket(t, hold, ["lat", "lon", "speed_kmh", "ignition_on"], buckets)
    out = d.transformWithStateInPandas(
        statefulProcessor=TripSessionProcessor(gap_s, keep_idle), outputStructType=SESSION_OUT, outputMode="Append", timeMode="EventTime"
    )
    return out.select(
        "vehicle_id",
        F.timestamp_micros("start_us").alias("start_time"),
        F.timestamp_micros("end_us").alias("end_time"),
        "distance_km",
        "max_speed_kmh",
        "samples",
    )


def stale_vehicles_stream(t: DataFrame, silence_s: float = S.FRESHNESS_MAX_AGE_S, hold: str = S.LATE_HOLD, buckets: int = BUCKETS) -> DataFrame:
    """T12 (stream): one row ``vehicle_id, last_seen, silent_since`` each time a
    vehicle has sent nothing for more than ``silence_s`` of event time, as soon
    as the watermark shows it."""
    d = _by_bucket(t, hold, [], buckets)
    out = d.transformWithStateInPandas(
        statefulProcessor=SilentProcessor(silence_s), outputStructType=SILENT_OUT, outputMode="Append", timeMode="EventTime"
    )
    since = F.timestamp_micros(F.col("last_us") + F.lit(int(silence_s * 1_000_000)))
    return out.select("vehicle_id", F.timestamp_micros("last_us").alias("last_seen"), since.alias("silent_since"))


def missing_slots_stream(u: DataFrame, slide_s: int = 30, hold: str = S.LATE_HOLD) -> DataFrame:
    """T13 (stream): starts of the slots of ``slide_s`` that the watermark has
    closed and no row of the whole fleet lies in, from the first slot seen on.
    Readings become one row per slot first, so the one group of the second
    step grows with time, not with the fleet."""
    _need_rocksdb(u)
    slots = u.withWatermark("event_time", hold).groupBy(F.window("event_time", f"{slide_s} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    slots = slots.select(F.lit("fleet").alias("fleet"), F.unix_micros("w.start").alias("slot_us"), F.window_time("w").alias("event_time"))
    out = slots.groupBy("fleet").transformWithStateInPandas(
        statefulProcessor=SlotProcessor(slide_s), outputStructType=GAP_OUT, outputMode="Append", timeMode="EventTime"
    )
    starts = F.sequence("first_us", "last_us", F.lit(slide_s * 1_000_000).cast("long"))
    return out.select(F.explode(starts).alias("us")).select(F.timestamp_micros("us").alias("slot_start"))
