"""User-defined window aggregates with a buffer of their own (§2.10).

An :class:`Aggregate` says how empty buffers look, how rows go into them, how
two buffers become one and what comes out. :func:`windowed_custom` runs it the
way Spark runs its own aggregates: every task folds its rows into partial
buffers, only those are shuffled, and buffers of one group are merged as they
stream past. A hot key sends a few buffers per task and is never one group.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from roadlens.operators.windows import interval_seconds

# Partial buffers that a task holds before it sends those that fill up.
HELD = 1 << 16

Buffers = dict[str, np.ndarray]


class Aggregate(ABC):
    """Works on many groups at a time: a buffer column is an array with one
    entry per group, and ``group`` holds the entry's number for every row."""

    inputs: tuple[str, ...]  # columns of the rows
    buffer: str  # columns of a buffer, as DDL
    result: str  # columns that come out, as DDL

    @abstractmethod
    def new(self, n: int) -> Buffers:
        """``n`` empty buffers."""

    @abstractmethod
    def accumulate(self, state: Buffers, rows: pa.RecordBatch, group: np.ndarray) -> None:
        """Takes rows into the buffers of their groups, in place."""

    @abstractmethod
    def merge(self, state: Buffers, other: Buffers, group: np.ndarray) -> None:
        """Takes other buffers into those of their groups, in place. Order
        must not matter: buffers arrive as tasks end."""

    @abstractmethod
    def finish(self, state: Buffers) -> dict[str, np.ndarray | pa.Array]:
        """Result columns, one entry per group; a masked array or an Arrow
        array may hold nulls."""


def _groups(columns: list[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group, and a row of each group. Null keys are a
    group like any other."""
    codes = np.zeros(n, np.int64)
    for c in columns:
        own = c.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # Kept dense, so that codes of many key columns cannot overflow.
        codes = np.unique(codes * (int(own.max(initial=0)) + 1) + own, return_inverse=True)[1]
    _, first, group = np.unique(codes, return_index=True, return_inverse=True)
    return group, first


def _numpy(batch: pa.RecordBatch, names: list[str]) -> Buffers:
    return {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def _merged(agg: Aggregate, batch: pa.RecordBatch, n_keys: int) -> pa.RecordBatch:
    """One row per group of ``batch`` (keys, then buffer columns)."""
    names = batch.schema.names[n_keys:]
    group, first = _groups(batch.columns[:n_keys], batch.num_rows)
    if len(first) == batch.num_rows:
        return batch
    state = agg.new(len(first))
    agg.merge(state, _numpy(batch, names), group)
    at = pa.array(first)
    return _batch([c.take(at) for c in batch.columns[:n_keys]] + [state[n] for n in names], batch.schema)


def _together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def windowed_custom(df: DataFrame, keys: list[str], width: str, agg: Aggregate, slide: str | None = None, ts: str = "event_time", held: int = HELD) -> DataFrame:
    """``agg`` over windows of ``width`` (every ``slide``) per ``keys``: one row
    per group with a row in it, ``keys, window_start, window_end`` and the
    aggregate's result columns. Batch tables.

    Rows without a time are in no window; null keys are a key; an empty table
    gives none. Rows of sliding windows are taken into panes of one slide, and
    only a pane's buffers go to the windows it lies in, so ``width`` has to be
    a multiple of ``slide``. One shuffle, of buffers: per task at most one per
    group and ``held`` of them in memory."""
    w, s = interval_seconds(width), interval_seconds(slide or width)
    if s <= 0 or w % s:
        raise ValueError(f"{width} is no multiple of {slide}")
    names = ["window_start", "window_end", *StructType.fromDDL(agg.buffer).names, *StructType.fromDDL(agg.result).names]
    if clash := {n.lower() for n in keys} & {n.lower() for n in names}:
        raise ValueError(f"keys named like columns of the aggregate: {sorted(clash)}")
    pane = F.window(ts, f"{s} seconds")
    rows = df.where(F.col(ts).isNotNull()).select(
        F.struct(*keys).alias("k"), pane["start"].alias("p"), F.struct(*agg.inputs).alias("v")
    )
    # Inputs may be keys as well: rows go to the workers as keys, pane, then inputs by place.
    flat = rows.select(
        *[F.col(f"k.`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], F.col("p"), *[F.col(f"v.`{c}`").alias(f"v{i}") for i, c in enumerate(agg.inputs)]
    )
    n_keys = len(keys) + 1
    buffer = StructType.fromDDL(agg.buffer)
    partial = StructType(flat.schema.fields[:n_keys] + buffer.fields)
    buffer_fields = list(to_arrow_schema(buffer))

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            group, first = _groups(b.columns[:n_keys], b.num_rows)
            state = agg.new(len(first))
            agg.accumulate(state, pa.RecordBatch.from_arrays(b.columns[n_keys:], names=list(agg.inputs)), group)
            at = pa.array(first)
            kept.append(_batch([c.take(at) for c in b.columns[:n_keys]] + [state[n] for n in buffer.names], pa.schema(list(b.schema)[:n_keys] + buffer_fields)))
            size += len(first)
            if size >= held:
                one = _merged(agg, _together(kept), n_keys)
                # Groups that come again are worth keeping, others not.
                if one.num_rows > held // 2:
                    yield one
                    kept, size = [], 0
                else:
                    kept, size = [one], one.num_rows
        if kept:
            yield _merged(agg, _together(kept), n_keys)

    buffers = flat.mapInArrow(partials, partial)
    if s < w:
        buffers = buffers.withColumn("p", F.explode(F.array(*[F.col("p") - F.expr(f"INTERVAL {i * s} SECONDS") for i in range(w // s)])))
    result = StructType.fromDDL(agg.result)
    out = StructType(flat.schema.fields[:n_keys] + result.fields)
    result_fields = list(to_arrow_schema(result))

    def finished(b: pa.RecordBatch) -> pa.RecordBatch:
        got = agg.finish(_numpy(b, buffer.names))
        return _batch(b.columns[:n_keys] + [got[n] for n in result.names], pa.schema(list(b.schema)[:n_keys] + result_fields))

    def merges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buffers come sorted by group: all but the last group of a batch
        are complete."""
        last: pa.RecordBatch | None = None
        for b in batches:
            if not b.num_rows:
                continue
            keys_of = [c.slice(b.num_rows - 1, 1) for c in b.columns[:n_keys]]
            b = _merged(agg, _together([last, b]) if last is not None else b, n_keys)
            end = _row_of(b, keys_of, n_keys)
            last = b.slice(end, 1)
            rest = b.take(pa.array(np.delete(np.arange(b.num_rows), end)))
            if rest.num_rows:
                yield finished(rest)
        if last is not None:
            yield finished(last)

    by = flat.columns[:n_keys]
    done = buffers.repartition(*by).sortWithinPartitions(*by).mapInArrow(merges, out)
    return done.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
        F.col("p").alias("window_start"),
        (F.col("p") + F.expr(f"INTERVAL {w} SECONDS")).alias("window_end"),
        *result.names,
    )


def _row_of(b: pa.RecordBatch, keys: list[pa.Array], n_keys: int) -> int:
    """The row of ``b`` with these keys."""
    there = np.ones(b.num_rows, bool)
    for c, k in zip(b.columns[:n_keys], keys, strict=True):
        value = k[0]
        same = c.is_null() if not value.is_valid else pc.equal(c, value).fill_null(False)
        there &= same.to_numpy(zero_copy_only=False)
    return int(np.flatnonzero(there)[0])


class SpeedBands(Aggregate):
    """Readings, variance of speed and the band of speed with most readings
    (ties: the slower). Sums are integers of hundredths, so the order in which
    buffers are merged does not show in the result."""

    inputs = ("speed_kmh",)
    bands = 5  # of 30 km/h each, the last open
    columns = ("n", "s", "ss", "b0", "b1", "b2", "b3", "b4")
    buffer = "n long, s long, ss long, b0 long, b1 long, b2 long, b3 long, b4 long"
    result = "samples long, speed_variance double, modal_band int"

    def new(self, n: int) -> Buffers:
        return {c: np.zeros(n, np.int64) for c in self.columns}

    def accumulate(self, state: Buffers, rows: pa.RecordBatch, group: np.ndarray) -> None:
        speed = rows.column("speed_kmh").to_numpy(zero_copy_only=False).astype(np.float64)
        there = ~np.isnan(speed)
        centi, group = np.rint(speed[there] * 100.0).astype(np.int64), group[there]
        one = self.new(len(state["n"]))
        np.add.at(one["n"], group, 1)
        np.add.at(one["s"], group, centi)
        np.add.at(one["ss"], group, centi * centi)
        band = np.clip(centi // 3000, 0, self.bands - 1)
        for i in range(self.bands):
            np.add.at(one[f"b{i}"], group[band == i], 1)
        self.merge(state, one, np.arange(len(state["n"])))

    def merge(self, state: Buffers, other: Buffers, group: np.ndarray) -> None:
        for c, x in other.items():
            np.add.at(state[c], group, x)

    def finish(self, state: Buffers) -> dict[str, np.ndarray | pa.Array]:
        n, none = state["n"], state["n"] == 0
        spread = [int(a) * int(b) - int(c) * int(c) for a, b, c in zip(n, state["ss"], state["s"], strict=True)]
        variance = np.array(spread, np.float64) / np.maximum(1.0, n.astype(np.float64) * n) / 10000.0
        band = np.stack([state[f"b{i}"] for i in range(self.bands)]).argmax(axis=0).astype(np.int32)
        return {"samples": n, "speed_variance": pa.array(variance, mask=none), "modal_band": pa.array(band, mask=none)}
