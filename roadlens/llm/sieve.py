"""A bounded Bloom filter, so that a scan sends on only the texts that a later
join wants. What it passes wrongly, the join drops; nothing wanted is held back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.text import mix

BITS_A_KEY = 12
MOST_BITS = 1 << 26  # 8 MB, however many keys; beyond some 10 million it passes ever more
PROBES = 4
_SHARDS = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


def key(*columns: str) -> Column:
    """The hash that stands for a row's key in :func:`sieve` and a scan."""
    return F.xxhash64(*columns).alias("sieve_key")


class Sieve:
    def __init__(self, packed: np.ndarray):
        self.packed = packed

    def has(self, keys: pa.Array) -> np.ndarray:
        """False where a key is certainly not one of the sieve's."""
        ok = np.ones(len(keys), bool)
        for at in _probes(keys, len(self.packed) * 8):
            ok &= (self.packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return ok


def _probes(keys: pa.Array, bits: int) -> Iterator[np.ndarray]:
    h = keys.to_numpy(zero_copy_only=False).view(np.uint64)
    with np.errstate(over="ignore"):
        for i in range(PROBES):
            yield (mix(h + np.uint64(i) * _STEP) & np.uint64(bits - 1)).astype(np.int64)


def passed(rows: DataFrame, column: str, only: Broadcast) -> DataFrame:
    """``rows`` without those whose long ``column`` is certainly not in ``only``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(only.value.has(b.column(column))))

    return rows.mapInArrow(run, rows.schema)


def sieve(keys: DataFrame, expected: int, most_bits: int = MOST_BITS) -> Broadcast:
    """Broadcast sieve of ``keys``, one column of :func:`key`, of which some
    ``expected`` are there. At most ``most_bits`` bits reach the driver: each
    task fills a map of its own, the maps are joined shard by shard."""
    bits = min(most_bits, max(1 << 12, 1 << (BITS_A_KEY * max(1, expected)).bit_length()))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(bits, bool)
        for b in batches:
            for at in _probes(b.column(0), bits):
                on[at] = True
        parts = np.packbits(on).reshape(_SHARDS, -1)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())], names=["shard", "bits"])

    def join(table: pa.Table) -> pa.Table:
        maps = [np.frombuffer(x.as_buffer(), np.uint8) for x in table["bits"]]
        whole = maps[0].copy()
        for m in maps[1:]:
            whole |= m
        return pa.table({"shard": table["shard"][:1], "bits": pa.array([whole.tobytes()], pa.binary())})

    kind = "shard int, bits binary"
    got = keys.mapInArrow(fill, kind).groupBy("shard").applyInArrow(join, kind).toArrow()
    packed = np.zeros((_SHARDS, bits // 8 // _SHARDS), np.uint8)
    for i, x in zip(got["shard"].to_pylist(), got["bits"], strict=True):
        packed[i] = np.frombuffer(x.as_buffer(), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(Sieve(packed.ravel()))
