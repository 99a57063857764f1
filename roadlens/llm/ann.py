"""Exact nearest neighbours by cosine: a block matrix join on int8 tiles."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
QUERY_BLOCK = 512


def usable(v: Column) -> Column:
    """Not null, every component finite, and not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two float vectors: sums rounded once, so equal vectors give
    equal scores whatever block they sit in."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    na, nb = math.fsum(x * x), math.fsum(y * y)
    return math.fsum(x * y) / (math.sqrt(na) * math.sqrt(nb))


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of unit length -> (int8 codes, scale per row, bound on the length
    of what rounding left out)."""
    unit = m.astype(np.float64)
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = unit - codes * scale[:, None]
    return codes, scale, np.sqrt((rest * rest).sum(axis=1)) + 1e-9


def tile_top(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k nearest rows of ``c`` for each row of ``q`` (same id excluded),
    ties to the smaller id. Int8 products give each cosine up to a bound; a
    pair stays if its upper bound reaches the k-th largest lower bound, and
    what stays is computed anew from the floats."""
    qc, qs, qe = quantise(q)
    cc, cs, ce = quantise(c)
    # int8 products of up to 1000 components are exact in float32 sums.
    prod = (qc.astype(np.float32) @ cc.astype(np.float32).T).astype(np.float64) * (qs[:, None] * cs[None, :])
    # |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|, with |y| = 1, |x'| <= 1 + e.
    err = qe[:, None] + (1.0 + qe[:, None]) * ce[None, :] + 1e-9
    own = q_ids[:, None] == c_ids[None, :]
    low = np.where(own, -np.inf, prod - err)
    high = np.where(own, -np.inf, prod + err)
    m = min(k, len(c_ids))
    floor = np.partition(low, len(c_ids) - m, axis=1)[:, len(c_ids) - m]
    out: list[tuple[int, int, float]] = []
    for i in range(len(q_ids)):
        near = np.flatnonzero((high[i] >= floor[i]) & ~own[i])
        if len(near) > 64 * k:  # many equal vectors: score each distinct one once
            _, first, back = np.unique(c[near], axis=0, return_index=True, return_inverse=True)
            vals = np.array([cosine(q[i], c[near[j]]) for j in first])[back.ravel()]
        else:
            vals = np.array([cosine(q[i], c[j]) for j in near])
        best = heapq.nsmallest(k, zip((-vals).tolist(), c_ids[near].tolist(), strict=True))
        out.extend((int(q_ids[i]), v, -s) for s, v in best)
    return out


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> ``query_id, rank, vec_id, score``:
    for each row whose id is divisible by ``every``, the ``k`` rows of largest
    cosine among all other rows, nearest first, ties to the smaller id; all of
    them if there are fewer.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows without id; vectors of different lengths are never
    compared; repeated rows are repeated candidates unless they have the
    query's own id; a repeated query id is one query by its smallest vector.
    No rows give no rows; other columns are ignored.

    Candidates are packed in blocks of ``block`` rows by a hash of the id,
    queries in blocks of ``query_block``. Each query block meets each
    candidate block in one row of a join, so a task holds one tile, and a tile
    gives at most k rows a query. Tiles are merged per query block by heaps."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("v")).where(
        F.col("vec_id").isNotNull() & usable(F.col("v"))
    )
    v = v.withColumn("dim", F.size("v"))
    q = v.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    n, nq = _sizes(v), _sizes(q)

    def packed(df: DataFrame, counts: dict[int, int], rows: int, name: str) -> DataFrame:
        parts = F.coalesce(*[F.when(F.col("dim") == d, F.lit(max(1, -(-c // rows)))) for d, c in counts.items()], F.lit(1))
        b = df.withColumn(name, F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
        return b.groupBy("dim", name).agg(
            F.collect_list(F.struct("vec_id", "v")).alias("rows")
        )

    cand = packed(v, n, block, "cb").withColumnRenamed("rows", "c")
    quer = packed(q, nq, query_block, "qb").withColumnRenamed("rows", "q")
    # A stated query set against all rows, in blocks: each query block is
    # sent once to each candidate block of its vector length.
    cbs = cand.select("dim", "cb").distinct()
    sent = quer.join(cbs, "dim")
    tiles = sent.join(cand, ["dim", "cb"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                qr, cr = b.column("q")[i].values, b.column("c")[i].values
                got = tile_top(
                    _matrix(qr.field("v")), qr.field("vec_id").to_numpy(), _matrix(cr.field("v")), cr.field("vec_id").to_numpy(), k
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b.column("dim")[i].as_py()] * len(got), pa.int32()),
                        pa.array([b.column("qb")[i].as_py()] * len(got), pa.int32()),
                        pa.array([g[0] for g in got], pa.int64()),
                        pa.array([g[1] for g in got], pa.int64()),
                        pa.array([g[2] for g in got], pa.float64()),
                    ],
                    names=["dim", "qb", "query_id", "vec_id", "score"],
                )

    scored = tiles.select("dim", "qb", "q", "c").mapInArrow(score, "dim int, qb int, query_id long, vec_id long, score double")

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        out = []
        for qid, rows in g.groupby("query_id"):
            best = heapq.nsmallest(k, zip(-rows["score"], rows["vec_id"], strict=True))
            out.extend((qid, r + 1, v, -s) for r, (s, v) in enumerate(best))
        return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])

    return scored.groupBy("dim", "qb").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")


def _sizes(df: DataFrame) -> dict[int, int]:
    """Rows per vector length: a few numbers that size the blocks."""
    return {r["dim"]: r["n"] for r in df.groupBy("dim").agg(F.count("*").alias("n")).collect()}
