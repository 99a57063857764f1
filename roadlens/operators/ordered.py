"""Skew-safe ordered scans per key: previous-row values and running aggregates.

A plain ``Window.partitionBy(vehicle).orderBy(ts)`` sends every row of one
vehicle to one task; if one key holds a third of the data, so does that task.
:func:`scan` splits each key's series into time buckets:

* inside a bucket the window functions run on ``partitionBy(key, bucket)``;
* what crosses a bucket boundary (the last row of the previous non-empty
  bucket, the aggregate of all earlier buckets) comes from a per-(key,
  bucket) table with one row per bucket, aggregated map-side and joined
  back on ``(key, bucket)``.

The row-level window and the join share one hash partitioning on
``(key, bucket)``, so a hot key is spread over as many tasks as it has
buckets. All lags and running aggregates of one call share a single pass
(one window stage, one bucket table, one join). Results equal the
unbucketed window functions.

The bucket table is built with fixed-width aggregation buffers only: the
"last row" of a bucket is ``max_by(value, key)`` where ``key`` packs the
ordering columns (a timestamp and an integral tiebreak) into one exact
``decimal(38,0)``. Spark then hash-aggregates it map-side (no sort of the
input rows); a struct ordering would force a sort-based aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET_S = 3_600  # one hour: ~3,600 rows per vehicle-bucket at 1 Hz


def bucket_col(bucket_s: int) -> str:
    """Name of the time-bucket column of a given width."""
    return f"_scan_bucket_{bucket_s}"


_AGG = {"sum": F.sum, "max": F.max, "min": F.min}

# Packing of (timestamp, integral tiebreak) into one decimal(38,0):
# microseconds + 1e17 (positive for years 1..9999, at most 18 digits) times
# 1e20, plus tiebreak + 2^63 + 1 (1 .. 2^64, at most 20 digits). A null part
# packs as 0, i.e. before every value, like NULLS FIRST in the window order.
_T_SHIFT = 10**17
_S_SHIFT = 2**63 + 1
_S_SPAN = 10**20
_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def _dec(n: int) -> Column:
    return F.expr(f"CAST({n} AS DECIMAL(38,0))")


def order_key(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One fixed-width value that sorts like ``order`` (ascending, nulls
    first), or None when ``order`` is not a timestamp optionally followed by
    one integral column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if not order or len(order) > 2 or any(c not in types for c in order):
        return None
    if not isinstance(types[order[0]], _TIMES):
        return None
    if len(order) == 2 and not isinstance(types[order[1]], _INTEGRAL):
        return None
    micros = F.unix_micros(F.col(order[0]).cast("timestamp")).cast("decimal(38,0)")
    key = F.coalesce(micros + _dec(_T_SHIFT), _dec(0)) * _dec(_S_SPAN)
    if len(order) == 2:
        key = key + F.coalesce(F.col(order[1]).cast("decimal(38,0)") + _dec(_S_SHIFT), _dec(0))
    return key.cast("decimal(38,0)")


def time_bucket_id(ts: str | Column, bucket_s: int) -> Column:
    """Integer bucket number of a timestamp (epoch aligned)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(bucket_s * 1_000_000)).cast("long")


#: Widths that :func:`fitting_bucket` chooses from, narrowest first.
BUCKETS_S = tuple(DEFAULT_BUCKET_S * 8**k for k in range(5))
_ROWS_A_BUCKET = 16
_MOST_ROWS = 1_000_000  # of a bucket, which one task sorts
_CELLS = 8192


def fitting_bucket(df: DataFrame, keys: Sequence[str], ts: str) -> int:
    """Narrowest of :data:`BUCKETS_S` whose buckets hold some rows each, so
    that :func:`scan`'s bucket table, which is shuffled three times, is small
    beside the rows; the widest for keys with fewer rows yet. No bucket gets
    more than a bounded number of rows but those of the default width. Reads
    ``df`` twice at least; only counts of hashed buckets are shuffled."""
    hashed = [F.xxhash64(*keys, time_bucket_id(ts, s)) for s in BUCKETS_S]
    rows, *groups = df.agg(F.count(F.lit(1)), *[F.approx_count_distinct(h) for h in hashed]).first()
    at = next((i for i, n in enumerate(groups) if rows >= _ROWS_A_BUCKET * n), len(groups) - 1)
    while at:
        cells = df.groupBy(F.pmod(hashed[at], F.lit(_CELLS)).alias("_cell")).count()
        if (cells.agg(F.max("count")).first()[0] or 0) <= _MOST_ROWS:
            break
        at -= 1
    return BUCKETS_S[at]


def with_buckets(df: DataFrame, keys: Sequence[str], ts: str, bucket_s: int) -> DataFrame:
    """``df`` with the bucket column that :func:`scan` takes. Rows without a
    key, which nothing is carried to, have buckets of the default width."""
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    return df.withColumn(bucket_col(bucket_s), F.when(there, time_bucket_id(ts, bucket_s)).otherwise(time_bucket_id(ts, DEFAULT_BUCKET_S)))


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    prev: Sequence[str] = (),
    running: Mapping[str, tuple[Column, str, bool]] | None = None,
    prefix: str = "prev_",
    bucket_s: int = DEFAULT_BUCKET_S,
    keep_bucket: bool = False,
) -> DataFrame:
    """One ordered pass per key.

    * ``prev``: columns whose previous-row value is added as ``prefix + c``
      (null on the key's first row);
    * ``running``: ``out -> (value, kind, inclusive)`` with kind ``sum``,
      ``max``, ``min`` or ``last`` (the last non-null value in order);
      ``inclusive=False`` aggregates the rows strictly before the current
      one.

    ``order[0]`` must be the timestamp used for bucketing; keys and
    ``order[0]`` must be non-null (the bucket carry is an equi-join on
    them; the decoders quarantine readings without vehicle or time). Passes chained
    with ``keep_bucket=True`` share the bucket column, so the second pass
    finds its input already hash-partitioned by (key, bucket) and does not
    shuffle the rows again; drop the column after the last pass.
    """
    keys, order, prev = list(keys), list(order), list(prev)
    running = dict(running or {})
    _B = bucket_col(bucket_s)
    reuse = _B in df.columns
    d = df if reuse else df.withColumn(_B, time_bucket_id(order[0], bucket_s))
    for i, (out, (value, _kind, _inc)) in enumerate(running.items()):
        d = d.withColumn(f"_scan_v{i}", value)

    w = Window.partitionBy(*keys, _B).orderBy(*_cols(order))
    w_inc = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_exc = w.rowsBetween(Window.unboundedPreceding, -1)
    cols = []
    if prev:
        cols.append(F.lag(F.lit(1)).over(w).isNull().alias("_scan_first"))
        cols += [F.lag(c).over(w).alias(f"_scan_lag_{c}") for c in prev]
    for i, (out, (_v, kind, inc)) in enumerate(running.items()):
        frame = w_inc if inc else w_exc
        if kind == "last":
            agg = F.last(f"_scan_v{i}", ignorenulls=True).over(frame)
        else:
            agg = _AGG[kind](f"_scan_v{i}").over(frame)
        cols.append(agg.alias(f"_scan_in{i}"))
    rows = d
    d = d.select("*", *cols)

    # Per-(key, bucket) summary: last row and bucket aggregates, built from
    # the input rows (not the window output) so it aggregates map-side.
    key = order_key(rows, order)
    if key is not None:
        rows = rows.withColumn("_scan_ok", key)
        key = F.col("_scan_ok")
    else:  # sort-based aggregate: correct, but sorts the rows map-side
        key = F.struct(*_cols(order))

    def last_of(c: Column, only: Column | None = None) -> Column:
        return F.max_by(c, key if only is None else F.when(only, key))

    aggs = [last_of(F.col(c)).alias(f"_scan_last{j}") for j, c in enumerate(prev)]
    for i, (_out, (_v, kind, _inc)) in enumerate(running.items()):
        v = F.col(f"_scan_v{i}")
        aggs.append((last_of(v, v.isNotNull()) if kind == "last" else _AGG[kind](v)).alias(f"_scan_tot{i}"))
    summary = rows.groupBy(*keys, _B).agg(*aggs)
    wb = Window.partitionBy(*keys).orderBy(_B)
    wb_before = wb.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = []
    if prev:
        carry_cols += [F.lag(f"_scan_last{j}").over(wb).alias(f"_scan_carry{j}") for j in range(len(prev))]
    for i, (_out, (_v, kind, _inc)) in enumerate(running.items()):
        if kind == "last":
            before = F.last(f"_scan_tot{i}", ignorenulls=True).over(wb_before)
        else:
            before = _AGG[kind](f"_scan_tot{i}").over(wb_before)
        carry_cols.append(before.alias(f"_scan_before{i}"))
    carry = summary.select(*keys, _B, *carry_cols)
    d = d.join(carry, on=[*keys, _B], how="left")

    outs, drop = [], ([] if (keep_bucket or reuse) else [_B])
    if prev:
        for j, c in enumerate(prev):
            outs.append(
                F.when(F.col("_scan_first"), F.col(f"_scan_carry{j}")).otherwise(F.col(f"_scan_lag_{c}")).alias(prefix + c)
            )
        drop += ["_scan_first", *[f"_scan_carry{j}" for j in range(len(prev))], *[f"_scan_lag_{c}" for c in prev]]
    for i, (out, (_v, kind, _inc)) in enumerate(running.items()):
        a, b = F.col(f"_scan_in{i}"), F.col(f"_scan_before{i}")
        if kind == "sum":
            res = F.when(b.isNull(), a).when(a.isNull(), b).otherwise(a + b)
        elif kind == "last":
            res = F.coalesce(a, b)
        elif kind == "max":
            res = F.greatest(a, b)
        else:
            res = F.least(a, b)
        outs.append(res.alias(out))
        drop += [f"_scan_v{i}", f"_scan_in{i}", f"_scan_before{i}"]
    return d.select("*", *outs).drop(*drop)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    bucket_s: int = DEFAULT_BUCKET_S,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key."""
    return scan(df, keys, order, prev=cols, prefix=prefix, bucket_s=bucket_s, keep_bucket=keep_bucket)


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    kind: str = "sum",
    bucket_s: int = DEFAULT_BUCKET_S,
    inclusive: bool = True,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add ``out`` = running ``sum``/``max``/``min`` of ``value`` per key."""
    return scan(df, keys, order, running={out: (value, kind, inclusive)}, bucket_s=bucket_s, keep_bucket=keep_bucket)


def drop_bucket(df: DataFrame, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Drop the shared bucket column after the last chained pass."""
    return df.drop(bucket_col(bucket_s))


def changed_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    bucket_s: int = DEFAULT_BUCKET_S,
    checkpoint: bool = True,
) -> DataFrame:
    """Rows where any of ``cols`` differs (null-safe) from the previous row
    of the same key, with the previous values as ``prefix + c`` (null on
    the key's first row, which is always kept).

    Same result as :func:`with_previous` followed by that filter, but the
    rows are shuffled once: inside a (key, bucket) window every row except
    the bucket's first sees its previous row, so only changed rows, the
    bucket's first row (still to resolve) and its last row (what the next
    bucket's first row compares with) leave the stage. That small table is
    written once to the shared checkpoint folder (``checkpoint=True``) and
    read twice: for the per-bucket last rows, carried to the next bucket by
    a window over each key's buckets, and for the rows themselves.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    _B = bucket_col(bucket_s)
    reuse = _B in df.columns
    d = df if reuse else df.withColumn(_B, time_bucket_id(order[0], bucket_s))
    w = Window.partitionBy(*keys, _B).orderBy(*_cols(order))
    d = d.select(
        "*",
        F.lag(F.lit(1)).over(w).isNull().alias("_chg_first"),
        F.lead(F.lit(1)).over(w).isNull().alias("_chg_last"),
        *[F.lag(c).over(w).alias(f"_chg_lag_{c}") for c in cols],
    )

    def differs(prev: str) -> Column:
        out = F.lit(False)
        for c in cols:
            out = out | ~F.col(c).eqNullSafe(F.col(prev.format(c)))
        return out

    small = d.where(F.col("_chg_first") | F.col("_chg_last") | differs("_chg_lag_{}"))
    if checkpoint:
        from roadlens.session import cut_lineage

        small = cut_lineage(small)
    wb = Window.partitionBy(*keys).orderBy(_B)
    carry = small.where(F.col("_chg_last")).select(
        *keys,
        _B,
        F.lag(F.lit(1)).over(wb).isNull().alias("_chg_key_first"),
        *[F.lag(c).over(wb).alias(f"_chg_carry_{c}") for c in cols],
    )
    out = small.join(carry, [*keys, _B], "left")
    out = out.select(
        "*",
        *[
            F.when(F.col("_chg_first"), F.col(f"_chg_carry_{c}")).otherwise(F.col(f"_chg_lag_{c}")).alias(prefix + c)
            for c in cols
        ],
    )
    out = out.where((F.col("_chg_first") & F.col("_chg_key_first")) | differs(prefix + "{}"))
    helper = ["_chg_first", "_chg_last", "_chg_key_first", *[f"_chg_lag_{c}" for c in cols], *[f"_chg_carry_{c}" for c in cols]]
    return out.drop(*helper, *([] if reuse else [_B]))
