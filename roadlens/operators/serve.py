"""Serving queries over the history and window tables (Q1-Q11, L1-L5, W1,
W7, A9-A13, S15, J3, J7, T12, T13, T15).

Top-k per vehicle uses ``row_number() <= k``; Spark plans it with a
partial ``WindowGroupLimit`` before the shuffle, so each map task ships at
most ``k`` rows per vehicle and a hot vehicle costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.signals import age_seconds, build_key, iso_utc_seconds
from roadlens.operators.ordered import order_key

ORDER = ["event_time", "seq"]


LATEST_VALUES = ("lat", "lon", "speed_kmh", "engine_temp_c")


def latest_state(t: DataFrame) -> DataFrame:
    """L5 + P2 (Q1): latest row per vehicle by (event time, sequence), not
    arrival, as the 6-field latest-state record.

    One ``max_by(value, key)`` per field, the key packing both into one
    fixed-width value: the aggregation is hashed map-side (one row per vehicle
    per task leaves the task) and all fields come from the same reading.
    """
    d = t.withColumn("_o", order_key(t, [c for c in ORDER if c in t.columns]))
    g = d.groupBy("vehicle_id").agg(*[F.max_by(c, "_o").alias(c) for c in LATEST_VALUES], F.max("event_time").alias("_t"))
    return g.select("vehicle_id", *LATEST_VALUES, iso_utc_seconds(F.col("_t")).alias("updated_at"))


def latest_blobs(latest: DataFrame) -> DataFrame:
    """S14 payload: key ``vehicle:latest:<id>`` -> JSON text of the record."""
    return latest.select(
        build_key(S.LATEST_KEY_PREFIX).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in S.LATEST_FIELDS])).alias("value"),
    )


def fleet_snapshot(latest: DataFrame, now: Column, shards: int = 64) -> DataFrame:
    """S15 (Q10): snapshot messages ``{type, ts, vehicles:[{id, ...record}]}``.

    Vehicles are dealt over ``shards`` messages by a hash of their id, whatever
    the size of the fleet, and sorted by id inside each; size the parameter so
    that fleet / shards vehicles make a message.
    """
    shard = (F.conv(F.substring(F.md5(F.col("vehicle_id").cast("binary")), 1, 8), 16, 10).cast("long") % shards).cast("int")
    v = latest.select(shard.alias("shard"), F.struct(F.col("vehicle_id").alias("id"), *S.LATEST_FIELDS).alias("v"))
    g = v.groupBy("shard").agg(F.sort_array(F.collect_list("v")).alias("vehicles"))
    msg = F.struct(F.lit(S.SNAPSHOT_TYPE).alias("type"), iso_utc_seconds(now).alias("ts"), F.col("vehicles"))
    return g.select("shard", F.size("vehicles").alias("vehicle_count"), F.to_json(msg, {"ignoreNullFields": "false"}).alias("message"))


def vehicles_reporting(latest: DataFrame) -> DataFrame:
    """A11 (Q2): number of vehicles with a position."""
    return latest.agg(F.count("lat").alias("vehicles_reporting"))


def top_n_per_key(df: DataFrame, n: int, keys=("vehicle_id",), order: list[Column] | None = None) -> DataFrame:
    """Newest ``n`` rows per key."""
    order = order or [F.col("event_time").desc(), F.col("seq").desc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def last_points(t: DataFrame, n: int = S.LIVE_POINTS) -> DataFrame:
    """W1 (Q11): rolling live-chart series, last ``n`` speed/temperature points per vehicle."""
    return top_n_per_key(t.select("vehicle_id", "event_time", "seq", "speed_kmh", "engine_temp_c"), n).drop("seq")


def latest_windows(windows: DataFrame, n: int = 60) -> DataFrame:
    """Q4/Q5: newest ``n`` windows per vehicle."""
    return top_n_per_key(windows, n, order=[F.col("window_start").desc()])


def history(df: DataFrame, start=None, end=None, vehicles=None, closed: str = "left", ascending: bool | None = None) -> DataFrame:
    """P4/P5/L4 (Q8, Q9): scan by vehicle(s) and time range.

    ``closed="left"`` is the half-open ``[start, end)`` range, ``"both"`` the
    inclusive one. Predicates reach the Parquet scan. ``ascending`` sorts the
    result by vehicle and time, oldest (True) or newest (False) first; None
    leaves it unsorted.
    """
    cond = F.lit(True)
    if vehicles is not None:
        cond = cond & F.col("vehicle_id").isin(*vehicles)
    if start is not None:
        cond = cond & (F.col("event_time") >= F.lit(start).cast(df.schema["event_time"].dataType))
    if end is not None:
        e = F.lit(end).cast(df.schema["event_time"].dataType)
        cond = cond & ((F.col("event_time") <= e) if closed == "both" else (F.col("event_time") < e))
    out = df.where(cond)
    if ascending is None:
        return out
    order = [c for c in ("event_time", "seq", "event_id") if c in df.columns]
    return out.orderBy("vehicle_id", *[F.col(c).asc() if ascending else F.col(c).desc() for c in order])


def recent_window(t: DataFrame, minutes: float = 12.0) -> DataFrame:
    """Per vehicle, the rows in the ``minutes`` ending at its latest sample."""
    last = t.groupBy("vehicle_id").agg(F.max("event_time").alias("_last"))
    j = t.join(last, "vehicle_id")
    cutoff = F.timestamp_add("SECOND", F.lit(-int(minutes * 60)), F.col("_last"))
    return j.where(F.col("event_time") >= cutoff).drop("_last")


def peek(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """L3 (Q6): first ``n`` rows in a fixed order (deterministic LIMIT)."""
    return df.orderBy(*order).limit(n)


def latest_day(fleet: DataFrame) -> DataFrame:
    """Q7: fleet rows of the newest day bucket."""
    last = fleet.agg(F.max("day_bucket").alias("_d"))
    return fleet.join(last, fleet["day_bucket"] == last["_d"], "left_semi")


def align_series(df: DataFrame, time: str, key: str, keys: list[str], value: Column) -> DataFrame:
    """Several series side by side on ``time``, one column per key value.

    ``value`` is an aggregate expression evaluated per (time, key) cell (so
    a cell with several readings has a defined value); the key values are
    listed, so Spark does not run a job to discover them, and the pivot is
    aggregated map-side like any grouped aggregate."""
    return df.groupBy(time).pivot(key, list(keys)).agg(value)


def extents(t: DataFrame, by: str = "vehicle_id") -> DataFrame:
    """lat/lon bounds, time range and padded speed range per vehicle."""
    return t.groupBy(by).agg(
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
        F.min("event_time").alias("time_min"),
        F.max("event_time").alias("time_max"),
        (F.min("speed_kmh") * F.lit(0.9)).alias("speed_lo"),
        (F.max("speed_kmh") * F.lit(1.1)).alias("speed_hi"),
    )


def last_not_null(df: DataFrame, value: str, key: str = "vehicle_id", time: str = "window_start") -> DataFrame:
    """Last non-null value of a series per key."""
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(
        F.max_by(value, time).alias(f"last_{value}"), F.max(time).alias(f"last_{time}")
    )


def distinct_vehicles(df: DataFrame) -> DataFrame:
    """A10."""
    return df.select("vehicle_id").distinct()


def table_counts(df: DataFrame, by: str | Column | None = None) -> DataFrame:
    """Row count, whole table or per group (e.g. per day)."""
    if by is None:
        return df.agg(F.count(F.lit(1)).alias("rows"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def silent_vehicles(vehicles: DataFrame, latest: DataFrame) -> DataFrame:
    """Vehicles with no latest record (anti join)."""
    return vehicles.join(latest.select("vehicle_id"), "vehicle_id", "left_anti")


def reporting_vehicles(vehicles: DataFrame, latest: DataFrame) -> DataFrame:
    """Vehicles that do have a latest record (semi join)."""
    return vehicles.join(latest.select("vehicle_id"), "vehicle_id", "left_semi")


def stale_vehicles(latest: DataFrame, now: Column, max_age_s: float = S.FRESHNESS_MAX_AGE_S) -> DataFrame:
    """Latest records older than ``max_age_s`` at ``now``."""
    ts = F.to_timestamp("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    age = age_seconds(ts, now)
    return latest.select("vehicle_id", "updated_at", age.alias("age_s")).where(F.col("age_s") > F.lit(float(max_age_s)))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of nulls per column (one row)."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in cols])


def missing_slots(windows: DataFrame, slide_s: int, col: str = "window_start") -> DataFrame:
    """Slots on the ``slide_s`` grid between the first and last window
    that have no row. The grid grows out of one aggregated row inside the
    same job: first its days, dealt over tasks, then each day's slots."""
    dtype = windows.schema[col].dataType
    micros = F.unix_micros(F.col(col).cast("timestamp"))
    step, day = slide_s * 1_000_000, 86_400_000_000 // (slide_s * 1_000_000) * slide_s * 1_000_000 or slide_s * 1_000_000
    ends = windows.agg(F.min(micros).alias("lo"), F.max(micros).alias("hi")).where("lo IS NOT NULL")
    days = ends.select("hi", F.explode(F.sequence(F.col("lo"), F.col("hi"), F.lit(day))).alias("d")).repartition("d")
    slot = F.explode(F.sequence(F.col("d"), F.least(F.col("d") + day - step, F.col("hi")), F.lit(step)))
    grid = days.select(slot.alias("us")).select(F.timestamp_micros("us").cast(dtype).alias("slot_start"))
    return grid.join(windows.select(F.col(col).alias("slot_start")), "slot_start", "left_anti")


def newest_aligned(df: DataFrame, vehicles: list[str], value: str, n: int, time: str) -> DataFrame:
    """Q3-Q5: the newest ``n`` rows of each chosen vehicle side by side, one
    row per time and one column per vehicle (null where it has none)."""
    keep = df.where(F.col("vehicle_id").isin(*vehicles)).select("vehicle_id", time, value)
    newest = top_n_per_key(keep, n, order=[F.col(time).desc(), F.col(value).desc()])
    return align_series(newest, time, "vehicle_id", vehicles, F.max(value))
