"""Row-to-row motion signals per vehicle.

All scans run through :mod:`roadlens.operators.ordered`, so a vehicle with
a large share of the rows is split over time buckets instead of landing in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.geo import haversine_km, kmh_to_mps, wrap_angle
from roadlens.operators.ordered import DEFAULT_BUCKET_S, scan, with_previous

KEY = ["vehicle_id"]
ORDER = ["event_time", "seq"]
DIST_DP = 6


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))).cast("double") / F.lit(1e6)


def exact_km(c: Column) -> Column:
    """Distance rounded to 6 dp as an exact decimal, so sums do not drift."""
    return F.round(c, DIST_DP).cast("decimal(18,6)")


def step_distance(t: DataFrame, keys=KEY, order=ORDER, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Km from the previous position of the same vehicle (0 on the first row)."""
    d = with_previous(t, keys, order, ["lat", "lon"], bucket_s=bucket_s)
    step = F.when(F.col("prev_lat").isNull(), F.lit(0.0)).otherwise(haversine_km("prev_lat", "prev_lon", "lat", "lon"))
    return d.withColumn("step_distance_km", F.round(step, DIST_DP)).drop("prev_lat", "prev_lon")


def add_acceleration(t: DataFrame, keys=KEY, order=ORDER, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Acceleration in m/s^2 = delta speed / delta t; null on the first row or when delta t = 0."""
    d = with_previous(t, keys, order, ["speed_kmh", "event_time"], bucket_s=bucket_s)
    dt = seconds_between("event_time", "prev_event_time")
    acc = F.when(dt > 0, kmh_to_mps(F.col("speed_kmh") - F.col("prev_speed_kmh")) / dt)
    return d.withColumn("accel_mps2", acc).drop("prev_speed_kmh", "prev_event_time")


def _moving(min_speed_mps: float = S.HEADING_MIN_SPEED_MPS) -> Column:
    return kmh_to_mps("speed_kmh") > F.lit(min_speed_mps)


def heading_running(min_speed_mps: float = S.HEADING_MIN_SPEED_MPS) -> dict:
    """Running specs for W4: last moving heading up to and before this row."""
    moving_heading = F.when(_moving(min_speed_mps), F.col("heading_deg"))
    return {"_hd_cur": (moving_heading, "last", True), "_hd_prev": (moving_heading, "last", False)}


def heading_columns(min_speed_mps: float = S.HEADING_MIN_SPEED_MPS) -> list[Column]:
    delta = F.when(
        _moving(min_speed_mps) & F.col("_hd_prev").isNotNull(),
        wrap_angle(F.col("_hd_cur") - F.col("_hd_prev")),
    )
    return [F.col("_hd_cur").alias("effective_heading_deg"), delta.alias("heading_delta_deg")]


def add_heading_delta(
    t: DataFrame,
    keys=KEY,
    order=ORDER,
    min_speed_mps: float = S.HEADING_MIN_SPEED_MPS,
    bucket_s: int = DEFAULT_BUCKET_S,
) -> DataFrame:
    """Heading is only updated while moving faster than ``min_speed_mps``,
    otherwise carried forward; the wrapped change is reported on moving rows
    that have an earlier heading. One ordered pass."""
    d = scan(t, keys, order, running=heading_running(min_speed_mps), bucket_s=bucket_s)
    return d.select("*", *heading_columns(min_speed_mps)).drop("_hd_cur", "_hd_prev")


def sustained_running(cond: Column, name: str) -> dict:
    """Running specs for W5: time of the last false row, and the first row's time."""
    return {
        f"_{name}_false": (F.when(~F.coalesce(cond, F.lit(False)), F.col("event_time")), "max", True),
        f"_{name}_t0": (F.col("event_time"), "min", True),
    }


def sustained_column(cond: Column, name: str) -> Column:
    anchor = F.coalesce(F.col(f"_{name}_false"), F.col(f"_{name}_t0"))
    return F.when(F.coalesce(cond, F.lit(False)), seconds_between("event_time", anchor)).otherwise(F.lit(0.0))


def add_sustained_seconds(
    t: DataFrame, cond: Column, out: str, keys=KEY, order=ORDER, bucket_s: int = DEFAULT_BUCKET_S, keep_bucket: bool = False
) -> DataFrame:
    """Seconds a condition has held continuously up to this row; 0 when false.

    The clock adds the time since the previous row on every true row and is
    reset on a false row, so on a true row it equals the time since the last
    false row (or since the vehicle's first row). One ordered pass.
    """
    d = scan(t, keys, order, running=sustained_running(cond, out), bucket_s=bucket_s, keep_bucket=keep_bucket)
    return d.withColumn(out, sustained_column(cond, out)).drop(f"_{out}_false", f"_{out}_t0")


def add_rising_edge(t: DataFrame, cond: Column, out: str, keys=KEY, order=ORDER, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """True only on rows where ``cond`` becomes true (false or absent before)."""
    d = t.withColumn("_cond", F.coalesce(cond, F.lit(False)))
    d = with_previous(d, keys, order, ["_cond"], bucket_s=bucket_s)
    return d.withColumn(out, F.col("_cond") & ~F.coalesce(F.col("prev__cond"), F.lit(False))).drop("_cond", "prev__cond")
