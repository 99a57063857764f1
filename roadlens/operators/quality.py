"""Data-quality and counter checks (ecu_audit, T7, A14, H4 resample)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.geo import interpolate
from roadlens.functions.signals import airflow_g_per_s, fuel_rate_lps, gear_from_speed, intake_temp_c
from roadlens.operators.motion import KEY, ORDER, seconds_between
from roadlens.operators.ordered import DEFAULT_BUCKET_S, fitting_bucket, order_key, with_buckets, with_previous

# Half a unit of the wire rounding of each field, and room for float error
# where a value lies on a half unit.
MAF_HALF = 0.0005
TEMP_HALF = 0.005
FUEL_HALF_L = 0.00005
THROTTLE_HALF_PCT = 0.005
FLOAT_ROOM = 1e-9


def ecu_audit(t: DataFrame, vehicles: DataFrame, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Recompute gear (H5), airflow (H6), intake temperature (H7) and the
    fuel counter step (H8 * dt) and return rows outside rounding tolerance.

    Throttle itself is rounded on the wire, so the airflow that the vehicle
    had may differ from the recomputed one by what half a unit of throttle
    gives at its engine speed; that bound goes into the fuel step, too."""
    # Ordered pass on the telemetry rows alone, then the dimension join: the
    # shuffle by (vehicle, bucket) carries no dimension columns.
    d = with_previous(t, KEY, ORDER, ["event_time", "fuel_consumed_l"], bucket_s=bucket_s)
    d = d.join(vehicles.select("vehicle_id", "displacement_l", "ambient_c", "fuel_type"), "vehicle_id", "left")
    exp_maf = airflow_g_per_s("displacement_l")
    exp_intake = intake_temp_c("ambient_c")
    dt = seconds_between("event_time", "prev_event_time")
    exp_fuel = fuel_rate_lps(exp_maf, "rpm", "fuel_type") * dt
    throttle_g = airflow_g_per_s("displacement_l", throttle_pct=F.lit(THROTTLE_HALF_PCT))
    throttle_l = throttle_g / F.lit(S.AIR_FUEL_RATIO) / F.lit(S.FUEL_DENSITY_G_PER_L) * dt
    d = d.select(
        "vehicle_id",
        "event_time",
        (F.col("gear") == gear_from_speed()).alias("gear_ok"),
        (F.abs(F.col("maf_g_per_s") - exp_maf) <= F.lit(MAF_HALF + FLOAT_ROOM) + throttle_g).alias("maf_ok"),
        (F.abs(F.col("intake_air_temp_c") - exp_intake) <= F.lit(TEMP_HALF + FLOAT_ROOM)).alias("intake_ok"),
        F.when(
            F.col("prev_event_time").isNotNull(),
            F.abs(F.col("fuel_consumed_l") - F.col("prev_fuel_consumed_l") - exp_fuel) <= F.lit(2.0 * FUEL_HALF_L + FLOAT_ROOM) + throttle_l,
        ).alias("fuel_ok"),
    )
    bad = ~F.col("gear_ok") | ~F.col("maf_ok") | ~F.col("intake_ok") | ~F.coalesce(F.col("fuel_ok"), F.lit(True))
    return d.where(F.coalesce(bad, F.lit(True)))


def late_records(df: DataFrame, arrival: str = "arrival_time", width: str = S.VEHICLE_WINDOW, hold: str = S.LATE_HOLD) -> DataFrame:
    """Rows that reached the pipeline after their window closed and its
    hold expired (``arrival > window_end + hold``), with the lateness."""
    from roadlens.operators.windows import interval_seconds

    hold_s = interval_seconds(hold)
    d = df.withColumn("window_end", F.window("event_time", width).end)
    late = F.col(arrival) > F.timestamp_add("SECOND", F.lit(hold_s), F.col("window_end"))
    return d.where(late).select(
        "vehicle_id",
        "event_time",
        F.col(arrival).alias("arrival_time"),
        "window_end",
        seconds_between(arrival, "window_end").alias("late_seconds"),
    )


def fuel_usage(t: DataFrame) -> DataFrame:
    """Litres and fuel percent used per trip from the monotone counters,
    ordered by (event time, sequence)."""
    o = F.col("_o")
    d = t.withColumn("_o", order_key(t, [c for c in ORDER if c in t.columns]))
    g = d.where(F.col("trip_id").isNotNull()).groupBy("vehicle_id", "trip_id").agg(
        F.min_by("fuel_consumed_l", o).alias("_l0"),
        F.max_by("fuel_consumed_l", o).alias("_l1"),
        F.min_by("fuel_pct", o).alias("_p0"),
        F.max_by("fuel_pct", o).alias("_p1"),
    )
    return g.select(
        "vehicle_id",
        "trip_id",
        F.round(F.col("_l1") - F.col("_l0"), 4).alias("fuel_used_l"),
        F.round(F.col("_p0") - F.col("_p1"), 3).alias("fuel_pct_drop"),
    )


def refuels(t: DataFrame, below_pct: float = S.REFUEL_BELOW_PCT, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Refuel points — fuel level rises after a reading below ``below_pct``."""
    d = with_previous(t, KEY, ORDER, ["fuel_pct"], bucket_s=bucket_s)
    cond = (F.col("prev_fuel_pct") < F.lit(below_pct)) & (F.col("fuel_pct") > F.col("prev_fuel_pct"))
    return d.where(cond).select(
        "vehicle_id", "event_time", F.col("prev_fuel_pct").alias("fuel_before"), F.col("fuel_pct").alias("fuel_after")
    )


GRID_SPAN = 1000


def _rounded(x: Column, digits: int) -> Column:
    """``F.round`` of a double, which goes through decimal text: whole units of
    the last digit give the same double, and only values close to a half of
    one, very large ones and those that are no numbers take the long way."""
    x = x.cast("double")
    y = x * F.lit(10.0**digits)
    plain = (F.abs(y) < 2.0**40) & (F.abs(y - F.floor(y) - 0.5) > 1e-3)
    return F.when(plain, F.floor(y + 0.5).cast("double") / F.lit(10.0**digits)).otherwise(F.round(x, digits))


def resample(t: DataFrame, step_s: int = 1, cols=("lat", "lon", "speed_kmh"), bucket_s: int | None = None) -> DataFrame:
    """H4 re-aimed: positions on a fixed time grid, linearly interpolated
    between consecutive readings of a vehicle. ``bucket_s``: width of the
    ordered pass's buckets; by the readings' density if not given.

    Grid points ``g`` (multiples of ``step_s`` since the epoch) with
    ``prev_time < g <= time`` are generated per pair of readings in two
    steps, first the spans of ``GRID_SPAN`` points that the gap covers and
    then the points of each span, so no row holds an array as long as its gap.
    """
    cols = list(cols)
    # Columns that no one reads would be sorted and shuffled, too.
    t = t.select(*dict.fromkeys([*KEY, *ORDER, *cols]))
    if bucket_s is None:
        bucket_s = fitting_bucket(t, KEY, "event_time")
        t = with_buckets(t, KEY, "event_time", bucket_s)
    d = with_previous(t, KEY, ORDER, ["event_time", *cols], bucket_s=bucket_s)
    d = d.where(F.col("prev_event_time").isNotNull())
    us = F.lit(step_s * 1_000_000)
    p_us = F.unix_micros(F.col("prev_event_time").cast("timestamp"))
    c_us = F.unix_micros(F.col("event_time").cast("timestamp"))
    first = (F.floor(p_us / us) + 1) * us
    last = F.floor(c_us / us) * us
    span = GRID_SPAN * step_s * 1_000_000
    d = d.where(last >= first).withColumn("s_us", F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(span).cast("long"))))
    end = F.least(F.col("s_us") + F.lit(span) - us, last).cast("long")
    d = d.withColumn("g_us", F.explode(F.sequence(F.col("s_us"), end, us.cast("long"))))
    frac = (F.col("g_us") - p_us).cast("double") / (c_us - p_us).cast("double")
    out = [
        "vehicle_id",
        F.timestamp_micros("g_us").cast(t.schema["event_time"].dataType).alias("grid_time"),
    ]
    # Interpolated values are quantised to their wire precision.
    out += [_rounded(interpolate(F.col(f"prev_{c}"), F.col(c), frac), S.QUANTIZE_DP.get(c, 6)).alias(c) for c in cols]
    return d.select(*out)

