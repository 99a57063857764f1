"""Scalar signal functions (H5-H15, P3, P6, P10). All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlens import schemas as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_harsh(event_type="event_type", types=S.HARSH_TYPES) -> Column:
    """Event type is one of the harsh types."""
    return _c(event_type).isin(*types)


def gear_from_speed(speed_kmh="speed_kmh", bands=S.GEAR_BANDS_KMH) -> Column:
    """H5: gear 1..5 from speed bands."""
    s = _c(speed_kmh)
    expr = F.when(s < bands[0], F.lit(1))
    for i, b in enumerate(bands[1:], start=2):
        expr = expr.when(s < b, F.lit(i))
    return expr.otherwise(F.lit(len(bands) + 1)).cast("int")


def airflow_g_per_s(displacement_l, rpm="rpm", throttle_pct="throttle_pct") -> Column:
    """H6: mass air flow = displacement * rpm/60 * throttle/100 * air density * fill factor."""
    d, r, t = _c(displacement_l), _c(rpm), _c(throttle_pct)
    return d * (r / 60.0) * (t / 100.0) * S.AIR_DENSITY_G_PER_L * S.MAF_FILL_FACTOR


def intake_temp_c(ambient_c, rpm="rpm") -> Column:
    """H7: intake air temperature = ambient + min(8, rpm / 800)."""
    return _c(ambient_c) + F.least(F.lit(S.INTAKE_MAX_RISE_C), _c(rpm) / S.INTAKE_RPM_DIVISOR)


def fuel_rate_lps(maf="maf_g_per_s", rpm="rpm", fuel_type="fuel_type") -> Column:
    """H8: fuel flow in L/s with fuel-type factor and idle floor."""
    factor = F.lit(1.0)
    for name, f in S.FUEL_TYPE_FACTOR.items():
        if f != 1.0:
            factor = F.when(_c(fuel_type) == name, F.lit(f)).otherwise(factor)
    lps = _c(maf) / S.AIR_FUEL_RATIO / S.FUEL_DENSITY_G_PER_L * factor
    floor = F.when(_c(rpm) <= S.IDLE_RPM, F.lit(S.IDLE_FUEL_FLOOR_LPS)).otherwise(F.lit(0.0))
    return F.greatest(lps, floor)


def local_hour(ts="event_time", tz: str = S.LOCAL_TZ) -> Column:
    """Hour of day in the fleet's local zone; input is a UTC instant (NTZ or LTZ)."""
    return F.hour(F.from_utc_timestamp(_c(ts).cast("timestamp"), tz))


def rush_factor(ts="event_time", tz: str = S.LOCAL_TZ) -> Column:
    """H9: 0.6 inside the local rush hours, 0.95 otherwise."""
    h = local_hour(ts, tz)
    cond = F.lit(False)
    for lo, hi in S.RUSH_HOURS:
        cond = cond | ((h >= lo) & (h < hi))
    return F.when(cond, F.lit(S.RUSH_FACTOR)).otherwise(F.lit(S.NON_RUSH_FACTOR))


def build_key(prefix: str, id_col="vehicle_id") -> Column:
    """``prefix + id``."""
    return F.concat(F.lit(prefix), _c(id_col))


def split_key(key_col) -> Column:
    """Id part after the last ':'."""
    return F.substring_index(_c(key_col), ":", -1)


def age_seconds(ts, now) -> Column:
    """Seconds from ``ts`` to ``now`` (both timestamps)."""
    return F.unix_micros(_c(now).cast("timestamp")) / 1e6 - F.unix_micros(_c(ts).cast("timestamp")) / 1e6


def iso_utc_seconds(ts="event_time") -> Column:
    """Timestamp as ISO-8601 text at second precision with a 'Z' suffix."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def vehicle_state(ignition="ignition_on", speed_kmh="speed_kmh", standstill_kmh: float = S.IDLE_SPEED_MPS * 3.6) -> Column:
    """P10: idle (engine off), stopped (engine on, standstill) or driving."""
    return (
        F.when(~_c(ignition), F.lit("idle"))
        .when(_c(speed_kmh) < standstill_kmh, F.lit("stopped"))
        .otherwise(F.lit("driving"))
    )


def posted_limit(road_class="road_class", override="speed_limit_kmh") -> Column:
    """Per-node override, else the road-class default."""
    m = F.create_map(*[x for k, v in S.ROAD_CLASS_LIMIT_KMH.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(_c(override), m[_c(road_class)]).cast("int")


def quantize(df, dp: dict | None = None):
    """Round telemetry fields to their wire precision."""
    dp = dp or S.QUANTIZE_DP
    return df.select(*[F.round(F.col(c), dp[c]).alias(c) if c in dp else F.col(c) for c in df.columns])
