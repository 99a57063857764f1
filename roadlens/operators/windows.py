"""Event-time window rollups.

All functions work on batch and streaming DataFrames. Per-vehicle windows
group by ``(vehicle_id, window)``; fleet windows are built from 30-second
panes so that each row is expanded into ``width / slide`` windows only after
it has been pre-aggregated per (vehicle, pane).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.signals import is_harsh

SPEED_SCALE = 100  # speeds carry 2 decimals on the wire; sums are exact integers of centi-km/h


def interval_seconds(spec: str | int | float) -> int:
    """'60 seconds' / '5 minutes' / '2 hours' / 300 -> seconds."""
    if isinstance(spec, (int, float)):
        return int(spec)
    n, unit = spec.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.lower().rstrip("s")]
    return int(float(n) * mult)


def centi(c: str | Column = "speed_kmh") -> Column:
    """Speed as exact integer hundredths (sum without rounding drift)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * F.lit(float(SPEED_SCALE))).cast("long")


def exact_mean(sum_centi: Column, n: Column) -> Column:
    """Mean from an exact centi-sum and a count; null when the count is 0."""
    return F.when(n > 0, sum_centi.cast("double") / F.lit(float(SPEED_SCALE)) / n.cast("double"))


def windowed(df: DataFrame, keys: list[str], width: str, aggs: dict[str, Column], slide: str | None = None, ts: str = "event_time") -> DataFrame:
    """Generic keyed window rollup: any Spark aggregate per (keys, window).

    ``aggs`` maps output names to aggregate columns: built-in aggregates, or
    grouped-aggregate pandas UDFs (Spark runs those in a separate
    ``groupBy``, so one call takes either kind, not both)."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = df.groupBy(*keys, w.alias("w")).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggs.keys())


# ---------------------------------------------------------------------------
# Per-vehicle tumbling windows
# ---------------------------------------------------------------------------


def vehicle_speed_windows(t: DataFrame, width: str = S.VEHICLE_WINDOW) -> DataFrame:
    """A1: average and max speed per vehicle per tumbling window."""
    r = t.groupBy("vehicle_id", F.window("event_time", width).alias("w")).agg(
        F.sum(centi()).alias("_s"), F.count("speed_kmh").alias("_n"), F.max("speed_kmh").alias("max_speed_kmh")
    )
    return r.select(
        "vehicle_id",
        F.col("w.start").alias("window_start"),
        exact_mean(F.col("_s"), F.col("_n")).alias("avg_speed_kmh"),
        "max_speed_kmh",
    )


def vehicle_harsh_windows(ev: DataFrame, width: str = S.VEHICLE_WINDOW, harsh=S.HARSH_TYPES) -> DataFrame:
    """A2: harsh-event count per vehicle per window; any event opens the window."""
    r = ev.groupBy("vehicle_id", F.window("event_time", width).alias("w")).agg(
        F.sum(F.when(is_harsh("event_type", harsh), 1).otherwise(0)).cast("long").alias("harsh_event_count")
    )
    return r.select("vehicle_id", F.col("w.start").alias("window_start"), "harsh_event_count")


def _union_signals(t: DataFrame, ev: DataFrame, harsh=S.HARSH_TYPES) -> DataFrame:
    """One row stream with telemetry speed or an event flag."""
    a = t.select("vehicle_id", "event_time", F.col("speed_kmh").cast("double").alias("speed_kmh"), F.lit(None).cast("int").alias("harsh_flag"))
    b = ev.select(
        "vehicle_id",
        "event_time",
        F.lit(None).cast("double").alias("speed_kmh"),
        F.when(is_harsh("event_type", harsh), 1).otherwise(0).alias("harsh_flag"),
    )
    return a.unionByName(b)


def vehicle_windows(t: DataFrame, ev: DataFrame, width: str = S.VEHICLE_WINDOW, harsh=S.HARSH_TYPES) -> DataFrame:
    """A3: combined vehicle-window row, null on the side that had no data.

    One union and one aggregation (no join): avg/max are null when the
    window had no telemetry, harsh_event_count is null when it had no events.
    """
    u = _union_signals(t, ev, harsh)
    r = u.groupBy("vehicle_id", F.window("event_time", width).alias("w")).agg(
        F.sum(centi()).alias("_s"),
        F.count("speed_kmh").alias("_n"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.sum("harsh_flag").cast("long").alias("harsh_event_count"),
    )
    return r.select(
        "vehicle_id",
        F.col("w.start").alias("window_start"),
        exact_mean(F.col("_s"), F.col("_n")).alias("avg_speed_kmh"),
        "max_speed_kmh",
        "harsh_event_count",
    )


# ---------------------------------------------------------------------------
# Fleet sliding windows (pane rollup)
# ---------------------------------------------------------------------------


def _expand_panes(panes: DataFrame, width_s: int, slide_s: int) -> DataFrame:
    """Each pane [p, p+slide) lies in the windows starting at p - k*slide,
    k = 0 .. width/slide - 1."""
    k = width_s // slide_s
    return panes.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn(
        "window_start", F.timestamp_add("SECOND", -F.col("_k") * F.lit(slide_s), F.col("pane_start"))
    ).drop("_k", "pane_start")


def _check_grid(width: str, slide: str) -> tuple[int, int]:
    width_s, slide_s = interval_seconds(width), interval_seconds(slide)
    if width_s % slide_s != 0:
        raise ValueError(f"window {width} must be a multiple of slide {slide}")
    return width_s, slide_s


def _panes(u: DataFrame, slide: str) -> DataFrame:
    """Rows per (vehicle, pane): the only shuffle of rows."""
    return u.groupBy("vehicle_id", F.window("event_time", slide).alias("p")).agg(
        F.sum(centi()).alias("s"), F.count("speed_kmh").alias("n"), F.sum("harsh_flag").alias("h")
    ).select("vehicle_id", F.col("p.start").alias("pane_start"), "s", "n", "h")


# Windows per span in which a vehicle's panes are gathered, in window widths.
SPAN_WIDTHS = 12


def _active_vehicles(panes: DataFrame, width_s: int, slide_s: int) -> DataFrame:
    """``window_start, _active``: vehicles with a sample in each window.

    Pane p lies in windows p-K+1 .. p. Windows are cut into spans; a pane goes
    to the one or two spans its windows lie in, so what is shuffled is about
    the panes, not K times as many rows, and one (vehicle, span) holds a
    bounded number of them. Each group gives its distinct windows once, and
    these are counted before they are shuffled."""
    k = width_s // slide_s
    span = k * SPAN_WIDTHS
    dtype = panes.schema["pane_start"].dataType
    p = F.floor(F.unix_seconds(F.col("pane_start").cast("timestamp")) / slide_s).cast("long")
    d = panes.where("n > 0").select("vehicle_id", p.alias("p"))
    at = lambda w: F.floor(w / span).cast("long")
    d = d.select("vehicle_id", "p", F.explode(F.sequence(at(F.col("p") - (k - 1)), at(F.col("p")))).alias("b"))
    g = d.groupBy("vehicle_id", "b").agg(F.collect_set("p").alias("ps"))
    lo, hi = F.col("b") * span, F.col("b") * span + (span - 1)
    covered = F.flatten(F.transform("ps", lambda x: F.sequence(F.greatest(x - (k - 1), lo), F.least(x, hi))))
    w = g.select(F.explode(F.array_distinct(covered)).alias("w"))
    return w.groupBy("w").agg(F.count(F.lit(1)).alias("_active")).select(
        F.timestamp_seconds(F.col("w") * slide_s).cast(dtype).alias("window_start"), "_active"
    )


def _fleet_totals(panes: DataFrame, width_s: int, slide_s: int) -> DataFrame:
    """Sums per window: panes are summed over the fleet first, and only those
    few rows are expanded into the windows that hold them."""
    fleet = panes.groupBy("pane_start").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("h").alias("h"))
    return _expand_panes(fleet, width_s, slide_s).groupBy("window_start").agg(
        F.sum("s").alias("_s"), F.sum("n").alias("_n"), F.sum("h").cast("long").alias("total_harsh_events")
    )


def fleet_speed_windows(t: DataFrame, width: str = S.FLEET_WINDOW, slide: str = S.FLEET_SLIDE) -> DataFrame:
    """A4: sample-weighted fleet mean speed and vehicles with >= 1 sample."""
    width_s, slide_s = _check_grid(width, slide)
    panes = _panes(t.withColumn("harsh_flag", F.lit(None).cast("int")), slide)
    r = _fleet_totals(panes, width_s, slide_s).join(_active_vehicles(panes, width_s, slide_s), "window_start", "left")
    return r.select(
        "window_start",
        F.timestamp_add("SECOND", F.lit(width_s), F.col("window_start")).alias("window_end"),
        F.coalesce("_active", F.lit(0)).alias("vehicles_active"),
        exact_mean(F.col("_s"), F.col("_n")).alias("fleet_avg_speed_kmh"),
    )


def fleet_harsh_windows(ev: DataFrame, width: str = S.FLEET_WINDOW, slide: str = S.FLEET_SLIDE, harsh=S.HARSH_TYPES) -> DataFrame:
    """A5: harsh events per sliding window; windows without any event are absent."""
    width_s, slide_s = _check_grid(width, slide)
    panes = ev.groupBy(F.window("event_time", slide).alias("p")).agg(
        F.sum(F.when(is_harsh("event_type", harsh), 1).otherwise(0)).alias("h")
    ).select(F.col("p.start").alias("pane_start"), "h")
    r = _expand_panes(panes, width_s, slide_s).groupBy("window_start").agg(F.sum("h").cast("long").alias("total_harsh_events"))
    return r.select(
        "window_start",
        F.timestamp_add("SECOND", F.lit(width_s), F.col("window_start")).alias("window_end"),
        "total_harsh_events",
    )


def fleet_windows(t: DataFrame, ev: DataFrame, width: str = S.FLEET_WINDOW, slide: str = S.FLEET_SLIDE, harsh=S.HARSH_TYPES) -> DataFrame:
    """Combined fleet row with ``day_bucket``: union, panes, and two small
    tables per window joined."""
    width_s, slide_s = _check_grid(width, slide)
    panes = _panes(_union_signals(t, ev, harsh), slide)
    r = _fleet_totals(panes, width_s, slide_s).join(_active_vehicles(panes, width_s, slide_s), "window_start", "left")
    return r.select(
        F.to_date("window_start").alias("day_bucket"),
        "window_start",
        F.timestamp_add("SECOND", F.lit(width_s), F.col("window_start")).alias("window_end"),
        F.when(F.col("_n") > 0, F.col("_active")).alias("vehicles_active"),
        exact_mean(F.col("_s"), F.col("_n")).alias("fleet_avg_speed_kmh"),
        "total_harsh_events",
    )
