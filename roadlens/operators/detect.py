"""Threshold event detection on telemetry.

Per row, the rule inputs are built from row-to-row signals (W3-W5); each
rule is edge-triggered (an event is emitted only on the row where its
condition becomes true). Fuel-low fires once per trip, on the trip's first
reading below the threshold. The fault-code rule is a generator draw with no
telemetry input and is covered by the event table (see ``enrich_dtc``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.geo import kmh_to_mps
from roadlens.operators.motion import (
    KEY,
    ORDER,
    add_sustained_seconds,
    heading_columns,
    heading_running,
    sustained_column,
    seconds_between,
    sustained_running,
)
from roadlens.operators.ordered import DEFAULT_BUCKET_S, bucket_col, changed_rows, drop_bucket, scan

# Edge-triggered rules, in output order: event type -> condition column.
RULES = ("harsh_accel", "harsh_braking", "harsh_cornering", "over_speed", "idling")


def _limit(limit_kmh) -> Column:
    if isinstance(limit_kmh, str):
        return F.col(limit_kmh).cast("double")
    if isinstance(limit_kmh, Column):
        return limit_kmh.cast("double")
    return F.lit(float(limit_kmh))


def rule_conditions(
    t: DataFrame, limit_kmh="speed_limit_kmh", bucket_s: int = DEFAULT_BUCKET_S, keep_bucket: bool = False
) -> DataFrame:
    """Add one boolean column per rule (``c_<event_type>``), never null.

    One ordered pass: the previous speed and time (acceleration), the
    running last-moving heading and the two sustained clocks are all
    computed together (their inputs are row-local).
    """
    lim = _limit(limit_kmh)
    over_cond = F.col("speed_kmh") > lim + F.lit(S.OVER_SPEED_MARGIN_KMH)
    idle_cond = F.col("ignition_on") & (kmh_to_mps("speed_kmh") < F.lit(S.IDLE_SPEED_MPS))
    running = {**heading_running(), **sustained_running(over_cond, "overspeed_s"), **sustained_running(idle_cond, "idle_s")}
    d = scan(t, KEY, ORDER, prev=["speed_kmh", "event_time"], running=running, bucket_s=bucket_s, keep_bucket=keep_bucket)
    dt = seconds_between("event_time", "prev_event_time")
    d = d.select(
        "*",
        F.when(dt > 0, kmh_to_mps(F.col("speed_kmh") - F.col("prev_speed_kmh")) / dt).alias("accel_mps2"),
        *heading_columns(),
        sustained_column(over_cond, "overspeed_s").alias("overspeed_s"),
        sustained_column(idle_cond, "idle_s").alias("idle_s"),
    ).drop(*running.keys(), "prev_speed_kmh", "prev_event_time")
    cond = {
        "harsh_accel": F.col("accel_mps2") > F.lit(S.HARSH_ACCEL_MPS2),
        "harsh_braking": F.col("accel_mps2") < F.lit(S.HARSH_BRAKE_MPS2),
        "harsh_cornering": F.col("heading_delta_deg").isNotNull()
        & (F.col("speed_kmh") > F.lit(S.HARSH_CORNER_SPEED_KMH))
        & (F.abs(F.col("heading_delta_deg")) > F.lit(S.HARSH_CORNER_HEADING_DEG)),
        "over_speed": (F.col("speed_kmh") >= lim + F.lit(S.OVER_SPEED_MARGIN_KMH))
        & (F.col("overspeed_s") >= F.lit(S.OVER_SPEED_SUSTAINED_S)),
        "idling": F.col("idle_s") >= F.lit(S.IDLING_THRESHOLD_S),
    }
    return d.select("*", *[F.coalesce(cond[name], F.lit(False)).alias(f"c_{name}") for name in RULES])


def condition_set(prefix: str = "c_") -> Column:
    """Active rule names of a row as an array (fixed rule order)."""
    return F.filter(F.array(*[F.when(F.col(prefix + r), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())


def fuel_low_events(t: DataFrame, threshold: float = S.FUEL_LOW_PCT) -> DataFrame:
    """First reading of each trip below ``threshold`` percent fuel."""
    low = t.where((F.col("fuel_pct") < F.lit(threshold)) & F.col("trip_id").isNotNull())
    g = low.groupBy("vehicle_id", "trip_id").agg(F.min("event_time").alias("event_time"))
    return g.select("vehicle_id", "trip_id", "event_time", F.lit("fuel_low").alias("event_type"))


def detect_events(t: DataFrame, limit_kmh="speed_limit_kmh", bucket_s: int = DEFAULT_BUCKET_S, checkpoint: bool = True) -> DataFrame:
    """T10 (batch): driving events derived from telemetry.

    Output: vehicle_id, trip_id, event_time, event_type. The rule pass and
    the edge test share one shuffle of the rows: only rows whose rule set
    changes (plus two per time bucket) leave the row stage
    (:func:`changed_rows`); ``checkpoint`` materialises that small table in
    the shared checkpoint folder.
    """
    d = rule_conditions(t, limit_kmh, bucket_s, keep_bucket=True)
    d = d.select("vehicle_id", "trip_id", *ORDER, bucket_col(bucket_s), *[f"c_{r}" for r in RULES])
    d = drop_bucket(changed_rows(d, KEY, ORDER, [f"c_{r}" for r in RULES], bucket_s=bucket_s, checkpoint=checkpoint), bucket_s)
    edges = F.array(
        *[
            F.when(F.col(f"c_{r}") & ~F.coalesce(F.col(f"prev_c_{r}"), F.lit(False)), F.lit(r))
            for r in RULES
        ]
    )
    ev = d.select("vehicle_id", "trip_id", "event_time", F.explode(edges).alias("event_type")).where(
        F.col("event_type").isNotNull()
    )
    return ev.unionByName(fuel_low_events(t))


def condition_changes(t: DataFrame, limit_kmh="speed_limit_kmh", bucket_s: int = DEFAULT_BUCKET_S, checkpoint: bool = True) -> DataFrame:
    """Per row, rules that became active and rules that stopped, as
    comma-separated lists; only rows with a change are returned."""
    d = rule_conditions(t, limit_kmh, bucket_s, keep_bucket=True)
    d = d.select("vehicle_id", *ORDER, bucket_col(bucket_s), *[f"c_{r}" for r in RULES])
    d = drop_bucket(changed_rows(d, KEY, ORDER, [f"c_{r}" for r in RULES], bucket_s=bucket_s, checkpoint=checkpoint), bucket_s)
    cur, prev = condition_set("c_"), condition_set("prev_c_")
    d = d.select("vehicle_id", "event_time", F.array_except(cur, prev).alias("_new"), F.array_except(prev, cur).alias("_gone"))
    d = d.where((F.size("_new") > 0) | (F.size("_gone") > 0))
    return d.select(
        "vehicle_id",
        "event_time",
        F.array_join("_new", ",").alias("newly_active"),
        F.array_join("_gone", ",").alias("declined"),
    )


def ignition_events(t: DataFrame, bucket_s: int = DEFAULT_BUCKET_S, checkpoint: bool = True) -> DataFrame:
    """ignition_on / ignition_off events where the ignition flips.

    A vehicle's first row counts as a flip from off.
    """
    d = changed_rows(t.select(*KEY, *ORDER, "ignition_on"), KEY, ORDER, ["ignition_on"], bucket_s=bucket_s, checkpoint=checkpoint)
    prev = F.coalesce(F.col("prev_ignition_on"), F.lit(False))
    kind = F.when(F.col("ignition_on") & ~prev, F.lit("ignition_on")).when(~F.col("ignition_on") & prev, F.lit("ignition_off"))
    return d.select("vehicle_id", "event_time", kind.alias("event_type")).where(F.col("event_type").isNotNull())


def temp_alerts(
    t: DataFrame, limit_c: float = 100.0, sustain_s: float = 30.0, bucket_s: int = DEFAULT_BUCKET_S, checkpoint: bool = True
) -> DataFrame:
    """Engine-temperature alert when the temperature has stayed above
    ``limit_c`` for at least ``sustain_s`` seconds (edge-triggered)."""
    d = add_sustained_seconds(t, F.col("engine_temp_c") > F.lit(limit_c), "hot_s", bucket_s=bucket_s, keep_bucket=True)
    d = d.withColumn("_hot", F.coalesce(F.col("hot_s") >= F.lit(sustain_s), F.lit(False)))
    d = d.select("vehicle_id", *ORDER, bucket_col(bucket_s), "engine_temp_c", "hot_s", "_hot")
    d = drop_bucket(changed_rows(d, KEY, ORDER, ["_hot"], bucket_s=bucket_s, checkpoint=checkpoint), bucket_s)
    alert = F.col("_hot") & ~F.coalesce(F.col("prev__hot"), F.lit(False))
    return d.where(alert).select("vehicle_id", "event_time", "engine_temp_c", "hot_s")
