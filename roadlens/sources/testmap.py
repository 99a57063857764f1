"""Views over the driver's ``events`` table in the engine's data model.

The driver's tables carry no vehicle telemetry, so both the Spark side and
the DuckDB oracle derive the same telemetry, driving-event and vehicle
views from ``events`` (one row per reading). Every expression here has a
twin in :mod:`roadlens.plans.oracle`; keep them in step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.signals import airflow_g_per_s, fuel_rate_lps, gear_from_speed, intake_temp_c
from roadlens.operators.ordered import DEFAULT_BUCKET_S, drop_bucket, with_buckets, with_previous, with_running
from roadlens.schemas import CITY_BOXES, DTC_CATALOG, ROAD_CLASS_LIMIT_KMH, TELEMETRY_COLUMNS

# Source event type -> driving-event type (fixed mapping of the test views).
EVENT_TYPE_MAP = {
    "click": "idling",
    "view": "ignition_on",
    "error": "harsh_braking",
    "purchase": "over_speed",
    "signup": "ignition_off",
}
IGNITION_OFF_SOURCE_TYPE = "signup"
DTC_SOURCE_TYPE = "error"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vehicle_id_of(user_id: str | Column = "user_id") -> Column:
    u = (F.col(user_id) if isinstance(user_id, str) else user_id).cast("string")
    return F.concat(F.lit("veh_"), F.lpad(u, F.greatest(F.lit(4), F.length(u)), F.lit("0")))


def uuid_of(text: Column) -> Column:
    """UUID text made of a text's md5."""
    h = F.md5(text.cast("binary"))
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _trip_id() -> Column:
    return F.when(
        F.col("event_type") != IGNITION_OFF_SOURCE_TYPE,
        uuid_of(F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))),
    )


def telemetry(spark: SparkSession, sf_dir: str, streaming_ts: bool = False, extra: bool = True, source: bool = False) -> DataFrame:
    """Telemetry view: one reading per ``events`` row.

    ``seq`` (the source ``event_id``) breaks ties in arrival order and
    ``arrival_time`` is the time the reading reached the pipeline.
    """
    cols = TELEMETRY_COLUMNS + (["seq", "arrival_time"] if extra else []) + (["source_type", "props"] if source else [])
    return telemetry_of(with_odometer(read_table(spark, sf_dir, "events")), streaming_ts).select(*cols)


def with_odometer(e: DataFrame, bucket_s: int = DEFAULT_BUCKET_S) -> DataFrame:
    """Rows of ``events`` with the user's running exact sum of speed readings:
    of a reading, only what the rest is made of goes through the shuffles."""
    e = e.select("event_id", "ts", "user_id", "event_type", "value", "props")
    speed = F.col("value").cast("decimal(18,2)")
    e = with_buckets(e, ["user_id"], "ts", bucket_s)
    return drop_bucket(with_running(e, ["user_id"], ["ts", "event_id"], speed, "odometer_dec", bucket_s=bucket_s), bucket_s)


def arrival_time() -> Column:
    """When the reading of an ``events`` row reached the pipeline."""
    return F.timestamp_add("SECOND", (F.col("event_id") % 7) * 30, F.col("ts")).alias("arrival_time")


def telemetry_of(e: DataFrame, streaming_ts: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Telemetry columns, row by row, of :func:`with_odometer`; ``keep`` stays."""
    eid = F.col("event_id")
    rpm = (F.lit(800) + (eid * 13) % 5700).cast("int")
    throttle = (eid % 101).cast("double")
    engine = (F.lit(60) + eid % 50).cast("double")
    ts = F.col("ts").cast("timestamp") if streaming_ts else F.col("ts")
    # Monotone counters: odometer = running exact sum of speed readings.
    km = F.col("odometer_dec").cast("double")
    return e.select(
        *keep,
        vehicle_id_of().alias("vehicle_id"),
        _trip_id().alias("trip_id"),
        ts.alias("event_time"),
        (F.lit(-6.3) + (eid % 1000).cast("double") / F.lit(5000.0)).alias("lat"),
        (F.lit(106.7) + (eid % 977).cast("double") / F.lit(4000.0)).alias("lon"),
        ((eid * 37) % 360).cast("double").alias("heading_deg"),
        F.col("value").alias("speed_kmh"),
        (F.lit(1) + eid % 5).cast("int").alias("gear"),
        rpm.alias("rpm"),
        throttle.alias("throttle_pct"),
        (rpm.cast("double") * throttle / F.lit(1000.0)).alias("maf_g_per_s"),
        engine.alias("engine_temp_c"),
        (engine - F.lit(5.0)).alias("coolant_temp_c"),
        (F.lit(30) + eid % 9).cast("double").alias("intake_air_temp_c"),
        F.least(F.col("value"), F.lit(100.0)).alias("fuel_pct"),
        (F.col("event_type") != IGNITION_OFF_SOURCE_TYPE).alias("ignition_on"),
        eid.alias("seq"),
        F.timestamp_add("SECOND", (eid % 7) * 30, ts).alias("arrival_time"),
        F.col("event_type").alias("source_type"),
        F.col("props"),
        km.alias("odometer_km"),
        (km / F.lit(12.5)).alias("fuel_consumed_l"),
    )


def telemetry_light(spark: SparkSession, sf_dir: str, streaming_ts: bool = False) -> DataFrame:
    """Telemetry view without the running counters (no window needed)."""
    return light_from(read_table(spark, sf_dir, "events"), streaming_ts)


def light_from(e: DataFrame, streaming_ts: bool = False) -> DataFrame:
    """Row-local telemetry mapping of an ``events`` DataFrame (batch or stream)."""
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp") if streaming_ts else F.col("ts")
    return e.select(
        vehicle_id_of().alias("vehicle_id"),
        _trip_id().alias("trip_id"),
        ts.alias("event_time"),
        (F.lit(-6.3) + (eid % 1000).cast("double") / F.lit(5000.0)).alias("lat"),
        (F.lit(106.7) + (eid % 977).cast("double") / F.lit(4000.0)).alias("lon"),
        ((eid * 37) % 360).cast("double").alias("heading_deg"),
        F.col("value").alias("speed_kmh"),
        (F.lit(60) + eid % 50).cast("double").alias("engine_temp_c"),
        F.least(F.col("value"), F.lit(100.0)).alias("fuel_pct"),
        (F.col("event_type") != IGNITION_OFF_SOURCE_TYPE).alias("ignition_on"),
        eid.alias("seq"),
        F.timestamp_add("SECOND", (eid % 7) * 30, ts).alias("arrival_time"),
    )


def _mapped_type() -> Column:
    expr = None
    for src, dst in EVENT_TYPE_MAP.items():
        expr = (F.when if expr is None else expr.when)(F.col("event_type") == src, F.lit(dst))
    return expr.otherwise(F.col("event_type"))


def _dtc_detail() -> Column:
    idx = F.col("event_id") % len(DTC_CATALOG)
    expr = None
    for i, (code, desc, _sev, _eng) in enumerate(DTC_CATALOG):
        expr = (F.when if expr is None else expr.when)(idx == i, F.lit(f"{code} {desc}"))
    return F.when(F.col("event_type") == DTC_SOURCE_TYPE, expr)


def driving_events(spark: SparkSession, sf_dir: str, streaming_ts: bool = False) -> DataFrame:
    """Driving-event view: every ``events`` row with its mapped event type."""
    return events_from(read_table(spark, sf_dir, "events"), streaming_ts)


def events_from(e: DataFrame, streaming_ts: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Driving-event mapping of an ``events`` DataFrame (batch or stream);
    ``keep`` stays."""
    ts = F.col("ts").cast("timestamp") if streaming_ts else F.col("ts")
    return e.select(
        *keep,
        uuid_of(F.col("event_id").cast("string")).alias("event_id"),
        vehicle_id_of().alias("vehicle_id"),
        _trip_id().alias("trip_id"),
        ts.alias("event_time"),
        _mapped_type().alias("event_type"),
        _dtc_detail().alias("detail"),
        F.col("event_id").alias("seq"),
        F.timestamp_add("SECOND", (F.col("event_id") % 7) * 30, ts).alias("arrival_time"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle dimension: one row per distinct source user."""
    u = read_table(spark, sf_dir, "events").select("user_id").distinct()
    even = (F.col("user_id") % 2) == 0
    persona = (
        F.when(F.col("user_id") % 3 == 0, F.lit("delivery_van"))
        .when(F.col("user_id") % 3 == 1, F.lit("city_commuter"))
        .otherwise(F.lit("long_haul"))
    )
    return u.select(
        vehicle_id_of().alias("vehicle_id"),
        F.concat(F.when(even, F.lit("B ")).otherwise(F.lit("D ")), F.col("user_id").cast("string"), F.lit(" FLT")).alias("plate_number"),
        F.when(even, F.lit("Toyota")).otherwise(F.lit("Mitsubishi")).alias("brand"),
        F.when(even, F.lit("Innova Reborn")).otherwise(F.lit("Xpander")).alias("model"),
        (F.lit(2018) + F.col("user_id") % 5).cast("int").alias("year"),
        persona.alias("persona"),
        F.when(even, F.lit("Pertamax 95")).otherwise(F.lit("Pertamax 92")).alias("fuel_type"),
        F.when(even, F.lit("jakarta")).otherwise(F.lit("bandung")).alias("fleet_group"),
        F.when(even, F.lit("Jakarta")).otherwise(F.lit("Bandung")).alias("home_city"),
        F.when(F.col("user_id") % 7 == 0, F.lit("diesel")).otherwise(F.lit("gasoline")).alias("engine_type"),
        F.when(even, F.lit(2.7)).otherwise(F.lit(1.5)).alias("displacement_l"),
        F.when(even, F.lit(55.0)).otherwise(F.lit(42.0)).alias("tank_l"),
        F.when(even, F.lit(31.0)).otherwise(F.lit(25.0)).alias("ambient_c"),
    )


# Source event types whose row is a telemetry reading / a driving event in the
# sparse views, where each side has windows that the other lacks.
SPARSE_TELEMETRY = ("click", "view", "signup")
SPARSE_EVENTS = ("error", "purchase", "click")


def sparse_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(telemetry, events) views in which a source row is a reading, an event,
    or both, by its type."""
    e = read_table(spark, sf_dir, "events")
    return light_from(e.where(F.col("event_type").isin(*SPARSE_TELEMETRY))), events_from(e.where(F.col("event_type").isin(*SPARSE_EVENTS)))


def road_nodes_from_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular road nodes, one per supplier, scattered over the city boxes."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("long")
    even = k % 2 == 0
    (a, b, c, d), (a2, b2, c2, d2) = CITY_BOXES["Jakarta"], CITY_BOXES["Bandung"]
    u = ((k * 7919) % 1009).cast("double") / F.lit(1009.0)
    v = ((k * 104729) % 997).cast("double") / F.lit(997.0)
    names = F.array(*[F.lit(x) for x in ROAD_CLASS_LIMIT_KMH])
    return s.select(
        F.concat(F.lit("route_"), F.col("s_nationkey").cast("string")).alias("route_id"),
        F.when(even, "Jakarta").otherwise("Bandung").alias("city"),
        k.alias("seq"),
        F.when(even, F.lit(a) + u * F.lit(b - a)).otherwise(F.lit(a2) + u * F.lit(b2 - a2)).alias("lat"),
        F.when(even, F.lit(c) + v * F.lit(d - c)).otherwise(F.lit(c2) + v * F.lit(d2 - c2)).alias("lon"),
        F.element_at(names, (k % len(ROAD_CLASS_LIMIT_KMH) + 1).cast("int")).alias("road_class"),
        F.when(k % 5 == 0, F.lit(30)).cast("int").alias("speed_limit_kmh"),
    )


# Source event types whose reading breaks one rule each in the ECU feed.
BROKEN_GEAR, BROKEN_MAF, BROKEN_INTAKE, BROKEN_FUEL = "error", "purchase", "signup", "view"


def ecu_feed(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    """Readings that follow the engine rules, rounded as on the wire; with
    ``broken``, readings of four source types break one rule each."""
    e = read_table(spark, sf_dir, "events")
    v = vehicles(spark, sf_dir)
    eid = F.col("event_id")
    kind = F.col("event_type")
    t = e.select(
        vehicle_id_of().alias("vehicle_id"), F.col("ts").alias("event_time"), eid.alias("seq"), F.col("value").alias("speed_kmh"), kind.alias("kind"),
        (F.lit(800) + (eid * 13) % 5700).cast("int").alias("rpm"),
        (((eid * 7919) % 100003).cast("double") / F.lit(1000.03)).alias("throttle"),
    ).join(v.select("vehicle_id", "displacement_l", "ambient_c", "fuel_type"), "vehicle_id")
    maf = airflow_g_per_s("displacement_l", throttle_pct="throttle")
    t = with_previous(t.withColumn("maf", maf), ["vehicle_id"], ["event_time", "seq"], ["event_time"])
    dt = (F.unix_micros(F.col("event_time").cast("timestamp")) - F.unix_micros(F.col("prev_event_time").cast("timestamp"))).cast("double") / F.lit(1000000.0)
    step = F.coalesce(fuel_rate_lps(F.col("maf")) * dt, F.lit(0.0))
    t = t.withColumn("step", F.round(step, 9).cast("decimal(28,9)"))
    t = with_running(t, ["vehicle_id"], ["event_time", "seq"], F.col("step"), "used")

    def wrong(x: str) -> Column:
        return F.when(F.col("kind") == x, F.lit(1.0)).otherwise(F.lit(0.0)) if broken else F.lit(0.0)

    return t.select(
        "vehicle_id", "event_time", "seq", "speed_kmh", "rpm",
        (gear_from_speed() + wrong(BROKEN_GEAR).cast("int")).alias("gear"),
        F.round("throttle", 2).alias("throttle_pct"),
        F.round(F.col("maf") + wrong(BROKEN_MAF), 3).alias("maf_g_per_s"),
        F.round(intake_temp_c("ambient_c") + wrong(BROKEN_INTAKE), 2).alias("intake_air_temp_c"),
        F.round(F.col("used").cast("double") + wrong(BROKEN_FUEL) * F.lit(50.0), 4).alias("fuel_consumed_l"),
    )
