"""Trip sessions (A7, A8, T4 batch, J6).

Gaps-and-islands: a row starts a session when it is the vehicle's first
row, follows a gap longer than ``gap_s``, or follows an ignition-off row
(when ``on_ignition``).

:func:`trip_sessions` shuffles the rows once. Inside each (vehicle, time
bucket) one sorted window finds the starts it can see (every row but the
bucket's first) and cuts the bucket into fragments, which are aggregated
in place (the rows are already partitioned by vehicle and bucket). The
cross-bucket step works on one summary row per (vehicle, bucket): the
bucket's first fragment continues the previous bucket's last one unless the
gap or ignition rule starts a new session there, and a running count of
starts over earlier buckets numbers the sessions. A vehicle with a third of
all rows is spread over its buckets in the row stage; its cross-bucket
window holds one row per bucket (bounded by its time span, not its rows).

The fragment table is materialised once (reliable checkpoint in the shared
folder) because it is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens import schemas as S
from roadlens.functions.geo import haversine_km
from roadlens.functions.signals import is_harsh
from roadlens.operators.motion import KEY, ORDER, exact_km, seconds_between
from roadlens.operators.ordered import (
    DEFAULT_BUCKET_S,
    bucket_col,
    drop_bucket,
    order_key,
    time_bucket_id,
)


def session_fragments(
    t: DataFrame, gap_s: float = S.SESSION_GAP_S, on_ignition: bool = True, bucket_s: int = DEFAULT_BUCKET_S
) -> DataFrame:
    """Row stage of :func:`trip_sessions`: per (vehicle, bucket), the runs
    of rows between the session starts visible inside the bucket.

    ``_local`` numbers the fragments of a bucket (0 = the one holding the
    bucket's first row); ``dist`` sums the exact steps inside the fragment.
    The first/last row values let the next step join fragments across
    bucket boundaries."""
    B = bucket_col(bucket_s)
    d = t.withColumn(B, time_bucket_id("event_time", bucket_s))
    w = Window.partitionBy(*KEY, B).orderBy(*ORDER)
    d = d.select("*", *[F.lag(c).over(w).alias(f"_p_{c}") for c in ("event_time", "lat", "lon", "ignition_on")])
    start = seconds_between("event_time", "_p_event_time") > F.lit(float(gap_s))
    if on_ignition:
        start = start | ~F.col("_p_ignition_on")
    start = F.col("_p_event_time").isNotNull() & start
    step = F.when(F.col("_p_event_time").isNull() | start, F.lit(0).cast("decimal(18,6)")).otherwise(
        exact_km(haversine_km("_p_lat", "_p_lon", "lat", "lon"))
    )
    d = d.select(*KEY, B, *ORDER, "lat", "lon", "ignition_on", "speed_kmh", start.alias("_start"), step.alias("_step"))
    d = d.withColumn("_local", F.sum(F.col("_start").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    d = d.withColumn("_ok", order_key(d, ORDER))
    # Grouping keys extend the (vehicle, bucket) partitioning: aggregated in place.
    return d.groupBy(*KEY, B, "_local").agg(
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.min_by("seq", "_ok").alias("f_seq"),
        F.min_by("lat", "_ok").alias("f_lat"),
        F.min_by("lon", "_ok").alias("f_lon"),
        F.min_by("ignition_on", "_ok").alias("f_ign"),
        F.max_by("lat", "_ok").alias("l_lat"),
        F.max_by("lon", "_ok").alias("l_lon"),
        F.max_by("ignition_on", "_ok").alias("l_ign"),
        F.sum("_step").alias("dist"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.count(F.lit(1)).alias("samples"),
    )


def trip_sessions(
    t: DataFrame,
    gap_s: float = S.SESSION_GAP_S,
    on_ignition: bool = True,
    keep_idle: bool = False,
    bucket_s: int = DEFAULT_BUCKET_S,
    checkpoint: bool = True,
) -> DataFrame:
    """One row per trip session.

    Columns: vehicle_id, start_time, end_time, duration_min, distance_km,
    max_speed_kmh, samples, is_open. A session whose first row has the
    ignition off (a parked tick) is dropped unless ``keep_idle``. The last
    session of a vehicle is open when its last row still has the ignition on
    (or always, when sessions close on gaps only). ``t`` needs ``seq`` (a
    tiebreak after ``event_time``).

    The fragments are read twice (per-bucket summary, and the fragments
    themselves). With ``checkpoint=True`` (default) they are written once
    to the shared checkpoint folder (about one row per session and bucket),
    so the rows are read and shuffled once; the checkpoint keeps their
    (vehicle, bucket) partitioning, so the bucket summary needs no exchange.
    With ``checkpoint=False`` nothing is written and Spark recomputes the
    row stage for the second read.
    """
    frag = session_fragments(t, gap_s, on_ignition, bucket_s)
    if checkpoint:
        from roadlens.session import cut_lineage

        frag = cut_lineage(frag)
    B = bucket_col(bucket_s)
    # Per bucket (aggregated in place): its first fragment's first row, its
    # last fragment's last row, and the number of starts seen inside it.
    fk = order_key(frag, ["start_time", "f_seq"])
    bk = frag.withColumn("_fk", fk).groupBy(*KEY, B).agg(
        F.min("start_time").alias("b_first"),
        F.min_by("f_lat", "_fk").alias("b_lat0"),
        F.min_by("f_lon", "_fk").alias("b_lon0"),
        F.max("end_time").alias("b_last"),
        F.max_by("l_lat", "_fk").alias("b_lat1"),
        F.max_by("l_lon", "_fk").alias("b_lon1"),
        F.max_by("l_ign", "_fk").alias("b_ign1"),
        F.max("_local").alias("b_inner"),
    )
    # Across buckets (one row per non-empty bucket of a vehicle): does the
    # bucket's first fragment start a session, the step over the boundary,
    # and the starts in all earlier buckets.
    wb = Window.partitionBy(*KEY).orderBy(B)
    p_last, p_lat, p_lon, p_ign = (F.lag(c).over(wb) for c in ("b_last", "b_lat1", "b_lon1", "b_ign1"))
    head = p_last.isNull() | (seconds_between("b_first", p_last) > F.lit(float(gap_s)))
    if on_ignition:
        head = head | ~p_ign
    bk = bk.select(*KEY, B, "b_inner", head.alias("head_start"), p_lat.alias("p_lat"), p_lon.alias("p_lon"), "b_lat0", "b_lon0",
                   F.max("b_last").over(Window.partitionBy(*KEY)).alias("_vehicle_last"))
    starts = F.col("b_inner") + F.col("head_start").cast("long")
    bk = bk.select(
        *KEY,
        B,
        "head_start",
        "_vehicle_last",
        F.coalesce(F.sum(starts).over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("starts_before"),
        F.when(F.col("head_start"), F.lit(0).cast("decimal(18,6)"))
        .otherwise(exact_km(haversine_km("p_lat", "p_lon", "b_lat0", "b_lon0")))
        .alias("boundary_km"),
    )
    f = frag.join(bk, [*KEY, B], "left")
    head_frag = F.col("_local") == 0
    f = f.select(
        "*",
        (F.col("starts_before") + F.col("head_start").cast("long") + F.col("_local")).alias("session_no"),
        (~head_frag | F.col("head_start")).alias("is_start"),
    )
    f = f.withColumn("dist", F.col("dist") + F.when(head_frag, F.col("boundary_km")).otherwise(F.lit(0).cast("decimal(18,6)")))
    f = f.withColumn("_fk", order_key(f, ["start_time", "f_seq"]))
    g = f.groupBy("vehicle_id", "session_no").agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("dist").alias("_dist"),
        F.max("max_speed_kmh").alias("max_speed_kmh"),
        F.sum("samples").alias("samples"),
        F.max(F.when(F.col("is_start"), F.col("f_ign"))).alias("_first_ign"),
        F.max_by("l_ign", "_fk").alias("_last_ign"),
        F.max("_vehicle_last").alias("_vehicle_last"),
    )
    if not keep_idle:
        g = g.where(F.col("_first_ign"))
    open_ = F.col("end_time") == F.col("_vehicle_last")
    if on_ignition:
        open_ = open_ & F.col("_last_ign")
    return g.select(
        "vehicle_id",
        "start_time",
        "end_time",
        (seconds_between("end_time", "start_time") / F.lit(60.0)).alias("duration_min"),
        F.col("_dist").cast("double").alias("distance_km"),
        "max_speed_kmh",
        "samples",
        open_.alias("is_open"),
    )


def trips_by_id(t: DataFrame) -> DataFrame:
    """Trip record per (vehicle_id, trip_id): first/last time and position,
    distance = odometer end - start (4 dp).

    Ordered by (event time, sequence) packed into one fixed-width value, so
    Spark hash-aggregates map-side instead of sorting and every end of a trip
    comes from one reading.
    """
    o = F.col("_o")
    d = t.withColumn("_o", order_key(t, [c for c in ("event_time", "seq") if c in t.columns]))
    g = d.where(F.col("trip_id").isNotNull()).groupBy("vehicle_id", "trip_id").agg(
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.min_by("lat", o).alias("start_lat"),
        F.min_by("lon", o).alias("start_lon"),
        F.max_by("lat", o).alias("end_lat"),
        F.max_by("lon", o).alias("end_lon"),
        F.min_by("odometer_km", o).alias("_odo0"),
        F.max_by("odometer_km", o).alias("_odo1"),
        F.count(F.lit(1)).alias("samples"),
    )
    return g.withColumn("distance_km", F.round(F.col("_odo1") - F.col("_odo0"), 4)).drop("_odo0", "_odo1")


def trip_safety(trips: DataFrame, ev: DataFrame, harsh=S.HARSH_TYPES) -> DataFrame:
    """Trips joined with their pre-aggregated event counts."""
    counts = ev.where(F.col("trip_id").isNotNull()).groupBy("vehicle_id", "trip_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.when(is_harsh("event_type", harsh), 1).otherwise(0)).cast("long").alias("harsh_events"),
    )
    j = trips.join(counts, ["vehicle_id", "trip_id"], "left")
    harsh_n = F.coalesce(F.col("harsh_events"), F.lit(0).cast("long"))
    return j.select(
        "vehicle_id",
        "trip_id",
        "start_time",
        "end_time",
        "distance_km",
        F.coalesce(F.col("event_count"), F.lit(0).cast("long")).alias("event_count"),
        harsh_n.alias("harsh_events"),
        F.when(F.col("distance_km") > 0, harsh_n.cast("double") * F.lit(100.0) / F.col("distance_km")).alias("harsh_per_100km"),
    )
