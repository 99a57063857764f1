"""Wire schemas, enums and default parameters.

Every window length, hold, gap and threshold used by the operators is a
keyword argument whose default is defined here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------

# Driving-event types, in declaration order.
EVENT_TYPES = (
    "harsh_braking",
    "harsh_accel",
    "harsh_cornering",
    "over_speed",
    "idling",
    "fuel_low",
    "dtc_code",
    "ignition_on",
    "ignition_off",
)
# Event types counted as "harsh" in the rollups.
HARSH_TYPES = ("harsh_braking", "harsh_accel", "harsh_cornering", "over_speed")

# Event-rule thresholds.
HARSH_ACCEL_MPS2 = 2.5
HARSH_BRAKE_MPS2 = -2.5
OVER_SPEED_MARGIN_KMH = 10.0
OVER_SPEED_SUSTAINED_S = 3.0
HARSH_CORNER_SPEED_KMH = 40.0
HARSH_CORNER_HEADING_DEG = 25.0
IDLING_THRESHOLD_S = 120.0
IDLE_SPEED_MPS = 0.5
HEADING_MIN_SPEED_MPS = 0.6
FUEL_LOW_PCT = 10.0
REFUEL_BELOW_PCT = 30.0

# Windowing.
VEHICLE_WINDOW = "60 seconds"
LATE_HOLD = "75 seconds"
FLEET_WINDOW = "300 seconds"
FLEET_SLIDE = "30 seconds"
SESSION_GAP_S = 300
FRESHNESS_MAX_AGE_S = 15
LIVE_POINTS = 240

# Earth radius.
EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_M = 6_371_000.0

# Gear speed bands (km/h): gear 1 below 20, 2 below 40, 3 below 60, 4 below 80, else 5.
GEAR_BANDS_KMH = (20.0, 40.0, 60.0, 80.0)
IDLE_RPM = 800
# Fuel-rate constants: stoichiometric air/fuel ratio, fuel density g/L, idle floor L/s.
AIR_FUEL_RATIO = 14.7
FUEL_DENSITY_G_PER_L = 740.0
IDLE_FUEL_FLOOR_LPS = 0.0002
FUEL_TYPE_FACTOR = {"Pertamax 92": 1.00, "Pertamax 95": 0.97}
# Mass air flow: air density (g/L) and fill factor.
AIR_DENSITY_G_PER_L = 1.2
MAF_FILL_FACTOR = 0.5
# Intake air: ambient + min(8, rpm / 800).
INTAKE_RPM_DIVISOR = 800.0
INTAKE_MAX_RISE_C = 8.0

# Rush hours in local time (Asia/Jakarta, WIB), [start, end) hours, and factors.
LOCAL_TZ = "Asia/Jakarta"
RUSH_HOURS = ((7, 9), (17, 19))
RUSH_FACTOR = 0.6
NON_RUSH_FACTOR = 0.95

# Posted speed limit by road class (km/h).
ROAD_CLASS_LIMIT_KMH = {"toll": 100, "arterial": 60, "local": 40, "residential": 20}

# City bounding boxes: city -> (lat_min, lat_max, lon_min, lon_max).
CITY_BOXES = {
    "Jakarta": (-6.30, -6.10, 106.70, 106.95),
    "Bandung": (-7.00, -6.85, 107.55, 107.70),
}

# Fault-code catalog: code, description, severity, eligible engine types.
DTC_CATALOG = (
    ("P0171", "System Too Lean (Bank 1)", "med", ("gasoline",)),
    ("P0301", "Cylinder 1 Misfire Detected", "high", ("gasoline",)),
    ("P0420", "Catalyst System Efficiency Below Threshold", "med", ("gasoline",)),
    ("P0128", "Coolant Thermostat Below Regulating Temp", "low", ("gasoline", "diesel")),
    ("P0455", "EVAP System Leak Detected (large)", "low", ("gasoline",)),
    ("P2002", "DPF Efficiency Below Threshold", "med", ("diesel",)),
)

# Latest-state key prefix and snapshot message type.
LATEST_KEY_PREFIX = "vehicle:latest:"
SNAPSHOT_TYPE = "snapshot"

# Required payload fields.
LATEST_FIELDS = ("vehicle_id", "lat", "lon", "speed_kmh", "engine_temp_c", "updated_at")

# UUID text form.
UUID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

# Wire rounding (decimal places) per telemetry field.
QUANTIZE_DP = {
    "lat": 6,
    "lon": 6,
    "heading_deg": 1,
    "speed_kmh": 2,
    "throttle_pct": 2,
    "maf_g_per_s": 3,
    "engine_temp_c": 2,
    "coolant_temp_c": 2,
    "intake_air_temp_c": 2,
    "fuel_pct": 3,
    "fuel_consumed_l": 4,
    "odometer_km": 4,
}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

TELEMETRY_FIELDS = [
    T.StructField("vehicle_id", T.StringType(), False),
    T.StructField("trip_id", T.StringType(), True),
    T.StructField("ts", T.StringType(), False),
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lon", T.DoubleType(), False),
    T.StructField("heading_deg", T.DoubleType(), False),
    T.StructField("speed_kmh", T.DoubleType(), False),
    T.StructField("gear", T.IntegerType(), False),
    T.StructField("rpm", T.IntegerType(), False),
    T.StructField("throttle_pct", T.DoubleType(), False),
    T.StructField("maf_g_per_s", T.DoubleType(), False),
    T.StructField("engine_temp_c", T.DoubleType(), False),
    T.StructField("coolant_temp_c", T.DoubleType(), False),
    T.StructField("intake_air_temp_c", T.DoubleType(), False),
    T.StructField("fuel_pct", T.DoubleType(), False),
    T.StructField("fuel_consumed_l", T.DoubleType(), False),
    T.StructField("odometer_km", T.DoubleType(), False),
    T.StructField("ignition_on", T.BooleanType(), False),
]
# Wire schema of one telemetry JSON message ("ts" is ISO-8601 text).
TELEMETRY_WIRE = T.StructType(TELEMETRY_FIELDS)

EVENT_WIRE = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("vehicle_id", T.StringType(), False),
        T.StructField("trip_id", T.StringType(), True),
        T.StructField("ts", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("detail", T.StringType(), True),
    ]
)

# Telemetry columns after decoding (ts renamed to event_time).
TELEMETRY_COLUMNS = [
    "vehicle_id",
    "trip_id",
    "event_time",
    "lat",
    "lon",
    "heading_deg",
    "speed_kmh",
    "gear",
    "rpm",
    "throttle_pct",
    "maf_g_per_s",
    "engine_temp_c",
    "coolant_temp_c",
    "intake_air_temp_c",
    "fuel_pct",
    "fuel_consumed_l",
    "odometer_km",
    "ignition_on",
]
EVENT_COLUMNS = ["event_id", "vehicle_id", "trip_id", "event_time", "event_type", "detail"]

VEHICLE_SCHEMA = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType(), False),
        T.StructField("plate_number", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("model", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("persona", T.StringType(), True),
        T.StructField("fuel_type", T.StringType(), True),
        T.StructField("fleet_group", T.StringType(), True),
        T.StructField("home_city", T.StringType(), True),
        T.StructField("engine_type", T.StringType(), True),
        T.StructField("displacement_l", T.DoubleType(), True),
        T.StructField("tank_l", T.DoubleType(), True),
        T.StructField("ambient_c", T.DoubleType(), True),
    ]
)
