"""Message decoding and encoding (S2-S8, S16 payload, P7).

Messages are JSON text in a column (Kafka ``value`` bytes, a text file line,
or a string column). Decoding is one ``from_json`` with an explicit schema;
nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens import schemas as S

CORRUPT = "_corrupt_record"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_ts(col, ntz: bool = True) -> Column:
    """ISO-8601 text with an offset or ``Z`` -> UTC instant; malformed -> null.

    ``ntz=True`` returns UTC wall time as TIMESTAMP_NTZ (batch tables);
    ``ntz=False`` keeps TIMESTAMP, which ``withWatermark`` requires.
    """
    ts = F.try_to_timestamp(_c(col))
    return ts.cast("timestamp_ntz") if ntz else ts


def format_ts(col) -> Column:
    """UTC instant -> ISO-8601 text with microseconds and ``Z``."""
    return F.date_format(_c(col).cast("timestamp"), ISO_MICROS)


def clean_uuid(col) -> Column:
    """Optional UUID text; empty -> null, valid -> lower case, invalid -> null
    (pair with :func:`uuid_is_bad` to quarantine)."""
    c = F.trim(_c(col))
    return F.when(c.rlike(S.UUID_RE), F.lower(c))


def uuid_is_bad(col) -> Column:
    c = F.trim(_c(col))
    return c.isNotNull() & (c != "") & ~c.rlike(S.UUID_RE)


# What a message must have to be stored; a trip and a detail may be missing.
TELEMETRY_REQUIRED = tuple(f.name for f in S.TELEMETRY_WIRE.fields if f.name != "trip_id")
EVENT_REQUIRED = ("event_id", "vehicle_id", "ts", "event_type")
TELEMETRY_UUIDS = ("trip_id",)
EVENT_UUIDS = ("event_id", "trip_id")


def _parsed(col: str, names: Sequence[str]) -> Column:
    """The message as a struct of texts: numbers and booleans keep what the
    sender wrote, quoted or not, and are cast one by one afterwards."""
    fields = [T.StructField(n, T.StringType(), True) for n in [*names, CORRUPT]]
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(F.col(col).cast("string"), T.StructType(fields), opts)


def _typed(raw: Column, kind: T.DataType) -> Column:
    """Text to a wire type, null if it isn't one. Integers take any finite
    number and drop its fraction, as ``3.0`` for a gear."""
    if isinstance(kind, T.StringType):
        return raw
    if isinstance(kind, T.BooleanType):
        return raw.try_cast("boolean")
    number = raw.try_cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return finite.try_cast(kind) if isinstance(kind, T.IntegerType) else finite


def check_messages(df: DataFrame, col: str, wire: T.StructType, required: Sequence[str], uuids: Sequence[str],
                   ntz: bool = True, keep: Sequence[str] = (), message: Column | None = None) -> DataFrame:
    """Every message, parsed once: ``keep``, the decoded columns (``ts`` as
    ``event_time``, UUIDs in lower case), ``raw`` and ``reason``, which is null
    for good messages and else the first of ``malformed_json`` (no JSON
    object), ``missing_field`` (a required one), ``bad_value`` (not of its
    type) and ``bad_uuid``. ``message``: the parsed struct, if there is one."""
    p = df.select(*keep, F.col(col).cast("string").alias("raw"), (message if message is not None else _parsed(col, wire.fieldNames())).alias("m"))
    value: dict[str, Column] = {}
    missing, wrong, bad_id = F.lit(False), F.lit(False), F.lit(False)
    for f in wire.fields:
        raw = F.col(f"m.{f.name}")
        if f.name == "ts":
            value["event_time"] = v = parse_ts(raw, ntz)
        elif f.name in uuids:
            value[f.name] = v = clean_uuid(raw)
            bad_id = bad_id | uuid_is_bad(raw)
            if f.name in required:
                missing = missing | (F.coalesce(F.trim(raw), F.lit("")) == "")
            continue
        else:
            value[f.name] = v = _typed(raw, f.dataType)
        if f.name in required:
            missing = missing | raw.isNull()
        wrong = wrong | (raw.isNotNull() & v.isNull())
    broken = F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
    reason = F.when(broken, "malformed_json").when(missing, "missing_field").when(wrong, "bad_value").when(bad_id, "bad_uuid")
    return p.select(*keep, *[c.alias(n) for n, c in value.items()], "raw", reason.alias("reason"))


def check_telemetry(df: DataFrame, col: str = "value", ntz: bool = True, keep: Sequence[str] = (), message: Column | None = None) -> DataFrame:
    """S2 + S5 + S6 + S7: telemetry messages with their ``reason``."""
    c = check_messages(df, col, S.TELEMETRY_WIRE, TELEMETRY_REQUIRED, TELEMETRY_UUIDS, ntz, keep, message)
    return c.select(*keep, *S.TELEMETRY_COLUMNS, "raw", "reason")


def check_event(df: DataFrame, col: str = "value", ntz: bool = True, keep: Sequence[str] = (), message: Column | None = None) -> DataFrame:
    """S3 + S5 + S6: driving-event messages with their ``reason``."""
    c = check_messages(df, col, S.EVENT_WIRE, EVENT_REQUIRED, EVENT_UUIDS, ntz, keep, message)
    return c.select(*keep, *S.EVENT_COLUMNS, "raw", "reason")


def decode_telemetry(df: DataFrame, col: str = "value", ntz: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """S2 + S7: telemetry JSON -> typed columns, ``ts`` renamed ``event_time``;
    what cannot be decoded is null."""
    return check_telemetry(df, col, ntz, keep).select(*keep, *S.TELEMETRY_COLUMNS)


def decode_event(df: DataFrame, col: str = "value", ntz: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """S3: driving-event JSON -> typed columns."""
    return check_event(df, col, ntz, keep).select(*keep, *S.EVENT_COLUMNS)


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).drop("raw", "reason")


def bad_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select("raw", "reason")


def split_malformed(df: DataFrame, col: str = "value", check=check_telemetry, **how) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: decoded rows, and ``raw, reason`` of the messages
    that go to quarantine instead of failing the job."""
    c = check(df, col, **how)
    return good_rows(c), bad_rows(c)


def telemetry_json() -> Column:
    """JSON text of a telemetry row in wire form (``ts`` as ISO-8601 text)."""
    fields = [F.col(c) for c in S.TELEMETRY_COLUMNS if c != "event_time"]
    return F.to_json(F.struct(*fields[:2], format_ts("event_time").alias("ts"), *fields[2:]))


def encode_telemetry(t: DataFrame) -> DataFrame:
    """Telemetry rows -> JSON messages (``key`` = vehicle_id, ``value`` = JSON)."""
    return t.select(F.col("vehicle_id").alias("key"), telemetry_json().alias("value"))


def event_json() -> Column:
    """JSON text of a driving-event row in wire form."""
    return F.to_json(F.struct("event_id", "vehicle_id", "trip_id", format_ts("event_time").alias("ts"), "event_type", "detail"))


def encode_event(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("vehicle_id").alias("key"), event_json().alias("value"))


def tag_lines(t: DataFrame, ev: DataFrame) -> DataFrame:
    """S8 writer side: one JSON line per object with ``kind``."""
    a = encode_telemetry(t).select(F.concat(F.lit('{"kind":"telemetry",'), F.expr("substring(value, 2)")).alias("value"))
    b = encode_event(ev).select(F.concat(F.lit('{"kind":"event",'), F.expr("substring(value, 2)")).alias("value"))
    return a.unionByName(b)


def demux_tagged(lines: DataFrame, col: str = "value", ntz: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An interleaved tagged JSON-lines feed -> (telemetry, events,
    quarantine). Each line is parsed once, with the fields of both kinds; a
    line that is no JSON object, or of no known kind, is quarantined, too."""
    names = list(dict.fromkeys(["kind", *S.TELEMETRY_WIRE.fieldNames(), *S.EVENT_WIRE.fieldNames()]))
    p = lines.select(F.col(col).cast("string").alias("raw"), _parsed(col, names).alias("_line"))
    kind = F.col("_line.kind")
    broken = F.col("_line").isNull() | F.col(f"_line.{CORRUPT}").isNotNull()
    t = check_telemetry(p.where(kind == "telemetry"), "raw", ntz, message=F.col("_line"))
    ev = check_event(p.where(kind == "event"), "raw", ntz, message=F.col("_line"))
    other = p.where(~F.coalesce(kind.isin("telemetry", "event"), F.lit(False)))
    other = other.select("raw", F.when(broken, "malformed_json").otherwise("unknown_kind").alias("reason"))
    return good_rows(t), good_rows(ev), bad_rows(t).unionByName(bad_rows(ev)).unionByName(other)


def read_tagged_jsonl(spark: SparkSession, path: str, ntz: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read a tagged JSON-lines file (or folder)."""
    return demux_tagged(spark.read.text(path), "value", ntz)


def missing_fields(df: DataFrame, col: str, required) -> DataFrame:
    """Required keys absent from each JSON object (empty array = complete)."""
    keys = F.json_object_keys(F.col(col))
    req = F.array(*[F.lit(r) for r in required])
    return df.withColumn("missing_fields", F.array_except(req, F.coalesce(keys, F.array().cast("array<string>"))))
