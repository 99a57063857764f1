"""Keyed history tables and sinks (S9-S14), stored as :mod:`tables`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.sources.tables import KeyedTable, last_write, replace_rows, set_columns


def dedup_latest(df: DataFrame, keys: list[str], order: Sequence[str] = ("arrival_time", "seq")) -> DataFrame:
    """S9/S10 (batch): one row per key, the last by ``order`` wins (columns
    that the table lacks are left out; ties are decided by all other columns).

    ``row_number() = 1`` becomes a group limit before the shuffle: each task
    sends one row per key, so a key with very many copies never lands whole
    in one task, and no row is sorted more than once per side.
    """
    named = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in named]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*named, *rest]])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def history_rows(df: DataFrame, ts: str = "event_time", detail_default: bool = False) -> DataFrame:
    """Add the ``day`` column (and S10's ``detail`` default)."""
    out = df.withColumn("day", F.to_date(ts))
    if detail_default and "detail" in df.columns:
        out = out.withColumn("detail", F.coalesce(F.col("detail"), F.lit("")))
    return out


def history_table(spark: SparkSession, path: str, keys: Sequence[str] = ("vehicle_id", "event_time"), ts: str = "event_time") -> KeyedTable:
    """A history table by day, files sorted by its keys."""
    return KeyedTable(spark, path, F.to_date(ts), list(keys))


def write_history(df: DataFrame, path: str, keys: Sequence[str] = ("vehicle_id", "event_time"),
                  order: Sequence[str] = ("arrival_time", "seq"), version: int | None = None) -> int:
    """Append rows to a history table. One row per key is read back,
    the last written by ``order``; rows of other keys are kept, nothing stored
    is written again but by a compaction, and a replayed ``version`` changes
    nothing. Event rows get S10's empty detail."""
    rows = history_rows(df, detail_default=True).drop("day")
    named = [c for c in order if c in df.columns]
    return history_table(df.sparkSession, path, keys).commit_and_compact(rows, last_write(keys, named), version)


def read_history(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame | None:
    return KeyedTable(spark, path, F.lit(None)).read(days)


def write_fleet_windows(df: DataFrame, path: str, version: int | None = None) -> int:
    """Fleet rows by ``day_bucket``, one per window, later rows replacing
    earlier ones of the same window."""
    t = KeyedTable(df.sparkSession, path, F.col("day_bucket"), ["window_start"])
    return t.commit_and_compact(df, replace_rows(["window_start"]), version)


def write_columns(df: DataFrame, path: str, keys: Sequence[str], cols: Sequence[str], ts: str = "window_start", version: int | None = None) -> int:
    """Set some columns of the stored rows of ``df``'s keys."""
    t = KeyedTable(df.sparkSession, path, F.to_date(ts), list(keys))
    return t.commit_and_compact(df, set_columns(keys, cols), version)


def upsert_columns(target: DataFrame, updates: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Set ``cols`` from ``updates`` on matching keys (insert when new),
    keep every other column of ``target``. A full outer join on the keys."""
    u = updates.select(*keys, *cols, F.lit(True).alias("_u"))
    t = target.select(*keys, *[c for c in target.columns if c not in keys], F.lit(True).alias("_t"))
    j = t.alias("t").join(u.alias("u"), keys, "full")
    out = [*keys]
    for c in target.columns:
        if c in keys:
            continue
        if c in cols:
            out.append(F.when(F.col("u._u"), F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    for c in cols:
        if c not in target.columns:
            out.append(F.col(f"u.{c}").alias(c))
    return j.select(*out)


def latest_table(spark: SparkSession, path: str, shards: int = 64) -> KeyedTable:
    """Latest state, one row per vehicle, appended batch by batch. Rows
    are dealt over a fixed number of shards, the units of a compaction."""
    return KeyedTable(spark, path, F.pmod(F.xxhash64("vehicle_id"), F.lit(shards)), ["vehicle_id"])


def keyed_merge_writer(keys: list[str], ts: str = "window_start"):
    """T3/T8 sink for ``update`` mode: each micro-batch carries the changed
    rows only; they replace the stored rows of their keys, in the days that
    the batch touches. A replayed epoch finds its commit and does nothing."""

    def write(batch: DataFrame, epoch: int, out: str) -> None:
        KeyedTable(batch.sparkSession, out, F.to_date(ts), keys).commit_and_compact(batch, replace_rows(keys), epoch)

    return write


def load_vehicles(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """The vehicle reference table (explicit schema, no inference)."""
    from roadlens.schemas import VEHICLE_SCHEMA

    reader = spark.read.schema(VEHICLE_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def to_storage(t: DataFrame) -> DataFrame:
    """Cast to the storage column types (single-precision measurements,
    int gear/rpm, boolean ignition)."""
    floats = {
        "speed_kmh", "throttle_pct", "maf_g_per_s", "engine_temp_c", "coolant_temp_c", "intake_air_temp_c",
        "fuel_pct", "fuel_consumed_l", "odometer_km",
    }
    ints = {"gear", "rpm"}
    out = []
    for c in t.columns:
        if c in floats:
            out.append(F.col(c).cast("float").alias(c))
        elif c in ints:
            out.append(F.col(c).cast("int").alias(c))
        elif c == "ignition_on":
            out.append(F.col(c).cast("boolean").alias(c))
        else:
            out.append(F.col(c))
    return t.select(*out)
