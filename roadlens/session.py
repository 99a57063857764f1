"""Spark session helpers."""

from __future__ import annotations

import gc
import io
import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "roadlens") -> SparkSession:
    """Session used by tests and the bench: UTC, AQE on, UI off."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Makes this package known to the workers of an application whose
    machines don't have it installed: a zip of its sources in the shared
    folder, added once with ``addPyFile``."""
    sc = spark.sparkContext
    if getattr(sc, "_roadlens_shipped", False):
        return
    here = pathlib.Path(__file__).resolve().parent
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/roadlens.zip")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(blob.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path.toString())
    sc._roadlens_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is taken as is;
    without it this raises. Only a session whose tasks run inside the driver
    (``local[...]``, as in tests) gets a scratch folder, which goes when the
    session ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="roadlens-ckpt-")
        path = spark._jvm.org.apache.hadoop.fs.Path(conf_dir)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def checkpoint_root(spark: SparkSession) -> str:
    """Folder under which streaming checkpoints and materialised tables go."""
    d = ensure_checkpoint_dir(spark)
    return d.rstrip("/")


# Settings for a large cluster (hundreds of TB of telemetry). Applied by
# :func:`apply_cluster_defaults` only where the session does not set them.
CLUSTER_DEFAULTS = {
    # AQE: coalesce small shuffle partitions, split skewed ones, pick
    # broadcast joins from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Start with many shuffle partitions; AQE merges them down at runtime.
    "spark.sql.shuffle.partitions": "8000",
    # Scan splits sized for executor memory.
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming state off-heap in RocksDB (per-vehicle state, event-time timers).
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_defaults(spark: SparkSession) -> SparkSession:
    """Set :data:`CLUSTER_DEFAULTS` for keys the session has not set."""
    for k, v in CLUSTER_DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes shuffle files once the JVM has noticed that nothing refers
    to them, which this asks it to do now."""
    gc.collect()
    spark._jvm.System.gc()


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable
    ``checkpoint()``, never ``localCheckpoint``) and continue from it, so a
    lost executor does not force recomputation of a long chain of passes."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
