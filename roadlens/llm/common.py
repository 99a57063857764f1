"""Tables, shared intermediate storage and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    there = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in there:
            n += "_"
        there.add(n.lower())
        out.append(n)
    return out


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of fewer rows for what runs inside: rows that hold whole
    texts make large ones, which JVM and Python worker keep side by side."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release() -> None:
    """Gives memory that a worker has freed back to the machine: workers live
    on between tasks, and what they keep adds up beside the JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


class Scratch:
    """Tables of one operator run in the shared folder that
    ``spark.checkpoint.dir`` names. ``keep`` writes a table and reads it back
    (cuts the lineage: a lost executor costs a re-read, not the chain before);
    ``drop`` deletes a table that nothing reads any more. What is left goes
    when the application ends."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"
        self._path(self.root, lambda fs, p: fs.deleteOnExit(p))

    def _path(self, path: str, act) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        act(p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p)

    def keep(self, df: DataFrame, name: str, free: bool = False) -> DataFrame:
        """``free``: the step moved much data. Its shuffle files are of no use
        any more; Spark deletes them once the JVM has noticed that nothing
        refers to them, which this asks it to do now."""
        path = f"{self.root}/{name}"
        with small_batches(self.spark):
            df.write.mode("overwrite").parquet(path)
        if free:
            gc.collect()
            self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for n in names:
            self._path(f"{self.root}/{n}", lambda fs, p: fs.delete(p, True))


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): one row ``(id, comp)``
    for every id that has an edge, ``comp`` being the smallest id reachable.

    Alternating large-star / small-star rounds: each round is one grouped
    minimum and one join, links only ever point to smaller ids, and the
    number of rounds is about the logarithm of the longest path. Rounds are
    written to the shared folder; only the change count reaches the driver.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    cur = scratch.keep(e, f"{name}0")
    i = 0
    while True:
        large = _star(cur, both=True)
        small = _star(large, both=False)
        i += 1
        new = scratch.keep(small, f"{name}{i}")
        # A star forest: every a has one b, and no b is itself an a.
        stable = new.join(cur, ["a", "b"], "left_anti").limit(1).count() == 0 and _same_size(new, cur)
        scratch.drop(f"{name}{i - 1}")
        cur = new
        if stable:
            break
    return (
        cur.select(F.col("a").alias("id"), F.col("b").alias("comp"))
        .union(cur.select(F.col("b"), F.col("b")))
        .groupBy("id")
        .agg(F.min("comp").alias("comp"))
    )


def _same_size(x: DataFrame, y: DataFrame) -> bool:
    return x.count() == y.count()


def _star(e: DataFrame, both: bool) -> DataFrame:
    """One star round over links ``(a, b)``, a > b. Large star: every larger
    neighbour of a node is linked to the node's smallest neighbour. Small
    star: every smaller neighbour and the node itself are."""
    if both:
        n = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        n = e
    low = n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    j = n.join(low, "a")
    if both:
        out = j.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()
