"""A topic of keyed JSON messages in a shared folder (S1, S16), as a Python
data source: ``readStream.format("segments")``, ``writeStream.format("segments")``.

Messages lie in segment files, one JSON pair of key and value a line. A batch
of a writer becomes visible through its manifest, one small file that is moved
into place: it names the batch's segments and the offsets at which every
partition begins and ends. A replayed batch finds its manifest and adds
nothing. A topic has one writing query at a time; any number read it.

Options: ``path`` (any folder that Arrow's file systems open); writing:
``partitions`` (of a topic's first batch on, 8), ``segment_rows`` (1,000,000);
reading: ``max_records`` per micro-batch (0: no limit).
"""

from __future__ import annotations

import json
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from roadlens.session import ship_package

MESSAGE = "partition int, offset long, key string, value string"
READ_ROWS = 8192  # messages in an Arrow batch
TASK_ROWS = 1_000_000  # small segments of a partition are read by one task up to so many messages


class Topic:
    """Files of one topic."""

    def __init__(self, path: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        self.log = f"{self.root}/manifests"

    def batches(self) -> list[int]:
        """Numbers of the visible batches, rising."""
        found = self.fs.get_file_info(pafs.FileSelector(self.log, allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))

    def manifest(self, batch: int) -> dict:
        with self.fs.open_input_stream(f"{self.log}/{batch:019d}.json") as f:
            return json.loads(f.read())

    def publish(self, batch: int, manifest: dict) -> None:
        self.fs.create_dir(self.log)
        made = f"{self.log}/{uuid.uuid4().hex}.new"
        with self.fs.open_output_stream(made) as f:
            f.write(json.dumps(manifest).encode())
        self.fs.move(made, f"{self.log}/{batch:019d}.json")

    def ends(self) -> dict[str, int]:
        """Offset behind the last message of every partition."""
        there = self.batches()
        return self.manifest(there[-1])["ends"] if there else {}

    def segments(self, start: dict[str, int], end: dict[str, int]) -> Iterator[dict]:
        """Segments with messages from ``start`` to before ``end``. Ends rise
        from batch to batch, so the first one is found by halving."""
        there = self.batches()
        lo, hi = 0, len(there)
        while lo < hi:
            mid = (lo + hi) // 2
            if any(n > start.get(p, 0) for p, n in self.manifest(there[mid])["ends"].items()):
                hi = mid
            else:
                lo = mid + 1
        for b in there[lo:]:
            m = self.manifest(b)
            for s in m["segments"]:
                p = str(s["partition"])
                if s["first"] < end.get(p, 0) and s["first"] + s["rows"] > start.get(p, 0):
                    yield s
            if all(m["ends"].get(p, 0) >= n for p, n in end.items()):
                return

    def lines(self, name: str) -> Iterator[str]:
        with self.fs.open_input_stream(f"{self.root}/{name}", buffer_size=1 << 20) as f:
            rest = b""
            while block := f.read(1 << 20):
                *whole, rest = (rest + block).split(b"\n")
                for line in whole:
                    yield line.decode()


@dataclass
class Stretch(InputPartition):
    """Messages of one partition from segment files in order: (name, offset of
    the file's first message, messages ``skip`` to before ``stop`` of it)."""

    partition: int
    pieces: list[tuple[str, int, int, int]]
    rows: int = 0


class SegmentReader(DataSourceStreamReader):

    def __init__(self, path: str, most: int):
        self.path, self.most = path, most
        self._at: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """The end of the next micro-batch: of ``most`` messages each partition
        with a backlog gives its share, what a short one leaves goes to the others."""
        ends = Topic(self.path).ends()
        if not self.most:
            return ends
        at = dict(self._at or {})
        left = self.most
        while left and (behind := sorted(p for p, n in ends.items() if n > at.get(p, 0))):
            for i, p in enumerate(behind):
                share = min(ends[p] - at.get(p, 0), -(-left // (len(behind) - i)))
                at[p] = at.get(p, 0) + share
                left -= share
        self._at = at
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # A query that resumes names its last batch before it asks for more.
        if self._at is None:
            self._at = dict(end)
        tasks: list[Stretch] = []
        open_: dict[int, Stretch] = {}
        for s in Topic(self.path).segments(start, end):
            p = s["partition"]
            skip, stop = max(0, start.get(str(p), 0) - s["first"]), min(s["rows"], end[str(p)] - s["first"])
            task = open_.get(p)
            if task is None or task.rows + stop - skip > TASK_ROWS:
                task = open_[p] = Stretch(p, [])
                tasks.append(task)
            task.pieces.append((s["name"], s["first"], skip, stop))
            task.rows += stop - skip
        return tasks

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string())])
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for name, first, skip, stop in partition.pieces:
            for i, line in enumerate(Topic(self.path).lines(name)):
                if i >= stop:
                    break
                if i >= skip:
                    rows.append((partition.partition, first + i, *json.loads(line)))
                if len(rows) == READ_ROWS:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    segments: list[dict]  # name, partition, rows


class SegmentWriter(DataSourceStreamWriter):
    """Rows of ``key, value``: equal keys go to one partition, null keys are
    dealt out in turn. Files that no manifest names are not part of the topic."""

    def __init__(self, path: str, partitions: int, segment_rows: int, key: int, value: int):
        self.path, self.n, self.segment_rows = path, partitions, segment_rows
        self.key, self.value = key, value

    def write(self, iterator: Iterator) -> Written:
        topic, run = Topic(self.path), uuid.uuid4().hex
        done: list[dict] = []
        # Open segment of each partition.
        files: dict[int, tuple] = {}
        made = False
        turn = zlib.crc32(run.encode())
        try:
            for row in iterator:
                key, value = row[self.key], row[self.value]
                if key is None:
                    turn += 1
                p = (turn if key is None else zlib.crc32(key.encode())) % self.n
                if p not in files:
                    if not made:
                        topic.fs.create_dir(f"{topic.root}/segments")
                        made = True
                    s = {"name": f"segments/{run}-{p}-{len(done)}.jsonl", "partition": p, "rows": 0}
                    done.append(s)
                    files[p] = s, topic.fs.open_output_stream(f"{topic.root}/{s['name']}", buffer_size=1 << 16)
                s, f = files[p]
                f.write(json.dumps([key, value], ensure_ascii=False).encode() + b"\n")
                s["rows"] += 1
                if s["rows"] == self.segment_rows:
                    files.pop(p)[1].close()
        finally:
            for _, f in files.values():
                f.close()
        return Written(done)

    def commit(self, messages: list, batchId: int) -> None:
        topic = Topic(self.path)
        there = topic.batches()
        if there and there[-1] >= batchId:
            self.abort(messages, batchId)  # replayed: what it wrote is there
            return
        ends = topic.ends() or {str(p): 0 for p in range(self.n)}
        segments = []
        for m in messages:
            for s in m.segments if m else ():
                p = str(s["partition"])
                segments.append(s | {"first": ends.get(p, 0)})
                ends[p] = ends.get(p, 0) + s["rows"]
        topic.publish(batchId, {"ends": ends, "segments": segments})

    def abort(self, messages: list, batchId: int) -> None:
        topic = Topic(self.path)
        for m in messages:
            for s in m.segments if m else ():
                topic.fs.delete_file(f"{topic.root}/{s['name']}")


class Segments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return MESSAGE

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options["path"], int(self.options.get("max_records", "0")))

    def streamWriter(self, schema, overwrite: bool) -> SegmentWriter:
        names = schema.names
        if not {"key", "value"} <= set(names):
            raise ValueError(f"a topic takes key and value, not {names}")
        return SegmentWriter(
            self.options["path"], int(self.options.get("partitions", "8")), int(self.options.get("segment_rows", "1000000")), names.index("key"), names.index("value")
        )


def register(spark: SparkSession) -> None:
    """Makes the format known to a session. Spark plans Python sources in
    processes that do not get the application's files, so the classes travel
    by value."""
    ship_package(spark)
    here = sys.modules[__name__]
    cloudpickle.register_pickle_by_value(here)
    try:
        spark.dataSource.register(Segments)
    finally:
        cloudpickle.unregister_pickle_by_value(here)


def read_topic(spark: SparkSession, path: str, max_records: int = 0) -> DataFrame:
    """The messages of a topic from its beginning: partition, offset, key,
    value. With ``max_records`` a micro-batch has at most so many; such a query
    runs with a processing-time trigger (``availableNow`` ends after the one
    batch that was next when it started)."""
    register(spark)
    r = spark.readStream.format("segments").option("path", path)
    return r.option("max_records", str(max_records)).load()


def write_topic(df: DataFrame, path: str, checkpoint: str, key: str = "vehicle_id", mode: str = "append", partitions: int = 8, trigger: dict | None = None) -> StreamingQuery:
    """Publishes rows of a stream as JSON messages keyed by ``key``. Null
    keys and null fields are allowed; fields that are null are not written."""
    spark = df.sparkSession
    register(spark)
    out = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    w = out.writeStream.format("segments").option("path", path).option("partitions", str(partitions))
    return w.option("checkpointLocation", checkpoint).outputMode(mode).trigger(**(trigger or {"processingTime": "0 seconds"})).start()
