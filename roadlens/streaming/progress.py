"""Progress of streaming queries, kept for good.

``recentProgress`` holds a query's last batches only and ends with it. A
:class:`ProgressLog` is told of every batch and appends its counters to a
folder of JSON lines, one small file per batch, which :func:`read_progress`
reads as a table.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = "query string, run_id string, batch_id long, input_rows long, state_rows long, dropped_by_watermark long, watermark string, batch_ms long"


class ProgressLog(StreamingQueryListener):
    """Appends every batch of every query of ``spark`` to ``path``. Use as a
    context: leaving it waits until the queries that ended in it are told of."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: set[str] = set()
        self._begun: set[str] = set()
        self._change = threading.Condition()
        p = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        running = {str(q.runId) for q in self.spark.streams.active}
        with self._change:
            self._change.wait_for(lambda: self._begun - running <= self._ended, timeout=60)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._begun.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators or []
        row = {
            "query": str(p.id),
            "run_id": str(p.runId),
            "batch_id": p.batchId,
            "input_rows": p.numInputRows,
            "state_rows": sum(s.numRowsTotal for s in state),
            "dropped_by_watermark": sum(s.numRowsDroppedByWatermark for s in state),
            "watermark": (p.eventTime or {}).get("watermark"),
            "batch_ms": p.batchDuration,
        }
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.runId}-{p.batchId}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch. A batch that reported more than once (a query with
    nothing to do repeats its last one) is there with its last report."""
    return spark.read.schema(PROGRESS).json(path)
