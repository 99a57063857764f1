import json
import uuid

import pytest

from conftest import SF_SMALL, T0
from roadlens.session import checkpoint_root
from roadlens.streaming import segments as SG
from roadlens.streaming import stream as ST


@pytest.fixture
def base(spark):
    return f"{checkpoint_root(spark)}/topic-{uuid.uuid4().hex}"


def _files(spark, base, n):
    """Adds a file of ten readings to the folder that the stream reads."""
    rows = [(None if i == 9 else f"v{i % 4}", n * 10 + i, "a\nb" if i == 5 else None) for i in range(10)]
    spark.createDataFrame(rows, "vehicle_id string, n long, note string").coalesce(2).write.mode("append").parquet(f"{base}/in")


def _publish(spark, base):
    s = ST.file_source(spark, f"{base}/in", "vehicle_id string, n long, note string", max_files_per_trigger=1)
    SG.write_topic(s, f"{base}/topic", f"{base}/out_ckpt", partitions=3, trigger={"availableNow": True}).awaitTermination()


def _read(spark, base, most, name="back"):
    w = SG.read_topic(spark, f"{base}/topic", most).writeStream.format("parquet").option("path", f"{base}/{name}")
    q = w.option("checkpointLocation", f"{base}/{name}_ckpt").trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
        return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()


def test_resumed_reader_and_writer_lose_and_repeat_nothing(spark, base):
    _files(spark, base, 0)
    _publish(spark, base)
    assert _read(spark, base, 4) == [4, 4, 2]
    _files(spark, base, 1)
    _files(spark, base, 2)
    _publish(spark, base)
    assert sum(_read(spark, base, 7)) == 20
    got = spark.read.schema(SG.MESSAGE).parquet(f"{base}/back").collect()
    assert sorted(json.loads(r.value)["n"] for r in got) == list(range(30))
    assert all(json.loads(r.value).get("vehicle_id") == r.key for r in got)
    assert sum(json.loads(r.value).get("note") == "a\nb" for r in got) == 3
    ends = SG.Topic(f"{base}/topic").ends()
    assert sorted((r.partition, r.offset) for r in got) == sorted((int(p), o) for p, n in ends.items() for o in range(n))
    # One key, one partition; rows without a key are dealt out.
    assert all(len({r.partition for r in got if r.key == k}) == 1 for k in ("v0", "v1", "v2", "v3"))
    # A second reader starts at the beginning, without a limit in one batch.
    assert _read(spark, base, 0, "again") == [30]


def test_a_replayed_batch_adds_nothing(base):
    w = SG.SegmentWriter(base, 2, 3, 0, 1)
    done = w.write(iter([("a", str(i)) for i in range(7)]))
    w.commit([done, None], 0)
    ends = SG.Topic(base).ends()
    assert sum(ends.values()) == 7 and len(done.segments) == 3
    again = w.write(iter([("a", str(i)) for i in range(7)]))
    w.commit([again], 0)
    topic = SG.Topic(base)
    assert topic.ends() == ends and topic.batches() == [0]
    names = {f.path.split("/")[-1] for f in topic.fs.get_file_info(SG.pafs.FileSelector(f"{topic.root}/segments"))}
    assert names == {s["name"].split("/")[1] for s in done.segments}
    # A failed batch leaves no files; an empty one is a batch.
    w.abort([w.write(iter([("b", "x")]))], 1)
    w.commit([w.write(iter([]))], 1)
    assert topic.ends() == ends and topic.batches() == [0, 1]


def test_stretches_by_halving(base):
    """Any stretch of offsets names just the messages in it."""
    w = SG.SegmentWriter(base, 2, 4, 0, 1)
    for b in range(9):
        w.commit([w.write(iter([(f"k{i % 3}", f"{b}-{i}") for i in range(b)]))], b)
    ends = SG.Topic(base).ends()
    assert sum(ends.values()) == 36
    for lo in range(0, max(ends.values()), 3):
        for hi in range(lo, max(ends.values()) + 1, 4):
            start, end = ({p: min(n, x) for p, n in ends.items()} for x in (lo, hi))
            r = SG.SegmentReader(base, 0)
            got = [x for t in r.partitions(start, end) for b in r.read(t) for x in b.to_pylist()]
            assert sorted((str(x["partition"]), x["offset"]) for x in got) == sorted((p, o) for p in ends for o in range(start[p], end[p]))


def test_limit_is_shared_by_backlogs(base):
    assert SG.SegmentReader(base, 5).latestOffset() == {}  # no topic yet
    w = SG.SegmentWriter(base, 2, 100, 0, 1)
    w.commit([SG.Written([{"name": "x", "partition": 0, "rows": 1}, {"name": "y", "partition": 1, "rows": 20}])], 0)
    r = SG.SegmentReader(base, 6)
    steps = [dict(r.latestOffset()) for _ in range(5)]
    assert [sum(s.values()) for s in steps] == [6, 12, 18, 21, 21]
    # A resumed reader goes on from the batch it is told of.
    r = SG.SegmentReader(base, 6)
    r.partitions({"0": 1, "1": 5}, {"0": 1, "1": 5})
    assert r.latestOffset() == {"0": 1, "1": 11}
