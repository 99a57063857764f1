"""Keyed Parquet tables that grow as a log: batches append, reads merge.

Layout under the table's folder::

    delta/v=<version>/part-*.parquet         one batch's rows, as they came
    log/<version>.json                       its days and rows in each, its rule
    base/b=<k>/_day=<day>/part-*.parquet     merged days, sorted by key
    snapshots/<k>.json                       merged days and deltas not yet merged
    index/<key>/k=<k>/                       what the merged files hold of a key

A batch writes its own rows and one small log entry, whatever the table holds;
it is evaluated once. Its entry is written last, so a reader never sees half a
batch and a failed one is written anew; a batch that is replayed with its own
number finds its entry and does nothing. A read takes the merged days and the
deltas on top of them and merges by the table's rule, days without deltas
straight from their files. :meth:`KeyedTable.compact` merges the days whose
deltas outweigh them, apart from any batch. Storage errors are never taken for
an empty table: what is there is asked of the file system, and everything else
fails the read or the batch.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "_day"
VERSION = "_version"
_MERGED = -1  # version of merged rows that set every column
_BITS = 32_768  # of the bitmap functions
COMPACT_EVERY = 16  # batches between two looks for days to merge


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(_BITS))


@dataclass(frozen=True)
class Rule:
    """How rows of one key become one: ``last`` keeps the last by ``order``
    (then by batch), ``set`` takes each of ``cols`` from the last batch that set it."""

    kind: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    cols: tuple[str, ...] = ()

    def merge(self, rows: DataFrame, sets: dict[int, Sequence[str]]) -> DataFrame:
        """One row per key. ``sets``: the columns that each version sets."""
        from roadlens.sources.sinks import dedup_latest

        if self.kind == "last":
            return dedup_latest(rows, [*self.keys], [*self.order, VERSION])
        out = [F.lit(_MERGED).cast("long").alias(VERSION), F.min(DAY).alias(DAY)]
        for c in rows.columns:
            if c in (*self.keys, VERSION, DAY):
                continue
            by = [v for v, cols in sets.items() if c in cols]
            last = F.max(F.when(F.col(VERSION).isin(_MERGED, *by), F.struct(VERSION, c)))
            out.append(last[c].alias(c))
        return rows.groupBy(*self.keys).agg(*out)


def last_write(keys: Sequence[str], order: Sequence[str]) -> Rule:
    """One row per key, the last by ``order``; of equal ones the newer batch's."""
    return Rule("last", tuple(keys), tuple(order))


def replace_rows(keys: Sequence[str]) -> Rule:
    """The batch's rows replace those of the same keys (a later state of the
    same window); a batch has one row per key."""
    return Rule("last", tuple(keys))


def set_columns(keys: Sequence[str], cols: Sequence[str]) -> Rule:
    """The batch sets ``cols`` of the rows of its keys and adds rows for new
    keys; every other column stays."""
    return Rule("set", tuple(keys), (), tuple(cols))


@dataclass
class State:
    """What a reader sees: merged days as {day: (base, rows)}, and deltas
    {version: {day: rows}} with each version's rule."""

    bases: dict[str, tuple[int, int]] = field(default_factory=dict)
    deltas: dict[int, dict[str, int]] = field(default_factory=dict)
    rules: dict[int, Rule] = field(default_factory=dict)
    rule: Rule | None = None
    through: int = -1

    def add(self, version: int, entry: dict) -> None:
        rule = Rule(**{k: tuple(v) if isinstance(v, list) else v for k, v in entry["rule"].items()})
        if entry["days"]:
            self.deltas[version], self.rules[version] = dict(entry["days"]), rule
        self.rule, self.through = rule, max(self.through, version)

    def days(self) -> set[str]:
        return set(self.bases).union(*self.deltas.values())

    def waiting(self, day: str) -> int:
        return sum(d.get(day, 0) for d in self.deltas.values())


class KeyedTable:
    """One table: ``day`` gives a row's partition, ``sort`` the row order in
    its files (time range scans of one vehicle skip row groups)."""

    def __init__(self, spark: SparkSession, path: str, day: Column, sort: Sequence[str] = ()):
        self.spark, self.path, self.day, self.sort = spark, path.rstrip("/"), day, list(sort)

    # -- file system -------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _write_json(self, path: str, value: dict) -> None:
        """The file is there with its whole content or not at all."""
        fs, tmp = self._fs(f"{path}.tmp")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()
        _, p = self._fs(path)
        fs.delete(p, False)
        if not fs.rename(tmp, p):
            raise OSError(f"cannot write {path}")

    def _read_json(self, path: str) -> dict:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            size = fs.getFileStatus(p).getLen()
            return json.loads(bytes(stream.readNBytes(int(size))))
        finally:
            stream.close()

    def _numbers(self, folder: str) -> list[int]:
        names = [n.removesuffix(".json") for n in self._children(f"{self.path}/{folder}") if n.endswith(".json")]
        return sorted(int(n) for n in names if n.isdigit())

    # -- state -------------------------------------------------------------

    def _snapshot(self, k: int) -> State:
        s = self._read_json(f"{self.path}/snapshots/{k}.json")
        out = State()
        for v, entry in sorted(s["deltas"].items(), key=lambda x: int(x[0])):
            out.add(int(v), entry)
        out.bases = {d: (b, n) for d, (b, n) in s["bases"].items()}
        out.rule = Rule(**{k: tuple(v) if isinstance(v, list) else v for k, v in s["rule"].items()})
        out.through = s["through"]
        return out

    def state(self) -> State:
        """Merged days, and deltas on top, of all committed batches."""
        snapshots = self._numbers("snapshots")
        out = self._snapshot(snapshots[-1]) if snapshots else State()
        since = out.through
        for v in self._numbers("log"):
            if v > since:
                out.add(v, self._read_json(f"{self.path}/log/{v}.json"))
        return out

    def version(self) -> int:
        """The newest committed batch, -1 if there is none."""
        return self.state().through

    # -- batches -----------------------------------------------------------

    def commit(self, batch: DataFrame, rule: Rule, version: int | None = None) -> int:
        """Appends ``batch``. ``version`` is the batch's own number (an
        epoch); a number that is already committed is a replay. Returns it."""
        newest = self.version()
        if version is None:
            version = newest + 1
        elif version <= newest:
            return version
        path = f"{self.path}/delta/v={version}"
        rows = batch.withColumn(DAY, self.day.cast("string")).withColumn(VERSION, F.lit(version).cast("long"))
        if rule.kind == "set":
            rows = rows.select(*rule.keys, *rule.cols, DAY, VERSION)
        rows.sortWithinPartitions(DAY, *self.sort).write.mode("overwrite").option("compression", "zstd").parquet(path)
        days = {r[DAY]: r["count"] for r in self.spark.read.schema(rows.schema).parquet(path).groupBy(DAY).count().collect()}
        if not days or None in days:
            self._delete(path)
        if None in days:
            raise ValueError("a row without its day cannot be stored")
        self._write_json(f"{self.path}/log/{version}.json", {"days": days, "rule": asdict(rule)})
        return version

    # -- reads -------------------------------------------------------------

    def read(self, days: Sequence[str] | None = None) -> DataFrame | None:
        """One row per key, of all or the given days; None if there are none."""
        state = self.state()
        wanted = sorted(state.days()) if days is None else [d for d in days if d in state.days()]
        rows = self._rows(state, wanted)
        return None if rows is None else rows.drop(DAY, VERSION)

    def _rows(self, state: State, days: Sequence[str]) -> DataFrame | None:
        wanted = set(days)
        open_ = wanted.intersection(*[set().union(*state.deltas.values())])
        done = self._base(state, sorted(wanted - open_))
        if not open_:
            return done
        versions = [v for v, d in state.deltas.items() if open_.intersection(d)]
        delta = self.spark.read.option("mergeSchema", str(state.rule.kind == "set").lower())
        rows = delta.parquet(*[f"{self.path}/delta/v={v}" for v in versions])
        stored = set().union(*[state.deltas[v] for v in versions])
        if stored - open_:
            rows = rows.where(F.col(DAY).isin(*sorted(open_)))
        old = self._base(state, sorted(open_))
        if old is not None:
            rows = rows.unionByName(old, allowMissingColumns=True)
        rows = state.rule.merge(rows, {v: r.cols for v, r in state.rules.items()})
        return rows if done is None else rows.unionByName(done, allowMissingColumns=True)

    def _base(self, state: State, days: Sequence[str]) -> DataFrame | None:
        paths = [f"{self.path}/base/b={state.bases[d][0]}/{DAY}={d}" for d in days if d in state.bases]
        if not paths:
            return None
        # The day also stands in the files, as the folder's name is not read.
        return self.spark.read.parquet(*paths).withColumnRenamed("_of_day", DAY)

    # -- index -------------------------------------------------------------

    def index(self, key: str, ts: str) -> DataFrame:
        """Index of the merged files, written for the newest snapshot: of each
        file its day, its smallest and largest ``ts``, and a bitmap of hashed
        ``key`` values (a Bloom filter of one hash, 4 KB whatever the file)."""
        state, k = self.state(), self._numbers("snapshots")[-1]
        rows = self._base(state, sorted(state.bases)).select(F.col("_metadata.file_path").alias("file"), F.col(DAY), F.col(key), F.col(ts))
        out = rows.groupBy("file", DAY).agg(F.min(ts).alias("low"), F.max(ts).alias("high"), F.bitmap_construct_agg(_bit(key)).alias("keys"))
        out.write.mode("overwrite").parquet(f"{self.path}/index/{key}/k={k}")
        return self.spark.read.schema(out.schema).parquet(f"{self.path}/index/{key}/k={k}")

    def files_for(self, requests: DataFrame, key: str, ts: str) -> list[str]:
        """Merged files that may hold rows of ``requests(key, since, until)``:
        of their days, overlapping in time, with the key's bit set."""
        k = self._numbers("snapshots")[-1]
        path = f"{self.path}/index/{key}/k={k}"
        index = self.spark.read.parquet(path) if self._exists(path) else self.index(key, ts)
        asked = requests.select("since", "until", _bit(key).alias("_bit"), F.explode(F.sequence(F.to_date("since"), F.to_date("until"))).alias(DAY))
        asked = asked.withColumn(DAY, F.col(DAY).cast("string"))
        byte = F.conv(F.hex(F.expr("substring(keys, CAST(_bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
        has = F.expr("_bit % 8").cast("int")
        hits = index.join(asked, DAY).where((F.col("low") < F.col("until")) & (F.col("high") >= F.col("since")))
        hits = hits.withColumn("_byte", byte).withColumn("_at", has).where(F.expr("(_byte & shiftleft(1, _at)) != 0"))
        return sorted(r["file"] for r in hits.select("file").distinct().collect())

    def read_requests(self, requests: DataFrame, key: str, ts: str) -> DataFrame:
        """Rows of each of ``requests(key, since, until)``, a key and a range of
        ``ts`` (``until`` excluded). Of the merged days only the files are
        opened that the index leaves; days with deltas are merged whole. A row
        comes once for every request that asks for it."""
        state = self.state()
        open_ = set().union(*[set(d) for d in state.deltas.values()])
        files = self.files_for(requests, key, ts)
        held = [f for f in files if f.rsplit(f"/{DAY}=", 1)[1].split("/")[0] not in open_]
        parts = [self.spark.read.parquet(*held).withColumnRenamed("_of_day", DAY)] if held else []
        fresh = self._rows(state, sorted(open_)) if open_ else None
        parts += [fresh] if fresh is not None else []
        rows = parts[0] if parts else self._rows(state, sorted(state.days())).limit(0)
        for p in parts[1:]:
            rows = rows.unionByName(p, allowMissingColumns=True)
        rows = rows.drop(DAY, VERSION)
        asked = requests.select(F.col(key), F.col("since").alias("_since"), F.col("until").alias("_until"))
        found = rows.join(asked, key).where((F.col(ts) >= F.col("_since")) & (F.col(ts) < F.col("_until")))
        return found.drop("_since", "_until")

    # -- compaction --------------------------------------------------------

    def compact(self, weight: float = 1.0) -> list[str]:
        """Merges the days whose deltas have at least ``weight`` times the
        rows of what is merged already; other days and their files stay.
        Returns those days."""
        state = self.state()
        due = sorted(d for d in state.days() if (n := state.waiting(d)) and n >= weight * state.bases.get(d, (0, 0))[1])
        if not due:
            return []
        snapshots = self._numbers("snapshots")
        k = snapshots[-1] + 1 if snapshots else 0
        path = f"{self.path}/base/b={k}"
        rows = self._rows(state, due)
        (
            rows.withColumn("_of_day", F.col(DAY))
            .repartitionByRange(DAY, *self.sort)
            .sortWithinPartitions(DAY, *self.sort)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy(DAY)
            .parquet(path)
        )
        sizes = {r["_of_day"]: r["count"] for r in self.spark.read.parquet(*[f"{path}/{DAY}={d}" for d in due]).groupBy("_of_day").count().collect()}
        bases = state.bases | {d: (k, sizes[d]) for d in due}
        left = {v: {d: n for d, n in days.items() if d not in due} for v, days in state.deltas.items()}
        entries = {v: {"days": days, "rule": asdict(state.rules[v])} for v, days in left.items() if days}
        self._write_json(
            f"{self.path}/snapshots/{k}.json",
            {"bases": bases, "deltas": entries, "rule": asdict(state.rule), "through": state.through},
        )
        self._clean(k)
        return due

    def _clean(self, newest: int) -> None:
        """Deletes what neither the newest snapshot nor the one before it
        (readers may still be at it) needs."""
        kept = [self._snapshot(k) for k in self._numbers("snapshots") if k >= newest - 1]
        if len(kept) < 2:
            return
        through = min(s.through for s in kept)
        bases = {b for s in kept for b, _ in s.bases.values()}
        deltas = {v for s in kept for v in s.deltas}
        for v in self._numbers("log"):
            if v <= through:
                self._delete(f"{self.path}/log/{v}.json")
                if v not in deltas:
                    self._delete(f"{self.path}/delta/v={v}")
        for v in [int(n.removeprefix("v=")) for n in self._children(f"{self.path}/delta")]:
            if v <= through and v not in deltas:
                self._delete(f"{self.path}/delta/v={v}")
        for name in self._children(f"{self.path}/base"):
            b = int(name.removeprefix("b="))
            if b not in bases:
                self._delete(f"{self.path}/base/{name}")
                continue
            held = {d for s in kept for d, (of, _) in s.bases.items() if of == b}
            for day in self._children(f"{self.path}/base/{name}"):
                if day.startswith(f"{DAY}=") and day.removeprefix(f"{DAY}=") not in held:
                    self._delete(f"{self.path}/base/{name}/{day}")
        for k in self._numbers("snapshots"):
            if k < newest - 1:
                self._delete(f"{self.path}/snapshots/{k}.json")
                for key in self._children(f"{self.path}/index"):
                    self._delete(f"{self.path}/index/{key}/k={k}")

    def commit_and_compact(self, batch: DataFrame, rule: Rule, version: int | None = None) -> int:
        """What a stream's sink does with a micro-batch: append it, and now
        and then merge the days that have become mostly deltas."""
        version = self.commit(batch, rule, version)
        if version % COMPACT_EVERY == COMPACT_EVERY - 1:
            self.compact()
        return version
