"""Embedding near-dedup with hierarchical navigable small-world graphs.

Vectors of one label are dealt over shards; each shard gets a graph, every
shard is searched for every vector of the label, and pairs found are checked
in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.ann import usable
from roadlens.llm.common import Scratch, components

THRESHOLD = 0.93
SHARD = 4096
DEGREE = 16
EF_BUILD = 48
EF = 48
AUDIT = 64
RECALL = 0.98
SAMPLE = 1024  # rows of a label that its audit starts with
MOST_SAMPLE = 16_384  # and goes up to while few of them have partners
LEAST_ROWS = 256  # rows with partners that an audit asks for
_BATCH = 256


class Graph:
    """HNSW graph over unit rows. Level 0 holds every node with up to
    2 * degree links, each level above a random 1 / degree of the one below.
    Inserts and searches work on batches of vectors at a time."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, ef: int = EF_BUILD, seed: int = 7):
        self.x, self.degree = x, degree
        n = len(x)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(1.0 - rng.random(n)) / math.log(degree)).astype(int), 6)
        order = np.argsort(-level, kind="stable")  # upper levels first: an entry point is always there
        self.level = level
        # Rows have half as much room again, so that one is thinned out only
        # every so many links.
        wide = [2 * degree if k == 0 else degree for k in range(int(level.max(initial=0)) + 1)]
        self.links = [np.full((n, w + w // 2), -1, np.int32) for w in wide]
        self.entry = int(order[0]) if n else -1
        done = 1
        while done < n:
            some = order[done : done + min(_BATCH, max(1, done))]
            self._insert(some, ef)
            done += len(some)
        for k, w in enumerate(wide):
            for node in np.flatnonzero(self.links[k][:, w] >= 0).tolist():
                self._thin(k, node)
            self.links[k] = np.ascontiguousarray(self.links[k][:, :w])

    def _insert(self, some: np.ndarray, ef: int) -> None:
        at = np.full(len(some), self.entry, np.int32)
        q = self.x[some]
        sims = q @ q.T
        top = self.level[self.entry]
        for k in range(top, -1, -1):
            here = self.level[some] >= k
            found, sim = self._search(q, at, k, ef if here.any() else 1)
            at = np.where(found[:, 0] >= 0, found[:, 0], at)
            for r in np.flatnonzero(here).tolist():
                # Earlier vectors of the same batch are candidates, too.
                mates = np.flatnonzero(here[:r])
                ids = np.concatenate([found[r][found[r] >= 0], some[mates]])
                s = np.concatenate([sim[r][found[r] >= 0], sims[r, mates]])
                picked = self._diverse(ids, s, self.degree)
                node = int(some[r])
                self.links[k][node, : len(picked)] = picked
                for p in picked.tolist():
                    self._link(k, p, node)

    def _diverse(self, ids: np.ndarray, sim: np.ndarray, m: int) -> np.ndarray:
        """Nearest first, leaving out those nearer to one already picked;
        what is left over fills the rest."""
        if len(ids) <= m:
            return ids
        o = np.argsort(-sim)[: 4 * m]
        ids, sim = ids[o], sim[o]
        near = self.x[ids] @ self.x[ids].T
        closest = np.full(len(ids), -np.inf, np.float32)
        picked = []
        for i in range(len(ids)):
            if closest[i] < sim[i]:
                picked.append(i)
                if len(picked) == m:
                    break
                np.maximum(closest, near[i], out=closest)
        if len(picked) < m:
            rest = np.setdiff1d(np.arange(len(ids)), picked)
            picked += rest[: m - len(picked)].tolist()
        return ids[picked]

    def _link(self, k: int, node: int, other: int) -> None:
        row = self.links[k][node]
        if row[-1] >= 0:
            self._thin(k, node)
        row[int(np.argmin(row))] = other  # the first free place

    def _thin(self, k: int, node: int) -> None:
        row = self.links[k][node]
        ids = row[row >= 0]
        picked = self._diverse(ids, self.x[ids] @ self.x[node], len(row) * 2 // 3)
        row[:] = -1
        row[: len(picked)] = picked

    def _search(self, q: np.ndarray, at: np.ndarray, k: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on level ``k`` for all rows of ``q`` in step: ids and
        cosines of the ``ef`` best seen, best first, -1 where there are fewer."""
        b, links = len(q), self.links[k]
        rows = np.arange(b)
        seen = np.zeros((b, len(self.x) + 1), bool)
        seen[:, -1] = True  # stands for "no link"
        ids = np.full((b, ef), -1, np.int32)
        sim = np.full((b, ef), -np.inf, np.float32)
        todo = np.zeros((b, ef), bool)
        ids[:, 0], todo[:, 0] = at, True
        sim[:, 0] = np.einsum("bd,bd->b", q, self.x[at])
        seen[rows, at] = True
        live = rows
        while len(live):
            pick = np.where(todo[live], sim[live], -np.inf).argmax(axis=1)
            go = todo[live, pick]
            live, pick = live[go], pick[go]
            if not len(live):
                break
            todo[live, pick] = False
            nb = links[ids[live, pick]]
            fresh = ~seen[live[:, None], nb]
            seen[live[:, None], nb] = True
            s = np.einsum("bd,bmd->bm", q[live], self.x[nb])
            s[~fresh] = -np.inf
            all_s = np.concatenate([sim[live], s], axis=1)
            all_i = np.concatenate([ids[live], np.where(fresh, nb, -1)], axis=1)
            all_t = np.concatenate([todo[live], fresh], axis=1)
            best = np.argpartition(-all_s, ef - 1, axis=1)[:, :ef]
            r = np.arange(len(live))[:, None]
            sim[live], ids[live], todo[live] = all_s[r, best], all_i[r, best], all_t[r, best]
            todo[live] &= ids[live] >= 0
        o = np.argsort(-sim, axis=1)
        return ids[rows[:, None], o], sim[rows[:, None], o]

    def search(self, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest nodes found for each row of ``q``."""
        at = np.full(len(q), self.entry, np.int32)
        for k in range(len(self.links) - 1, 0, -1):
            found, _ = self._search(q, at, k, 1)
            at = found[:, 0]
        return self._search(q, at, 0, ef)


def within(graph: Graph, q: np.ndarray, least: float, ef: int = EF, audit: int = AUDIT, recall: float = RECALL,
           same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of ``q``, node) of cosine at least ``least`` that the graph
    gives. A row whose whole beam is that near is searched anew with a beam
    four times as wide; so are all rows while a brute-force audit of evenly
    spread rows finds recall short. A beam of an eighth of the graph would
    cost more than a scan of all of it, so it is one.
    ``same``: the rows are the nodes, and none counts as its own partner."""
    n = len(graph.x)
    spread = np.unique(np.linspace(0, len(q) - 1, min(audit, len(q))).astype(int))
    truth = q[spread] @ graph.x.T >= least
    if same:
        truth[np.arange(len(spread)), spread] = False
    while True:
        left, right = [], []
        todo, wide = np.arange(len(q)), ef
        while len(todo):
            again = []
            for lo in range(0, len(todo), _BATCH):
                rows = todo[lo : lo + _BATCH]
                if 8 * wide >= n:
                    hit = q[rows] @ graph.x.T >= least
                    full = np.zeros(len(rows), bool)
                    r, c = np.nonzero(hit)
                else:
                    ids, sim = graph.search(q[rows], wide)
                    hit = (ids >= 0) & (sim >= least)
                    full = hit.all(axis=1)
                    r, at = np.nonzero(hit & ~full[:, None])
                    c = ids[r, at]
                left.append(rows[r])
                right.append(c)
                again.append(rows[full])
            todo, wide = np.concatenate(again), 4 * wide
        a, b = np.concatenate(left), np.concatenate(right).astype(np.int64)
        got = np.zeros_like(truth)
        where = np.full(len(q), -1)
        where[spread] = np.arange(len(spread))
        of = where[a] >= 0
        got[where[a[of]], b[of]] = True
        if 8 * ef >= n or (got & truth).sum() >= recall * truth.sum():
            return a, b
        ef *= 4


def _unit(v: np.ndarray) -> np.ndarray:
    x = v.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Pairs that connect what all of the pairs connect."""
    parent: dict[int, int] = {}

    def find(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = i = parent[parent[i]]
        return i

    x, y = [], []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(i), find(j)
        if p != q:
            parent[max(p, q)] = min(p, q)
            x.append(i)
            y.append(j)
    return x, y


def _rows(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _levels_of(ef: int, shard: int) -> list[int]:
    """Beams an audit tries: the last is a scan of any usual shard."""
    out = [ef]
    while 8 * out[-1] < 2 * shard:
        out.append(4 * out[-1])
    return out


def audited(nodes: DataFrame, graphs: DataFrame, scratch: Scratch, least: float, shard: int, ef: int, recall: float) -> DataFrame:
    """(label, dim, ef): for each label the narrowest beam that finds, on the
    mean of sampled rows that have partners, the share ``recall`` of a row's
    partners among all rows of the label. Samples of a label grow until
    LEAST_ROWS of their rows have partners, all rows or MOST_SAMPLE are in; in
    the last case the beam found is made four times as wide."""
    beams = _levels_of(ef, shard)
    key = ["label", "dim"]
    sized = nodes.join(nodes.groupBy(*key).agg(F.count("*").alias("of")), key)
    kind = nodes.schema["label"].dataType.simpleString()
    side = graphs.select(*key, "shard", "ids", "x", "levels", "entry")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column("dim")[i].as_py()
                g = _graph(b, i, "x", "levels", "entry", dim)
                ids = _numbers(b, "ids", i)
                rows = b.column("rows")[i].values
                own, q = rows.field("rep").to_numpy(zero_copy_only=False), _unit(_rows(rows.field("v"))).astype(np.float32)
                there = np.zeros(len(own), np.int64)
                found = np.zeros((len(own), len(beams)), np.int64)
                for lo in range(0, len(own), _BATCH):
                    hit = (q[lo : lo + _BATCH] @ g.x.T >= least) & (own[lo : lo + _BATCH, None] != ids[None, :])
                    there[lo : lo + _BATCH] = hit.sum(axis=1)
                some = np.flatnonzero(there)
                for at, beam in enumerate(beams):
                    if 8 * beam >= len(g.x):
                        found[:, at] = there
                    elif len(some):
                        r, c = within(g, q[some], least, beam, audit=0)
                        found[some, at] = np.minimum(there[some], np.bincount(r[own[some[r]] != ids[c]], minlength=len(some)))
                level = np.tile(np.arange(len(beams), dtype=np.int32), len(some))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b.column("label").slice(i, 1).to_pylist() * len(level), b.column("label").type), pa.array(np.full(len(level), dim, np.int32)),
                        pa.array(np.repeat(own[some], len(beams))), pa.array(level), pa.array(np.repeat(there[some], len(beams))), pa.array(found[some].ravel()),
                    ],
                    names=[*key, "rep", "level", "there", "found"],
                )

    done: DataFrame | None = None
    size, left = SAMPLE, sized
    round_ = 0
    while True:
        share = F.lit(float(1 << 20)) * size / F.col("of")
        sample = left.where(F.pmod(F.xxhash64("rep", F.lit(11)), F.lit(1 << 20)) < share)
        packed = sample.groupBy(*key).agg(F.collect_list(F.struct("rep", "v")).alias("rows"))
        seen = packed.join(side, key).mapInArrow(run, f"label {kind}, dim int, rep long, level int, there long, found long")
        per_row = seen.groupBy(*key, "rep", "level").agg((F.sum("found") / F.sum("there")).alias("recall"))
        got = per_row.groupBy(*key, "level").agg(F.avg("recall").alias("recall"), F.count("*").alias("rows"))
        last = len(beams) - 1
        best = got.groupBy(*key).agg(F.coalesce(F.min(F.when(F.col("recall") >= recall, F.col("level"))), F.lit(last)).alias("level"), F.max("rows").alias("rows"))
        whole = left.groupBy(*key).agg(F.first("of").alias("of")).join(best, key, "left")
        whole = scratch.keep(whole.select(*key, "of", F.coalesce("level", F.lit(0)).alias("level"), F.coalesce("rows", F.lit(0)).alias("rows")), f"audit{round_}")
        few = (F.col("rows") < LEAST_ROWS) & (F.col("of") > size)
        unsure = few & F.lit(size >= MOST_SAMPLE)
        ready = whole.where(~few | unsure).select(*key, F.least(F.col("level") + unsure.cast("int"), F.lit(last)).alias("level"))
        done = ready if done is None else done.union(ready)
        left = sized.join(whole.where(few & ~unsure).select(*key), key, "left_semi")
        if whole.where(few & ~unsure).limit(1).count() == 0:
            break
        size, round_ = 4 * size, round_ + 1
    return done.select(*key, (F.lit(ef) * F.pow(F.lit(4), F.col("level"))).cast("int").alias("ef"))


def near_vectors(vectors: DataFrame, least: float = THRESHOLD, shard: int = SHARD, ef: int = EF, recall: float = RECALL) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` -> one row per row: ``vec_id,
    n_links`` (rows of the same label and another id with a cosine of at least
    ``least`` that were found), ``component_id`` (smallest vec_id reachable
    over links), ``kept`` (it is its own component's).

    Rows without label or id, and vectors that are null, zero or hold null or
    non-finite components, link with nothing: no links, component their own
    id. Vectors of different lengths are never compared. Equal vectors of a
    label are one node with a count, so copies, repeated rows included, are
    not spelled out as pairs; rows that repeat an id count as one. No rows
    give no rows; other columns are ignored.

    Shards hold about ``shard`` nodes, so a hot label is many shards. Graphs
    are built once and written to the shared folder; each shard's vectors are
    sent to the graphs of their label from their own on, and both shards of
    such a tile are searched for the other's vectors, with the beam that the
    label's audit asks for. Each tile counts links per vector and returns only
    the pairs that connect its components."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("v"), F.col("label"))
    v = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))).dropDuplicates(["vec_id", "label", "v"])
    scratch = Scratch(vectors.sparkSession, "hnsw")
    nodes = v.withColumn("dim", F.size("v")).groupBy("label", "dim", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    nodes = scratch.keep(nodes, "nodes")
    counts = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("shards"))
    dealt = nodes.join(counts, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
    packed = dealt.groupBy("label", "dim", "shards", "shard").agg(F.collect_list(F.struct("rep", "copies", "v")).alias("rows"))
    levels = "levels array<struct<width:int,links:array<int>>>"
    kind = nodes.schema["label"].dataType.simpleString()
    head = f"label {kind}, dim int, shards int, shard int"
    body = "ids array<long>, copies array<long>, x array<float>"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = b.column("rows")[i].values
                x = _rows(rows.field("v"))
                g = Graph(_unit(x).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[b.column(c).slice(i, 1) for c in ("label", "dim", "shards", "shard")],
                        pa.array([rows.field("rep")], pa.list_(pa.int64())),
                        pa.array([rows.field("copies")], pa.list_(pa.int64())),
                        pa.array([x.ravel()], pa.list_(pa.float32())),
                        pa.array([[{"width": l.shape[1], "links": l.ravel()} for l in g.links]], pa.list_(pa.struct([("width", pa.int32()), ("links", pa.list_(pa.int32()))]))),
                        pa.array([g.entry], pa.int32()),
                    ],
                    names=["label", "dim", "shards", "shard", "ids", "copies", "x", "levels", "entry"],
                )

    graphs = scratch.keep(packed.mapInArrow(build, f"{head}, {body}, {levels}, entry int"), "graphs")
    beams = scratch.keep(audited(nodes, graphs, scratch, least - 1e-4, shard, ef, recall), "beams")
    sent = graphs.select(
        "label", "dim", F.explode(F.sequence("shard", F.col("shards") - 1)).alias("to"), "shard",
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "copies", "x", "levels", "entry")],
    ).join(beams, ["label", "dim"])
    tiles = sent.join(graphs.drop("shards").withColumnRenamed("shard", "to"), ["label", "dim", "to"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column("dim")[i].as_py()
                ids, copies, x = _numbers(b, "ids", i), _numbers(b, "copies", i), _unit(_numbers(b, "x", i).reshape(-1, dim))
                q_ids, q_copies, q = _numbers(b, "q_ids", i), _numbers(b, "q_copies", i), _unit(_numbers(b, "q_x", i).reshape(-1, dim))
                g = _graph(b, i, "x", "levels", "entry", dim)
                beam = b.column("ef")[i].as_py()
                same = b.column("to")[i].as_py() == b.column("shard")[i].as_py()
                left, right = within(g, q.astype(np.float32), least - 1e-4, beam, recall=recall, same=same)
                if same:  # each pair once
                    lo, hi = np.minimum(left, right), np.maximum(left, right)
                    pair = np.unique((lo * len(ids) + hi)[lo < hi])
                elif 8 * beam >= len(ids):  # a scan has them all
                    pair = left * len(ids) + right
                else:
                    back, from_ = within(_graph(b, i, "q_x", "q_levels", "q_entry", dim), g.x, least - 1e-4, beam, recall=recall)
                    pair = np.unique(np.concatenate([left * len(ids) + right, from_ * len(ids) + back]))
                left, right = pair // len(ids), pair % len(ids)
                near = np.zeros(len(left), bool)
                for lo in range(0, len(left), 1 << 16):
                    s = slice(lo, lo + (1 << 16))
                    near[s] = np.einsum("ij,ij->i", q[left[s]], x[right[s]]) >= least
                left, right = left[near], right[near]
                here = np.bincount(left, weights=copies[right], minlength=len(q_ids))
                there = np.bincount(right, weights=q_copies[left], minlength=len(ids))
                a, c = _forest(q_ids[left], ids[right])
                vec = np.concatenate([q_ids[here > 0], ids[there > 0]])
                n = np.concatenate([here[here > 0], there[there > 0]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([vec, np.array(a, np.int64)])), pa.array([None] * len(vec) + c, pa.int64()), pa.array(np.concatenate([n, np.zeros(len(a), np.int64)]))],
                    names=["a", "b", "n"],
                )

    # A pair's cosine is symmetric, so the row of a link and its count agree.
    found = scratch.keep(tiles.mapInArrow(search, "a long, b long, n long"), "found")
    counted = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    comp = components(found.where("b IS NOT NULL").select("a", "b"), scratch)
    of = (
        nodes.join(counted, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
        .select("label", "dim", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("comp", "rep").alias("component_id"))
    )
    member = v.withColumn("dim", F.size("v")).join(of, ["label", "dim", "v"]).groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = own.select("vec_id").join(member, "vec_id", "left")
    comp_id = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"), (F.col("vec_id") == comp_id).alias("kept")
    )


def _numbers(b: pa.RecordBatch, c: str, i: int) -> np.ndarray:
    return b.column(c)[i].values.to_numpy(zero_copy_only=False)


def _graph(b: pa.RecordBatch, i: int, x: str, levels: str, entry: str, dim: int) -> Graph:
    g = Graph.__new__(Graph)
    g.x, g.entry = _unit(_numbers(b, x, i).reshape(-1, dim)).astype(np.float32), b.column(entry)[i].as_py()
    g.links = _levels(b.column(levels)[i].values)
    return g


def _levels(col: pa.Array) -> list[np.ndarray]:
    width, links = col.field("width").to_pylist(), col.field("links")
    return [np.array(links[k].values.to_numpy(), np.int32).reshape(-1, w) for k, w in enumerate(width)]
