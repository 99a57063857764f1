"""Toxicity scores from the nearest labelled examples.

Examples and queries are TF-IDF vectors over all their words; words that are
commoner with label 1 weigh more. The nearest examples by exact cosine are
found with a block-max inverted index and vote by distance; the votes are
calibrated on the examples.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import release
from roadlens.llm.text import plain_hashes, utf8

# Bound of what is learnt from: examples of each label.
MAX_EXAMPLES = 6000
# A word of this z-score for label 1 or less has its TF-IDF weight; one above
# it has that times the square of their ratio.
PLAIN_Z = 4.0
NEIGHBOURS = 15
PRIOR_VOTES = 0.25
BLOCK = 32
COMMON = 1024  # commonest terms, scored as a matrix
QUERIES = 128  # texts that are scored at a time
POSTINGS = 1 << 18  # places of rare terms that are added up at a time
THRESHOLD = 0.7
EVIDENCE = 3
KNOWN = 1 << 14  # texts whose scores a task remembers
ROUNDS = (4, 32)  # blocks of the highest bounds that are completed before the k-th best is taken again
_UNIT = 65535  # weights of common terms are stored as integers of so many parts
_SLACK = 1e-3  # sums of these and of single precision are nearer to the cosine
_NONE = -4.0  # score of what is no example


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


@dataclass
class Rows:
    """Sparse vectors: row i has ``term`` and ``weight`` from start[i] to start[i + 1]."""

    start: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, vectors: Sequence[dict[int, float]]) -> Rows:
        start = np.cumsum([0, *map(len, vectors)])
        return cls(start, np.array([t for v in vectors for t in v], np.int64), np.array([w for v in vectors for w in v.values()], np.float64))

    def __len__(self) -> int:
        return len(self.start) - 1

    def picked(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.start)[rows]
        at = _ranges(self.start[rows], size)
        return Rows(np.concatenate(([0], np.cumsum(size))), self.term[at], self.weight[at])


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i] .. first[i] + size[i] - 1 for every i, one after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(size) else 0) + np.repeat(first - (ends - size), size)


class BlockMaxIndex:
    """Block-max inverted index over example vectors in blocks of neighbours
    in order. ``tops`` gives the exact k largest cosines of several queries.

    The lists of rare terms are short and are added up whole. Of the commonest
    terms, whose lists hold much of all examples, the largest weight in every
    block is stored: with the best sum of rare terms in it that bounds a block.
    Blocks are completed from the highest bound down, in rounds, and those
    whose bound is below the k-th best score so far are skipped. What reaches
    the k-th best score, up to the rounding, is scored anew in double precision."""

    def __init__(self, vectors: Sequence[dict[int, float]] | Rows, ids: Sequence[int], block: int = BLOCK, common: int = COMMON):
        rows = vectors if isinstance(vectors, Rows) else Rows.of(vectors)
        n = len(rows)
        size = np.diff(rows.start)
        # In the order of each example's heaviest term.
        owner = np.repeat(np.arange(n), size)
        heaviest = np.full(n, -1, np.int64)
        o = np.argsort(rows.weight, kind="stable")
        heaviest[owner[o]] = rows.term[o]
        self.order = np.lexsort((np.asarray(ids, np.int64), heaviest))
        self.ids = np.asarray(ids, np.int64)[self.order]
        self.rows = rows.picked(self.order)
        self.block, self.common = block, common
        self.n_blocks = -(-n // block)
        self.width = int(rows.term.max(initial=-1)) + 1
        self.offered = self.completed = 0  # blocks of all queries so far, and those not skipped
        self._lists: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_lists": None}

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of each common term (-1: rare), per block their weights and
        their largest weights, and the lists of the rare terms: starts, places
        and weights. Made once per process, in steps of some examples."""
        if self._lists is None:
            r, n = self.rows, len(self.rows)
            held = np.bincount(r.term, minlength=self.width)
            top = np.argsort(-held, kind="stable")[: self.common]
            top = top[held[top] > max(32, n // 64)]
            number = np.full(self.width, -1, np.int32)
            number[top] = np.arange(len(top))
            cells = np.zeros((self.n_blocks, len(top), self.block), np.uint16)
            most = np.zeros((len(top), self.n_blocks), np.float32)
            starts = np.concatenate(([0], np.cumsum(np.where(number < 0, held, 0))))
            place = np.empty(starts[-1], np.int32)
            weight = np.empty(starts[-1], np.float32)
            free = starts[:-1].copy()
            for lo in range(0, self.n_blocks, 8):
                some = np.arange(lo * self.block, min(n, (lo + 8) * self.block))
                at = slice(r.start[some[0]], r.start[some[-1] + 1])
                own = np.repeat(some.astype(np.int32), np.diff(r.start)[some])
                t, w = r.term[at], r.weight[at]
                c = number[t]
                often = c >= 0
                cells[own[often] // self.block, c[often], own[often] % self.block] = np.rint(w[often] * _UNIT)
                np.maximum.at(most, (c[often], own[often] // self.block), w[often].astype(np.float32))
                o = np.flatnonzero(~often)
                o = o[np.argsort(t[o], kind="stable")]
                rare, n_of = np.unique(t[o], return_counts=True)
                to = _ranges(free[rare], n_of)
                place[to], weight[to] = own[o], w[o]
                free[rare] += n_of
            self._lists = number, cells, most, starts, place, weight
            release()
        return self._lists

    def _rare(self, t: np.ndarray, w: np.ndarray, row: np.ndarray, n_queries: int) -> np.ndarray:
        """Sums of the rare terms for all queries and examples, of as many
        queries at a time as have POSTINGS in all."""
        _, _, _, starts, place, weight = self.lists()
        n = self.n_blocks * self.block
        score = np.zeros((n_queries, n), np.float32)
        size = starts[t + 1] - starts[t]
        run = np.searchsorted(row, np.arange(n_queries + 1))
        before = np.concatenate(([0], np.cumsum(size)))[run]
        lo = 0
        while lo < n_queries:
            hi = min(n_queries, max(lo + 1, int(np.searchsorted(before, before[lo] + POSTINGS, "right")) - 1))
            s = slice(run[lo], run[hi])
            at = _ranges(starts[t[s]], size[s])
            cell = np.repeat((row[s] - lo) * n, size[s]) + place[at]
            score[lo:hi] = np.bincount(cell, np.repeat(w[s], size[s]) * weight[at], (hi - lo) * n).reshape(-1, n)
            lo = hi
        score[:, len(self.rows) :] = _NONE
        return score

    def _scores(self, q: Rows, k: int, but: Sequence[int | None] | None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines, up to the slack, of the examples in all blocks that were
        not skipped, and what each query's k-th best one is no less than."""
        number, cells, most, *_ = self.lists()
        row = np.repeat(np.arange(len(q)), np.diff(q.start))
        of = number[q.term]
        often = of >= 0
        dense = np.zeros((len(q), cells.shape[1]), np.float32)
        dense[row[often], of[often]] = q.weight[often]
        rare = self._rare(q.term[~often], q.weight[~often], row[~often], len(q)).reshape(len(q), self.n_blocks, self.block)
        for i, b in enumerate(but or ()):
            if b is not None:
                rare.reshape(len(q), -1)[i, : len(self.ids)][self.ids == b] = _NONE
        scaled = dense / np.float32(_UNIT)
        bound = dense @ most
        bound += rare.max(axis=2)
        score = np.full(rare.shape, _NONE, np.float32)
        kth = np.zeros(len(q), np.float32)
        left = bound > 0  # a block of bound 0 holds no neighbour
        self.offered += left.size
        rank = np.empty(bound.shape, np.int32)
        rank[np.arange(len(q))[:, None], np.argsort(-bound, axis=1)] = np.arange(self.n_blocks)
        done = 0
        for upto in (*ROUNDS, self.n_blocks):
            now = left & (rank >= done) & (rank < upto) & (bound >= (kth - _SLACK)[:, None])
            for b in np.flatnonzero(now.any(axis=0)).tolist():
                i = np.flatnonzero(now[:, b])
                score[i, b] = rare[i, b] + scaled[i] @ cells[b].astype(np.float32)
            self.completed += int(now.sum())
            done = upto
            if self.n_blocks >= k:
                # The k-th largest of the blocks' best is no more than the k-th best.
                best = np.partition(score.max(axis=2), self.n_blocks - k, axis=1)[:, self.n_blocks - k]
                kth = np.maximum(kth, best)
            if done >= self.n_blocks:
                break
        return score.reshape(len(q), -1), kth

    def tops(self, q: Rows, k: int, but: Sequence[int | None] | None = None) -> list[list[tuple[float, int, int]]]:
        """For each query (cosine, id, index of the example) of the k nearest,
        ties to the smaller id; examples of cosine 0 are no neighbours; those
        with the id ``but`` are left out. Terms of no example are left out of
        ``q`` by the caller."""
        if not len(self.rows):
            return [[] for _ in range(len(q))]
        out = []
        dense = np.zeros(self.width)
        for lo in range(0, len(q), QUERIES):
            part = q.picked(np.arange(lo, min(len(q), lo + QUERIES)))
            scores, kth = self._scores(part, k, but[lo : lo + QUERIES] if but is not None else None)
            for i, score in enumerate(scores):
                found = np.flatnonzero(score >= kth[i] - _SLACK)
                if len(found) > k:
                    s = score[found]
                    found = found[s >= np.partition(s, len(s) - k)[len(s) - k] - 2 * _SLACK]
                own = slice(part.start[i], part.start[i + 1])
                dense[part.term[own]] = part.weight[own]
                near = self.rows.picked(found)
                exact = np.round(_sums(dense[near.term] * near.weight, near.start), 12)
                dense[part.term[own]] = 0.0
                best = np.lexsort((self.ids[found], -exact))[:k]
                out.append([(float(exact[j]), int(self.ids[found[j]]), int(self.order[found[j]])) for j in best if exact[j] > 0])
        return out

    def top(self, q: dict[int, float], k: int, but: int | None = None) -> list[tuple[float, int, int]]:
        return self.tops(Rows.of([{t: w for t, w in q.items() if t < self.width}]), k, [but])[0]


def _sums(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``x``, which are not empty."""
    return np.add.reduceat(x, start[:-1]) if len(start) > 1 else np.empty(0)


@dataclass
class ToxicModel:
    words: np.ndarray  # hashes of the examples' words, sorted
    idf: np.ndarray  # weight of each, and, last, of a word that no example has
    index: BlockMaxIndex
    labels: list[int]
    prior: float  # share of label 1 among all labelled rows
    votes: tuple[np.ndarray, np.ndarray]  # calibration: raw vote -> score
    blank: float  # score of a text without words
    k: int = NEIGHBOURS

    def vectors(self, counts: Rows) -> Rows:
        """Unit vectors of word counts (``term``: hashes). Words of no example
        have part in the length alone."""
        at = np.searchsorted(self.words, counts.term)
        at[at == len(self.words)] = 0
        known = self.words[at] == counts.term if len(self.words) else np.zeros(len(at), bool)
        weight = (1.0 + np.log(counts.weight)) * self.idf[np.where(known, at, len(self.words))]
        size = np.diff(counts.start)
        row = np.repeat(np.arange(len(size), dtype=np.int32), size)
        norm = np.sqrt(np.bincount(row, weight * weight, len(size)))
        kept = np.bincount(row[known], minlength=len(size))
        return Rows(np.concatenate(([0], np.cumsum(kept))), at[known].astype(np.int32), (weight / norm[row])[known])

    def nearest(self, v: Rows, but: Sequence[int | None] | None = None) -> tuple[np.ndarray, list[list[tuple[float, int, int]]]]:
        """Distance-weighted shares of label 1 among the neighbours, drawn to
        the prior when they are few or far. Copies of an example are examples
        of their own, so each has its vote."""
        found = self.index.tops(v, self.k, but)
        raw = np.empty(len(found))
        for i, near in enumerate(found):
            w = [1.0 / (1.0 - min(c, 1.0) + 0.05) for c, _, _ in near]
            on = sum(x for x, (_, _, n) in zip(w, near, strict=True) if self.labels[n])
            raw[i] = (on + PRIOR_VOTES * self.prior) / (sum(w) + PRIOR_VOTES)
        return raw, found

    def scores(self, col: pa.Array) -> tuple[np.ndarray, list[list[tuple[float, int, int]]]]:
        """Scores of a text column and the neighbours that voted."""
        if not len(self.labels):
            return np.full(len(col), self.blank), [[]] * len(col)
        counts = word_counts(col)
        raw, near = self.nearest(self.vectors(counts))
        return np.where(np.diff(counts.start) > 0, np.interp(raw, *self.votes), self.blank), near


def unit(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    v = {t: (1.0 + math.log(n)) * float(idf[t]) for t, n in counts.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {t: x / norm for t, x in v.items()} if norm else {}


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted rising means of y over x (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of w*y, sum of w, smallest x, largest x
    for i in order.tolist():
        pools.append([w[i] * y[i], w[i], x[i], x[i]])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            a, b, _, hi = pools.pop()
            pools[-1][0] += a
            pools[-1][1] += b
            pools[-1][3] = hi
    xs, ys = [], []
    for a, b, lo, hi in pools:
        xs += [lo, hi]
        ys += [a / b, a / b]
    return np.array(xs), np.array(ys)


def word_counts(col: pa.Array) -> Rows:
    """The distinct words of each text, by rising hash, with their counts."""
    hashes, row = plain_hashes(col)
    o = np.lexsort((hashes, row))
    hashes, row = hashes[o], row[o]
    first = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])))) if len(row) else np.empty(0, np.int64)
    n = np.diff(np.append(first, len(row)))
    return Rows(np.searchsorted(row[first], np.arange(len(col) + 1)), hashes[first], n.astype(np.float64))


def _example_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, text) -> the hashes and counts of each text's words."""
    for b in batches:
        c = word_counts(b.column("text"))
        words = pa.array([c.term[x:y].tobytes() for x, y in zip(c.start[:-1], c.start[1:])], pa.binary())
        n = pa.array([c.weight[x:y].astype(np.int32).tobytes() for x, y in zip(c.start[:-1], c.start[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), words, n], names=["doc_id", "toxic", "words", "n"])


def examples(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
    """(doc_id, toxic, text) of at most ``most`` labelled rows of each label
    that are not held out, the first by a hash of the id; labelled rows by
    label; examples by label. A document with several labels takes the
    smallest, one with several texts the first in order."""
    l = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"))
    )
    there = {r["toxic"]: r["n"] for r in l.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    some = [l.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v in (0, 1)]
    picked = F.broadcast(some[0].union(some[1]))  # at most 2 * most short rows
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(picked, "doc_id").distinct()
    n = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    return text.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), there, n


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_EXAMPLES, plain_z: float = PLAIN_Z, k: int = NEIGHBOURS) -> ToxicModel:
    """Learns from a bounded sample of labelled rows: every example of it is
    in the index, with all its words. Their document frequencies are counted
    over all documents. Without examples of both labels every text gets the
    prior."""
    sample, there, n = examples(docs, labels, most)
    n0, n1 = n.get(0, 0), n.get(1, 0)
    prior = there.get(1, 0) / max(1, sum(there.values()))
    none = (np.array([0.0]), np.array([0.0]))
    model = ToxicModel(np.empty(0, np.uint64), np.ones(1), BlockMaxIndex([], []), [], prior, none, prior, k)
    if not n0 or not n1:
        return model
    # At most 2 * most rows: the words of the examples, 12 bytes each.
    got = sample.mapInArrow(_example_words, "doc_id long, toxic int, words binary, n binary").toArrow().combine_chunks()
    got = got.filter(pc.greater(pc.binary_length(got["words"]), 0)).combine_chunks()
    if not got.num_rows:
        return model
    by_id = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    ids, y = got["doc_id"].to_numpy()[by_id], got["toxic"].to_numpy()[by_id].astype(np.int64)
    # Copies of a text are found by their cosine; in the evidence of its
    # words they count once.
    names = [(xxhash.xxh3_128_digest(w.as_buffer()), xxhash.xxh3_128_digest(c.as_buffer())) for w, c in zip(got["words"], got["n"], strict=True)]
    first = {(names[i], t): at for at, (i, t) in enumerate(zip(by_id.tolist(), y.tolist(), strict=True))}
    once = np.isin(np.arange(len(y)), list(first.values()))
    counts = Rows(np.cumsum([0, *(pc.binary_length(got["words"]).to_numpy() // 8)]), _flat(got["words"], np.uint64), _flat(got["n"], np.int32)).picked(by_id)
    del got, names, first
    size = np.diff(counts.start)
    model.words = np.unique(counts.term)
    term = np.searchsorted(model.words, counts.term).astype(np.int32)
    m1, m0 = max(1, int(y[once].sum())), max(1, int((1 - y[once]).sum()))
    a, b = (np.bincount(term[np.repeat(once & (y == v), size)], minlength=len(model.words)) for v in (1, 0))
    del term
    p = (a + b) / (m0 + m1)
    z = (a / m1 - b / m0) / np.sqrt(np.maximum(p, 1e-12) * (1.0001 - p) * (1.0 / m0 + 1.0 / m1))
    model.idf = _idf(docs, model.words)
    model.idf[:-1] *= np.maximum(1.0, z / plain_z) ** 2
    model.index = BlockMaxIndex(model.vectors(counts), ids)
    del counts
    model.labels = y.tolist()
    # Each sampled example stands for as many labelled rows of its label.
    weight = {0: there[0] / n0, 1: there[1] / n1}
    blank1 = (n1 - int(y.sum())) * weight[1]
    blank0 = (n0 - (len(y) - int(y.sum()))) * weight[0]
    model.blank = (blank1 + prior) / (blank0 + blank1 + 1.0)
    raw = _own_votes(docs, model)
    xs, ys = isotonic(raw, y.astype(float), np.array([weight[t] for t in model.labels]))
    model.votes = (xs, np.clip(ys, 0.0, 1.0))
    return model


def _flat(col: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of a column of packed arrays, one after the other."""
    return np.concatenate([np.frombuffer(memoryview(v)[int(o[0]) : int(o[-1])], kind) for v, o in map(_binary, col.chunks)])


def _binary(col: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    wide = pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    return data, np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1]


def _own_votes(docs: DataFrame, model: ToxicModel) -> np.ndarray:
    """The vote of each example's neighbours, itself left out."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.index
        for b in batches:
            at = b.column("id").to_numpy()
            raw, _ = shared.value.nearest(index.rows.picked(at), index.ids[at].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(index.order[at]), pa.array(raw)], names=["id", "raw"])
        release()

    got = spark.range(len(model.labels)).mapInArrow(run, "id long, raw double").toArrow()
    raw = np.empty(len(model.labels))
    raw[got["id"].to_numpy()] = got["raw"].to_numpy()
    return raw


def _idf(docs: DataFrame, words: np.ndarray) -> np.ndarray:
    """log((1 + N) / (1 + df)) + 1 over all documents, and last that of df = 1:
    each task counts the words in its texts and sends one short row for each
    it met."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        df = np.zeros(len(w) + 1, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.column("text").slice(lo, 1000)
                term = word_counts(part).term
                at = np.searchsorted(w, term)
                at[at == len(w)] = 0
                df[:-1] += np.bincount(at[w[at] == term], minlength=len(w))
                df[-1] += len(part)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])
        release()

    rows = docs.select("text").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(words) + 1)
    df[rows["term"].to_numpy()] = rows["df"].to_numpy()
    total, df[-1] = df[-1], 1.0
    return np.log((1.0 + total) / (1.0 + df)) + 1.0


def _scored(m: ToxicModel, col: pa.Array, known: dict[bytes, tuple[float, list[dict] | None]], evidence: bool = True) -> list[tuple[float, list[dict] | None]]:
    """(score, evidence) of each text, the latter only if asked for. Equal
    texts are searched once per task."""
    keys = [xxhash.xxh3_128_digest(utf8(t)) for t in col.to_pylist()]
    if len(known) >= KNOWN:
        known.clear()
    new = list({key: i for i, key in enumerate(keys) if key not in known}.items())
    if new:
        s, near = m.scores(col.take(pa.array([i for _, i in new])))
        for (key, _), x, found in zip(new, s.tolist(), near, strict=True):
            known[key] = x, None if not evidence else [{"doc_id": i, "cosine": c, "toxic": m.labels[n]} for c, i, n in found[:EVIDENCE]]
    return [known[key] for key in keys]


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row: ``doc_id, held_out, score,
    predicted, evidence`` (the nearest examples that voted: id, cosine, label).

    The score depends on the text alone. Empty and null texts and texts
    without words get the share of label 1 among such examples; null and
    repeated ids pass through; no rows give no rows; other columns are
    ignored. One scan, no shuffle; the broadcast model is bounded by the
    sample of :func:`fit`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, list[dict]]] = {}
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for whole in batches:
            for lo in range(0, whole.num_rows, QUERIES):
                b = whole.slice(lo, QUERIES)
                s, e = zip(*_scored(shared.value, b.column("text"), known), strict=True)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64()), pa.array(e, kind)], names=["doc_id", "score", "evidence"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>"
    )
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence"
    )


def reject(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, columns unchanged.
    Null, empty and repeated rows as in :func:`score`. Only the texts go to
    the Python workers, and one number a row comes back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[bytes, tuple[float, list[dict] | None]] = {}
        for col in texts:
            found: list[float] = []
            for lo in range(0, len(col), QUERIES):
                found += [s for s, _ in _scored(shared.value, col.slice(lo, QUERIES), known, evidence=False)]
            yield pa.array(found, pa.float64())
        release()

    return docs.where(scores(F.col("text")) < threshold)
