"""Ranked lexical search over K2-treaps of the term-document grid.

The grid's rows are terms, its columns documents, its cells impacts (what a
term adds to a document's score). :func:`build_index` writes the grid of all
documents in blocks of columns. A search weighs a set of items' terms over the
whole grid, folds each block's cells of those terms into a quadtree whose
cells hold the greatest impact under them (empty ones aren't stored), and goes
down the row paths of an item's terms together, best range of documents first,
until no range can reach the item's k-th best score.

Terms are 64-bit hashes of runs of 0-9, a-z (A-Z lower-cased) and all non-ASCII
characters; equal hashes are taken for equal terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm import text as T
from roadlens.llm.common import Scratch

K = 50
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 1 << 14
ITEM_TERMS = 1 << 18  # terms of the items that are searched at once
_STEP = 256  # ranges opened at once
_OPEN = 1 << 21  # nodes of open ranges that an item may hold before it goes deep first
_POP = np.array([bin(x).count("1") for x in range(16)], np.int64)


@dataclass(frozen=True)
class Index:
    """``grid``: one row per block of documents; ``docs`` and ``terms`` count
    the documents that hold a term and all their terms."""

    grid: DataFrame
    docs: int
    terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The grid of all rows of ``docs``, written to the shared folder. Every
    row is a document of its own, also where ids repeat or are null; texts
    that are null or hold no term have no column."""
    grid = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _blocks, "n_docs long, n_terms long, columns binary, terms binary, cells binary"
    )
    grid = Scratch(docs.sparkSession, "grid").keep(grid, "grid")
    n = grid.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return Index(grid, n[0] or 0, n[1] or 0)


def search(index: Index, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Each item's ``k`` documents of the highest score above 0, equal scores
    by ascending id (null last): ``item_id, rank, doc_id, score``. Rows that
    share an item's id are one item with the terms of all; items without
    terms find nothing. Items are searched some :data:`ITEM_TERMS` terms at a
    time, each time over the whole grid."""
    found = None
    for some in _item_blocks(items, id_col, text_col):
        part = _search_some(index, some, k, items.schema[id_col].dataType.simpleString())
        found = part if found is None else found.unionByName(part)
    if found is None:
        return items.sparkSession.createDataFrame([], f"item_id {items.schema[id_col].dataType.simpleString()}, rank int, doc_id long, score long")
    return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in T.slices(b.column("text"), BLOCK_BYTES):
            for at in range(lo, hi, BLOCK_DOCS):
                n = min(BLOCK_DOCS, hi - at)
                block = _block(b.column("id").slice(at, n), b.column("text").slice(at, n))
                if block is not None:
                    yield block


def _block(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch | None:
    terms, rows = T.plain_hashes(texts)
    if not len(terms):
        return None
    size = np.bincount(rows, minlength=len(texts))
    full = np.flatnonzero(size)
    column = np.cumsum(size > 0) - 1
    order = np.argsort(terms, kind="stable")
    terms, rows = terms[order], column[rows[order]]
    new_term = np.r_[True, terms[1:] != terms[:-1]]
    new_cell = new_term | np.r_[True, rows[1:] != rows[:-1]]
    cell = np.flatnonzero(new_cell)
    times = np.diff(np.r_[cell, len(terms)]).astype(np.uint32)
    head = np.flatnonzero(new_term[cell])
    held = np.diff(np.r_[head, len(cell)]).astype(np.uint32)
    no_id = ids.is_null().to_numpy(zero_copy_only=False)[full].astype(np.uint8)
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[full]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([len(full)], pa.int64()),
            pa.array([int(size.sum())], pa.int64()),
            pa.array([T.pack_columns(known, no_id, size[full].astype(np.int64))], pa.binary()),
            pa.array([T.pack_columns(terms[cell[head]], held)], pa.binary()),
            pa.array([T.pack_columns(rows[cell].astype(np.uint32), times)], pa.binary()),
        ],
        names=["n_docs", "n_terms", "columns", "terms", "cells"],
    )


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, np.ndarray]]]:
    """Items as (id, sorted distinct terms), in lists of bounded size."""
    kind = items.schema[id_col].dataType.simpleString()

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, rows = T.plain_hashes(b.column("text"))
            cut = np.searchsorted(rows, np.arange(b.num_rows + 1))
            own = [np.unique(found[x:y]).view(np.int64) for x, y in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(own, pa.list_(pa.int64()))], names=["item_id", "terms"])

    d = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).mapInArrow(terms, f"item_id {kind}, terms array<long>")
    d = d.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).where(F.size("terms") > 0)
    some, held = [], 0
    for r in d.toLocalIterator():
        some.append((r["item_id"], np.sort(np.array(r["terms"], np.int64).view(np.uint64))))
        held += len(r["terms"])
        if held >= ITEM_TERMS:
            yield some
            some, held = [], 0
    if some:
        yield some


def _search_some(index: Index, items: list[tuple[object, np.ndarray]], k: int, kind: str) -> DataFrame:
    spark = index.grid.sparkSession
    terms = np.unique(np.concatenate([t for _, t in items]))
    weights = _weights(index, terms)
    rows = [np.searchsorted(terms, t) for _, t in items]
    sent = spark.sparkContext.broadcast((terms, weights, rows))
    docs, total = index.docs, index.terms

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in sent.value[2]]
        for b in batches:
            for i in range(b.num_rows):
                _search_block(*[b.column(c)[i].as_buffer() for c in ("columns", "terms", "cells")], *sent.value, docs, total, best)
        for at in range(0, len(best), 256):
            part = [x.rows() for x in best[at : at + 256]]
            item = np.repeat(np.arange(at, at + len(part)), [len(p[0]) for p in part])
            score, doc, none = (np.concatenate(c) for c in zip(*part, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=none.astype(bool)), pa.array(score)], names=["item", "doc_id", "score"])

    hits = index.grid.select("columns", "terms", "cells").mapInArrow(find, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(items)], f"item long, item_id {kind}")
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _weights(index: Index, terms: np.ndarray) -> np.ndarray:
    """Each term's weight from the number of documents of the grid that hold it."""
    sent = index.grid.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(sent.value), np.int64)
        for b in batches:
            for x in b.column("terms"):
                here, held = T.unpack_columns(x.as_buffer(), np.uint64, np.uint32)
                at, of = _meet(sent.value, here)
                n[at] += held[of]
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["term", "n"])

    out = np.zeros(len(terms), np.int64)
    for r in index.grid.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = math.floor(1000 * math.log((2 * index.docs + 2) / (2 * r["n"] + 1)))
    return out


def _meet(wanted: np.ndarray, here: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both sorted arrays of what both hold."""
    of = np.minimum(np.searchsorted(here, wanted), len(here) - 1)
    at = np.flatnonzero(here[of] == wanted)
    return at, of[at]


def _search_block(columns, terms, cells, wanted: np.ndarray, weights: np.ndarray, items: list[np.ndarray], docs: int, total: int, best: list[Best]) -> None:
    ids, none, size = T.unpack_columns(columns, np.int64, np.uint8, np.int64)
    here, held = T.unpack_columns(terms, np.uint64, np.uint32)
    at, of = _meet(wanted, here)
    if not len(at):
        return
    end = np.cumsum(held.astype(np.int64))
    row = np.repeat(np.arange(len(at)), held[of])
    cell = np.concatenate([np.arange(end[x] - held[x], end[x]) for x in of])
    column, times = T.unpack_columns(cells, np.uint32, np.uint32)
    column, times = column[cell].astype(np.int64), times[cell].astype(np.int64)
    m = 50 + (50 * size * docs) // total
    impact = weights[at][row] * ((1_000_000_000 * times) // (1000 * times + 20 * m[column]))
    tree = K2Treap(row, column, impact)
    own = np.full(len(wanted), -1)
    own[at] = np.arange(len(at))
    for rows, b in zip(items, best, strict=True):
        r = own[rows]
        r = r[r >= 0]
        if len(r):
            tree.search(r, ids, none, b)


class Best:
    """The ``k`` best documents of an item: highest score, then smallest id."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.empty(0, np.int64)
        self.doc = np.empty(0, np.int64)
        self.none = np.empty(0, np.uint8)

    def least(self) -> int:
        """A range whose bound is smaller has no part in the result."""
        return int(self.score[-1]) if len(self.score) >= self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        score, doc, none = (np.concatenate(c) for c in ((self.score, score), (self.doc, doc), (self.none, none)))
        order = np.lexsort((doc, none, -score))[: self.k]
        self.score, self.doc, self.none = score[order], doc[order], none[order]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.score, self.doc, self.none


class K2Treap:
    """Quadtree over the cells of a grid. Nodes of all levels lie in one
    array, level by level: ``mask`` says which of a node's four quadrants are
    not empty, ``first`` where the first of these is, ``top`` holds the
    greatest value under the node. Node 0 stands for everything empty."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.levels = max(1, int(max(row.max(), column.max())).bit_length())
        code = np.zeros(len(row), np.int64)
        for bit in range(self.levels):
            code |= (((row >> bit) & 1) << (2 * bit + 1)) | (((column >> bit) & 1) << (2 * bit))
        order = np.argsort(code)
        code, top = code[order], value[order]
        layers = [(code, np.zeros(len(code), np.uint8), top)]
        for _ in range(self.levels):
            parent = code >> 2
            head = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            mask = np.bitwise_or.reduceat((1 << (code & 3)).astype(np.uint8), head)
            code, top = parent[head], np.maximum.reduceat(top, head)
            layers.append((code, mask, top))
        layers.reverse()
        self.mask = np.concatenate([[np.uint8(0)], *[x[1] for x in layers]]).astype(np.int64)
        self.top = np.concatenate([[0], *[x[2] for x in layers]])
        # Children follow each other in the order of their parents.
        self.first = 2 + np.cumsum(_POP[self.mask]) - _POP[self.mask]

    def search(self, rows: np.ndarray, ids: np.ndarray, none: np.ndarray, best: Best) -> None:
        """Adds the best documents for the terms of ``rows`` to ``best``."""
        bits = (rows[None, :] >> np.arange(self.levels - 1, -1, -1)[:, None]) & 1
        node = np.ones((1, len(rows)), np.int64)
        level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = np.array([self.top[1] * len(rows)])
        step = max(1, min(_STEP, _OPEN // len(rows)))
        while len(bound):
            if len(bound) > step:
                deep_first = len(bound) * len(rows) > _OPEN
                order = np.argpartition(-level if deep_first else -bound, step)
                now, later = order[:step], order[step:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            mask, first = self.mask[node[now]], self.first[node[now]]
            halves = []
            for side in (0, 1):
                quadrant = 2 * bits[level[now]] + side
                child = np.where((mask >> quadrant) & 1, first + _POP[mask & ((1 << quadrant) - 1)], 0)
                halves.append((child, level[now] + 1, 2 * column[now] + side, self.top[child].sum(axis=1)))
            child, deep, range_, most = (np.concatenate(c) for c in zip(*halves, strict=True))
            keep = most >= best.least()
            leaf = keep & (deep == self.levels)
            if leaf.any():
                at = range_[leaf]
                best.add(most[leaf], ids[at], none[at])
            inner = keep & ~leaf
            node, level = np.concatenate((node[later], child[inner])), np.concatenate((level[later], deep[inner]))
            column, bound = np.concatenate((column[later], range_[inner])), np.concatenate((bound[later], most[inner]))
            keep = bound >= best.least()
            if not keep.all():
                node, level, column, bound = node[keep], level[keep], column[keep], bound[keep]


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
),
d AS (SELECT doc_id, w, len(w) AS n FROM t WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, sum(n) AS terms FROM d),
c AS (SELECT doc_id, n, x, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS x FROM d) GROUP BY 1, 2, 3),
f AS (SELECT x, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM c, total GROUP BY x, docs),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM benchmark
),
s AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * docs) // terms))))) AS BIGINT) AS score
  FROM i JOIN c USING (x) JOIN f USING (x), total GROUP BY 1, 2
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
