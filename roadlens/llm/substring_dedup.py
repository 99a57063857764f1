"""Repeated passages, found in suffix trees that are dealt out by prefix.

Every place of a text where ``width`` words follow starts a suffix. Suffixes
are dealt to groups by a prefix of variable length: words are added to it
until the count that the words' own counts (over all documents) let expect is
one that fits in memory, so suffixes that begin with common words are split by
longer prefixes. A group's suffixes, sorted by the label of the path of
``width`` words, are the subtree below that prefix; an internal node so deep
has two leaves or more under it. The earliest leaf stays, every other one
marks its place, and runs of marked places are the maximal repeats.

Equal suffixes of one batch of texts are merged before the shuffle, so a
passage that any number of documents share gives a group one leaf a batch.
Labels are 64-bit hashes of the words in order; equal labels are taken for
equal words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm import text as T

WIDTH = 20
GROUP = 1 << 18  # suffixes that a prefix may stand for
BATCH = 12 << 20  # bytes of text handled at once
BUCKET = 1 << 20  # marked or unmarked places a bucket of documents may hold, about
_COUNTERS = 1 << 16
_NULL_ID = -(1 << 63)
_LEAF = (np.uint64, np.int64, np.int64, np.uint32)  # label, doc, tag, place
_MARK = (np.int64, np.int64, np.uint32)  # doc, tag, place


def repeated_places(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per repeated passage: ``doc`` (the id), ``first_word`` and
    ``n_words`` of every maximal run of words that a window of ``width`` words
    covers whose words also start earlier (smaller id, or same document).

    Rows that share an id are told apart by their text; equal rows count as
    one document. Null ids come first; null and empty texts hold no passage.
    """
    return _apply(docs, width, id_col, text_col, _spans, "doc long, first_word long, n_words long")


def without_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` (the id), ``n_words``, ``n_removed`` and ``kept_text``, the words left
    joined by one space, per row of ``docs``; rows as in :func:`repeated_places`."""
    return _apply(docs, width, id_col, text_col, _texts, "doc long, n_words long, n_removed long, kept_text string")


def dedup_digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of op13: ids, words, removed words and the digest of what is kept."""
    kept = without_repeats(docs, width)
    return kept.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def _apply(docs: DataFrame, width: int, id_col: str, text_col: str, out: Callable, schema: str) -> DataFrame:
    spark = docs.sparkSession
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))
    d = docs.select(ids.alias("doc"), F.col(id_col).isNull().alias("no_id"), F.col(text_col).alias("text"))
    # Only where ids repeat does the text have part in a document's name.
    shared = d.groupBy("doc").count().where("count > 1").limit(1).count() > 0
    d = d.withColumn("tag", F.coalesce(F.xxhash64("text"), F.lit(0)) if shared else F.lit(0).cast("long"))
    counts = _word_counts(d)
    total = int(counts.sum())
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(4 * least, -(-total // GROUP) // 4)
    buckets = max(least, -(-total // BUCKET))
    shared_counts = spark.sparkContext.broadcast(counts)

    leaves = d.select("doc", "tag", "text").mapInArrow(
        lambda batches: _leaves(batches, shared_counts.value, parts, width), "part int, leaf boolean, block binary"
    )
    by_part = leaves.repartition(max(least, parts // 4), "part").sortWithinPartitions("part")
    marks = by_part.mapInArrow(lambda batches: _subtrees(batches, buckets), "bucket int, block binary")
    texts = d.select(_bucket(buckets).alias("bucket"), "doc", "no_id", "tag", "text")
    sent = T.packed_texts(texts, ["bucket", "doc", "no_id", "tag"])
    both = sent.select("bucket", F.lit(1).alias("kind"), "doc", "no_id", "tag", F.col("packed").alias("block")).unionByName(
        marks.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    dealt = both.repartition(max(least, buckets // 4), "bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(lambda batches: _documents(batches, width, out), schema)


def _bucket(buckets: int):
    """The same number as :func:`_buckets`."""
    x = F.col("doc").bitwiseXOR(F.col("tag"))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 32))
    return F.pmod(x.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(buckets)).cast("int")


def _buckets(doc: np.ndarray, tag: np.ndarray, buckets: int) -> np.ndarray:
    x = doc ^ tag
    x ^= (x.view(np.uint64) >> np.uint64(32)).view(np.int64)
    return (x & 0x7FFFFFFF) % buckets


def _word_counts(d: DataFrame) -> np.ndarray:
    """How many words of all documents fall on each counter (a fixed number of them)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_COUNTERS, np.int64)
        for b in batches:
            for lo, hi in T.slices(b.column("text"), BATCH):
                words, _ = T.space_hashes(*T.utf8_column(b.column("text").slice(lo, hi - lo)), exact=True)
                seen += np.bincount(_counter(words), minlength=_COUNTERS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["at", "n"])

    out = np.zeros(_COUNTERS, np.int64)
    for r in d.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def _counter(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(_COUNTERS - 1)).astype(np.int64)


def _prefix_lengths(words: np.ndarray, starts: np.ndarray, counts: np.ndarray, parts: int, width: int) -> np.ndarray:
    """Words in the prefix that deals out each suffix."""
    total = max(1, int(counts.sum()))
    fits = min(GROUP, max(1, total // (8 * parts)))
    share = counts / total
    expect = counts[_counter(words[starts])].astype(float)
    length = np.ones(len(starts), np.int64)
    open_ = np.flatnonzero(expect > fits)
    for k in range(1, width):
        if not len(open_):
            break
        expect[open_] *= share[_counter(words[starts[open_] + k])]
        length[open_] += 1
        open_ = open_[expect[open_] > fits]
    return length


def _leaves(batches: Iterator[pa.RecordBatch], counts: np.ndarray, parts: int, width: int) -> Iterator[pa.RecordBatch]:
    """Packed leaves by part: the earliest of each label in a batch of texts;
    the others' places are sent along as marks."""
    for b in batches:
        col = b.column("text")
        docs = b.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
        tags = b.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in T.slices(col, BATCH):
            raw, offsets = T.utf8_column(col.slice(lo, hi - lo))
            words, at = T.space_hashes(raw, offsets, exact=True)
            first = np.searchsorted(at, offsets)  # each text's first word
            room = np.maximum(np.diff(first) - (width - 1), 0)
            if not room.sum():
                continue
            row = np.repeat(np.arange(len(room)), room)
            place = np.arange(len(row)) - np.repeat(np.cumsum(room) - room, room)
            starts = first[row] + place
            runs = T.RunHashes(words)
            prefix = _prefix_lengths(words, starts, counts, parts, width)
            part = (runs.of(starts, prefix) % np.uint64(parts)).astype(np.int32)
            label = runs.of(starts, width)
            doc, tag, place = docs[lo + row], tags[lo + row], place.astype(np.uint32)
            del words, at, starts, runs, prefix, row
            leaf, marked = _split(label, doc, tag, place)
            yield from _blocks(part[leaf], True, (label[leaf], doc[leaf], tag[leaf], place[leaf]))
            # Marks only pass through; any part will do.
            yield from _blocks(part[marked], False, (doc[marked], tag[marked], place[marked]))


def _split(label: np.ndarray, doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are the earliest leaf of their label, sorted by label, and
    those that another place comes before. Equal places are one."""
    order = np.argsort(label)
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = label[order[1:]] == label[order[:-1]]
    shared = same[1:] | same[:-1]
    alone, many = order[~shared], order[shared]
    many = many[np.lexsort((place[many], tag[many], doc[many], label[many]))]
    if not len(many):
        return order, many
    head = np.r_[True, label[many[1:]] != label[many[:-1]]]
    lead = many[head][np.cumsum(head) - 1]
    again = (doc[many] == doc[lead]) & (tag[many] == tag[lead]) & (place[many] == place[lead])
    first = np.concatenate((alone, many[head]))
    return first[np.argsort(label[first])], many[~again]


def _blocks(part: np.ndarray, leaf: bool, columns: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    order = np.argsort(part, kind="stable")
    part = part[order]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, int)
    blocks = [T.pack_columns(*[c[order[x:y]] for c in columns]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
    for at in range(0, len(blocks), 256):
        some = blocks[at : at + 256]
        keys = part[cut[at : at + len(some)]]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([leaf] * len(some)), pa.array(some, pa.binary())], names=["part", "leaf", "block"])


def _subtrees(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Marks of every group of a partition, one after the other; marks of many
    groups go into one block a bucket."""
    part, leaves, marks, held = None, [], [], 0
    for b in batches:
        blocks = b.column("block")
        for i, (at, leaf) in enumerate(zip(b.column("part").to_pylist(), b.column("leaf").to_pylist(), strict=True)):
            if at != part:
                held += _close(leaves, marks)
                part = at
                if held >= GROUP:
                    yield from _by_bucket(marks, buckets)
                    held = 0
            if leaf:
                leaves.append(T.unpack_columns(blocks[i].as_buffer(), *_LEAF))
            else:
                marks.append(T.unpack_columns(blocks[i].as_buffer(), *_MARK))
                held += len(marks[-1][0])
    _close(leaves, marks)
    yield from _by_bucket(marks, buckets)


def _close(leaves: list, marks: list) -> int:
    """Adds one group's marks: places that lie under a deep node of its
    subtree and aren't that node's earliest leaf."""
    if not leaves:
        return 0
    label, doc, tag, place = (np.concatenate(c) for c in zip(*leaves, strict=True))
    leaves.clear()
    _, marked = _split(label, doc, tag, place)
    marks.append([doc[marked], tag[marked], place[marked]])
    return len(marked)


def _by_bucket(marks: list, buckets: int) -> Iterator[pa.RecordBatch]:
    if not marks:
        return
    doc, tag, place = (np.concatenate(c) for c in zip(*marks, strict=True))
    marks.clear()
    bucket = _buckets(doc, tag, buckets).astype(np.int32)
    order = np.lexsort((place, tag, doc, bucket))
    bucket, doc, tag, place = bucket[order], doc[order], tag[order], place[order]
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, int)
    packed = [T.pack_columns(doc[x:y], tag[x:y], place[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]], pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "block"])


def _documents(batches: Iterator[pa.RecordBatch], width: int, out: Callable) -> Iterator[pa.RecordBatch]:
    """Each bucket's marks come before its texts, which stream past them."""
    bucket, blocks, marks = None, [], {}
    for b in batches:
        rows = zip(*[b.column(c).to_pylist() for c in ("bucket", "kind", "doc", "no_id", "tag")], strict=True)
        texts = b.column("block")
        found = []
        for i, (at, kind, doc, no_id, tag) in enumerate(rows):
            if at != bucket:
                bucket, blocks, marks = at, [], {}
            if kind == 0:
                blocks.append(T.unpack_columns(texts[i].as_buffer(), *_MARK))
                continue
            if blocks:
                marks, blocks = _by_document(blocks), []
            words = T.unzip(texts[i]).split()
            places = marks.get((doc, tag))
            found.append((None if no_id else doc, words, None if places is None else _covered(places, width, len(words))))
            if len(found) >= 500:
                yield out(found)
                found = []
        if found:
            yield out(found)


def _by_document(blocks: list[list[np.ndarray]]) -> dict[tuple[int, int], np.ndarray]:
    doc, tag, place = (np.concatenate(c) for c in zip(*blocks, strict=True))
    order = np.lexsort((tag, doc))
    doc, tag, place = doc[order], tag[order], place[order]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]), True])
    keys = zip(doc[cut[:-1]].tolist(), tag[cut[:-1]].tolist(), strict=True)
    return {k: place[x:y].astype(np.int64) for k, x, y in zip(keys, cut[:-1], cut[1:], strict=True)}


def _covered(places: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of a text's ``n`` words a marked window covers."""
    steps = np.bincount(places, minlength=n + 1) - np.bincount(places + width, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _texts(found: list) -> pa.RecordBatch:
    docs, n, gone, kept = [], [], [], []
    for doc, words, covered in found:
        docs.append(doc)
        n.append(len(words))
        left = words if covered is None else [words[i] for i in np.flatnonzero(~covered)]
        gone.append(len(words) - len(left))
        kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
    columns = [pa.array(docs, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc", "n_words", "n_removed", "kept_text"])


def _spans(found: list) -> pa.RecordBatch:
    docs, first, size = [], [], []
    for doc, _, covered in found:
        if covered is None:
            continue
        edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
        docs += [doc] * (len(edge) // 2)
        first += edge[::2].tolist()
        size += (edge[1::2] - edge[::2]).tolist()
    columns = [pa.array(docs, pa.int64()), pa.array(first, pa.int64()), pa.array(size, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["doc", "first_word", "n_words"])


def _sql(width: int) -> str:
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
s AS (
  SELECT doc_id, n, p, md5(string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {width - 1} FOLLOWING)) AS k
  FROM words
),
k AS (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM s WHERE p + {width - 1} <= n),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {width})) AS p FROM k WHERE r > 1),
kept AS (
  SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p WHERE gone.p IS NULL GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


OP13_SQL = _sql(WIDTH)
