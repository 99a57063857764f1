"""N-gram Jaccard join of whole documents by vertical partitioning.

All n-grams have one global order: rare ones first, then the corpus's most
frequent ones by rising count, ties by hash. Pivots cut that order into
fragments. A document's set falls into one segment per fragment; overlaps of a
pair are counted fragment by fragment, a row each, and summed per pair.

Pairs to count come from the start of the order: two sets with Jaccard
similarity of at least t share an n-gram among the first n - ceil(t n) + 1 of
each. Equal sets are one class throughout, and pairs that are already linked
through others are not counted at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import Scratch, components, release, unused
from roadlens.llm.prefix import COUNTED, PACKED, PER_PART, Counter, Frequent, common, lists, most_frequent, pack, possible, prefix_size, salts
from roadlens.llm.sieve import key, sieve
from roadlens.llm.text import packed_texts, set_key, shingle_sets, unpacked

WIDTH = 5
SIMILAR = (4, 5)  # Jaccard threshold as a fraction
HEAVY = 1 << 18  # frequent n-grams whose counts order the rest; a fixed bound
FRAGMENTS = 4  # fragments of the global order that overlaps are counted in
PER_COUNTER = 750_000  # n-grams that one counting task holds
HOT_LIST = 20_000  # documents of one n-gram that one task links
TOGETHER = 200  # pairs whose texts are cut at a time
_SETS, _POSTINGS = 2_500, 400_000  # sets, and postings, that are packed at a time


class Order(Frequent):
    """The global order: rare n-grams by hash, then the frequent ones by count."""

    def segments(self, grams: np.ndarray, fragments: int) -> Iterator[tuple[int, np.ndarray]]:
        """Sorted grams by fragment. Rare grams, nearly all of any corpus, are
        cut by hash; the frequent ones are the last fragment."""
        rare = self.counts(grams) == 0
        last = fragments - 1
        part = np.where(rare, (grams >> np.uint64(40)).astype(np.int64) % max(1, last), last)
        for f in np.unique(part).tolist():
            yield f, grams[part == f]


def _classes(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, th, n, k1, k2): text hash, set size and 128-bit name of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            named = [(len(s), *set_key(s)) for s in shingle_sets(b.column("text"), width)]
            n, k1, k2 = (pa.array([x[i] for x in named], pa.int64()) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), n, k1, k2],
                names=["doc_id", "th", "n", "k1", "k2"],
            )
        release()

    return docs.withColumn("th", F.xxhash64("text")).mapInArrow(run, "doc_id long, th long, n long, k1 long, k2 long")


def _frequent(docs: DataFrame, width: int, total: int, most: int, per_counter: int) -> Order:
    """The ``most`` most frequent n-grams and the number of documents that
    hold them, over all documents."""
    parts = max(8, -(-total // per_counter))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(parts)
        batch = lambda x: pa.RecordBatch.from_arrays([pa.array(x[0], pa.int32()), pa.array(x[1], pa.binary())], names=["part", "counts"])
        for b in batches:
            for s in shingle_sets(b.column("text"), width):
                for x in counter.add(s):
                    yield batch(x)
        yield batch(counter.packed())
        release()

    top = most_frequent(docs.select("text").mapInArrow(run, COUNTED), parts, most)
    return Order(top.upper, top.count)


def _postings(docs: DataFrame, width: int, similar: tuple[int, int], order: Broadcast, hot: int, parts: int) -> DataFrame:
    """The start of every set in the global order, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        o = order.value
        cols: list[list[np.ndarray]] = [[], [], [], []]
        names: list[int] = []
        sizes: list[int] = []
        postings = 0

        def packed() -> pa.RecordBatch:
            token, salt, owner, left = (np.concatenate(c) for c in cols)
            return pack(token, salt, owner, left, np.array(names, np.int64), np.array(sizes, np.int64), parts)

        for b in batches:
            for s in shingle_sets(b.column("text"), width):
                n = len(s)
                if not n:
                    continue
                c = o.counts(s)
                # Rare ones are in hash order as they come; the rest follows.
                some = np.flatnonzero(c)
                at = np.concatenate([np.flatnonzero(c == 0), some[np.lexsort((s[some], c[some]))]])[: prefix_size(n, similar)]
                k1 = set_key(s)[0]
                for col, v in zip(cols, (s[at], salts(c[at], np.int64(k1), hot), np.full(len(at), len(names)), n - np.arange(len(at))), strict=True):
                    col.append(v)
                names.append(k1)
                sizes.append(n)
                postings += len(at)
                if len(names) >= _SETS or postings >= _POSTINGS:
                    yield packed()
                    cols, names, sizes, postings = [[], [], [], []], [], [], 0
        if names:
            yield packed()
            cols = [[], [], [], []]
        release()

    return docs.select("text").mapInArrow(run, PACKED)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, similar: tuple[int, int], order: Broadcast, fragments: int) -> DataFrame:
    """Those of ``pairs(a, b)`` that are similar. The compressed texts of both
    sides meet, are cut there into the order's fragments, and the partial
    overlaps, one row per pair and fragment, are summed per pair. Shipping
    texts instead of their n-grams takes some quarter of the bytes."""
    num, den = similar
    left = pairs.join(texts.select(F.col("k1").alias("a"), F.col("packed").alias("x")), "a")
    both = left.join(texts.select(F.col("k1").alias("b"), F.col("packed").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                yield _overlaps(batch.slice(lo, TOGETHER), width, order.value, fragments)
        release()

    part = both.mapInArrow(run, "a long, b long, fragment int, common long, sizes long")
    # A repeated row gives its pairs twice.
    once = part.groupBy("a", "b", "fragment").agg(F.max("common").alias("common"), F.max("sizes").alias("sizes"))
    total = once.groupBy("a", "b").agg(F.sum("common").alias("common"), F.max("sizes").alias("sizes"))
    return total.where((num + den) * F.col("common") >= num * F.col("sizes")).select("a", "b")


def _overlaps(pairs: pa.RecordBatch, width: int, order: Order, fragments: int) -> pa.RecordBatch:
    """(a, b, fragment, common, sizes): overlaps of pairs of texts by fragment,
    empty ones left out, and the sizes of both sets added up. A text that
    several pairs hold is cut once."""
    ids = [*pairs.column("a").to_pylist(), *pairs.column("b").to_pylist()]
    blobs = [*pairs.column("x"), *pairs.column("y")]
    once = {i: blob for i, blob in zip(ids, blobs, strict=True)}
    sets = shingle_sets(unpacked(list(once.values())), width)
    cut = {i: (len(s), dict(order.segments(s, fragments))) for i, s in zip(once, sets, strict=True)}
    rows = []
    for a, b in zip(ids[: pairs.num_rows], ids[pairs.num_rows :], strict=True):
        (n, x), (m, y) = cut[a], cut[b]
        rows += [(a, b, f, c, n + m) for f in x.keys() & y.keys() if (c := common(x[f], y[f]))]
    names = ["a", "b", "fragment", "common", "sizes"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def ngram_components(docs: DataFrame, width: int = WIDTH, similar: tuple[int, int] = SIMILAR, heavy: int = HEAVY,
                     fragments: int = FRAGMENTS, per_counter: int = PER_COUNTER, hot: int = HOT_LIST) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row: ``doc_id, n_shingles,
    component_id`` (smallest doc_id reachable over links of similarity at
    least ``similar``), ``class_size`` (rows with the same set).

    Words are runs of anything but ASCII white space, lower-cased A-Z; texts
    with fewer than ``width`` words are one shingle. Null and empty texts are
    empty sets, linked with nothing: their component is their own id. Rows
    without id are linked to nothing, component null, and lend nothing to
    others. Repeated ids are rows of their own; equal sets are linked. No rows
    give no rows; other columns are ignored. No link between different sets
    is lost at any group size: classes are joined to their list's leader
    first, and whatever is still apart after that is compared pair by pair.

    Shuffles: 1 to 2 bytes an n-gram to count, the first fifth of each set as
    postings, and the compressed texts of documents that share a posting:
    once to be gathered, and once for each side of their pairs."""
    return _components_of(docs, width, similar, heavy, fragments, per_counter, hot).drop("th", "comp")


def _components_of(docs: DataFrame, width: int, similar: tuple[int, int], heavy: int = HEAVY, fragments: int = FRAGMENTS,
                   per_counter: int = PER_COUNTER, hot: int = HOT_LIST) -> DataFrame:
    """:func:`ngram_components` with each row's text hash and the name of its
    component (null for empty sets and rows without id)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch = Scratch(d.sparkSession, "ngram")
    named = scratch.keep(_classes(d, width), "sets")
    live = named.where("n > 0 AND doc_id IS NOT NULL")
    reps = scratch.keep(live.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("class_size")), "classes")
    total = live.agg(F.sum("n")).first()[0] or 0
    sc = d.sparkSession.sparkContext
    real = d.where("doc_id IS NOT NULL")
    order = sc.broadcast(_frequent(real, width, total, heavy, per_counter))  # at most `heavy` n-grams

    parts = max(16, -(-total // (5 * PER_PART)))
    near = scratch.keep(lists(_postings(real, width, similar, order, hot, parts), similar), "lists", free=True)
    apart = possible(F.col("n"), F.col("left"), F.col("lead_n"), F.col("lead_left"), similar)
    star = near.where(apart & (F.col("k1") != F.col("lead"))).select(F.least("k1", "lead").alias("a"), F.greatest("k1", "lead").alias("b"))
    # Lists dealt over salts: each salt's leader is paired with the smallest.
    heads = near.where("k1 = lead").join(near.where("salt > 0").select("token").distinct(), "token").select("token", "lead").distinct()
    low = heads.groupBy("token").agg(F.min("lead").alias("low"))
    more = heads.join(low, "token").where("lead <> low").select(F.least("lead", "low").alias("a"), F.greatest("lead", "low").alias("b"))
    star = scratch.keep(star.union(more).distinct(), "star")

    # The text of one document of each class that has postings left. A sieve
    # of those documents keeps most other texts out of the shuffle.
    one = F.min(F.struct("doc_id", "th")).alias("one")
    wanted = live.join(near.select("k1").distinct(), "k1", "left_semi").groupBy("k1").agg(one)
    wanted = scratch.keep(wanted.select("k1", "one.doc_id", "one.th"), "wanted")
    only = sieve(wanted.select(key("doc_id", "th")), wanted.count())
    keyed = real.withColumn("th", F.xxhash64("text")).withColumn("sieve_key", key("doc_id", "th"))
    # Ids are hashed, so the texts needn't be sorted to meet them.
    texts = packed_texts(keyed, ["doc_id", "th"], only).join(wanted.hint("shuffle_hash"), ["doc_id", "th"]).select("k1", "packed")
    texts = scratch.keep(texts, "texts", free=True)

    links = scratch.keep(_verified(star, texts, width, similar, order, fragments), "links1", free=True)
    joined = scratch.keep(components(links, scratch, "cc1"), "joined")
    # Whatever its list's leader didn't bring together: pairs of one list whose
    # components differ, at least one of them not the leader's.
    tagged = near.join(joined.select(F.col("id").alias("k1"), "comp"), "k1", "left").withColumn("comp", F.coalesce("comp", "k1"))
    tagged = tagged.join(joined.select(F.col("id").alias("lead"), F.col("comp").alias("lead_comp")), "lead", "left")
    tagged = scratch.keep(tagged.withColumn("lead_comp", F.coalesce("lead_comp", "lead")).select("token", "salt", "k1", "n", "left", "comp", "lead_comp"), "tagged")
    salted = tagged.where("salt > 0").select("token").distinct().withColumn("salted", F.lit(True))
    base = tagged.join(salted, "token", "left")
    x = base.where("comp <> lead_comp OR salted").select("token", *[F.col(c).alias(f"{c}_x") for c in ("k1", "n", "left", "comp")])
    y = tagged.select("token", *[F.col(c).alias(f"{c}_y") for c in ("k1", "n", "left", "comp")])
    meet = (
        (F.col("comp_x") != F.col("comp_y"))
        & possible(F.col("n_x"), F.col("left_x"), F.col("n_y"), F.col("left_y"), similar)
    )
    rest = x.join(y, "token").where(meet).select(F.least("k1_x", "k1_y").alias("a"), F.greatest("k1_x", "k1_y").alias("b")).distinct()
    rest = scratch.keep(rest.join(star, ["a", "b"], "left_anti"), "rest")
    more = _verified(rest, texts.join(rest.select(F.explode(F.array("a", "b")).alias("k1")).distinct(), "k1", "left_semi"), width, similar, order, fragments)
    links = scratch.keep(links.union(more), "links", free=True)
    comp = scratch.keep(components(links, scratch, "cc2"), "comp")
    scratch.drop("texts", "wanted", "lists", "tagged", "star", "rest", "links1", "joined")

    # The smallest document of each component, over all its classes.
    # A class without links is its own component, by its full name: half of
    # one may, if ever so rarely, stand for two sets.
    alone = F.concat_ws(":", "k1", "k2", "n")
    c = reps.join(comp.withColumnRenamed("id", "k1"), "k1", "left").withColumn("comp", F.coalesce(F.col("comp").cast("string"), alone))
    low = c.groupBy("comp").agg(F.min("rep").alias("component_id"))
    known = c.join(low, "comp").select("k1", "k2", "n", "comp", "component_id", "class_size")
    out = named.join(known, ["k1", "k2", "n"], "left")
    return out.select(
        "doc_id",
        "th",
        F.when(F.col("doc_id").isNotNull(), F.col("comp")).alias("comp"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def keep_one(docs: DataFrame, width: int = WIDTH, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id,
    and of different texts of that id the first by a hash; of equal rows one
    stays. Rows that share an id but aren't linked are documents of their own.
    Rows without id and empty texts are linked with nothing and stay. Columns
    are unchanged, whatever their names; no rows give no rows."""
    id_, th, at = unused(docs, "of_id", "of_hash", "hash")
    comp = Scratch(docs.sparkSession, "keep").keep(_components_of(docs, width, similar), "components")
    linked = comp.where("comp IS NOT NULL")
    head = F.min(F.struct("doc_id", "th")).alias("head")
    stay = linked.groupBy("comp").agg(head).select(F.col("head.doc_id").alias(id_), F.col("head.th").alias(th))
    keyed = docs.withColumn(at, F.xxhash64("text"))
    key = (F.col("doc_id").cast("long") == F.col(id_)) & (F.col(at) == F.col(th))
    alone = comp.where("doc_id IS NOT NULL AND comp IS NULL").select(F.col("doc_id").alias(id_), F.col("th").alias(th)).distinct()
    kept = keyed.join(stay.union(alone), key, "left_semi")
    if linked.groupBy("doc_id", "th").count().where("count > 1").limit(1).count():
        empty = alone.withColumn("empty", F.lit(True))
        one = kept.join(empty, key, "left_anti").dropDuplicates(["doc_id", at])
        kept = one.unionByName(kept.join(empty, key, "left_semi"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).union(docs.where(F.col("doc_id").isNull()).select(*columns))
