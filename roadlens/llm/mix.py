"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadlens.llm.common import Scratch, unused

WEIGHTS = (1, 2, 3)
CAP = 3


def n_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size)`` -> ``target``: words to take from each source.

    The sum of all sizes is shared by weight (sources by code point, null
    last, take the weights in turn); a target stops at ``cap`` times its
    source's size and the excess is shared again among the others. With the
    sources ordered by size per weight, the stopped ones are a prefix, so
    sums over that order give the final share directly. The windows see one
    row per source."""
    ws = F.array(*[F.lit(int(w)) for w in weights])
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    every = W.partitionBy()
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    d = sizes.select("source", "source_size")
    d = d.withColumn("w", F.element_at(ws, (((F.row_number().over(by_name) - 1) % len(weights)) + 1).cast("int")))
    d = d.withColumn("top", F.lit(int(cap)) * F.col("source_size"))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0))
    d = d.withColumn("share", left.cast("double") / F.sum("w").over(rest))
    d = d.withColumn("open", F.col("top") > F.col("w") * F.col("share"))
    d = d.withColumn("level", F.max(F.when(F.col("open"), F.col("share"))).over(every))
    target = F.when(F.col("open"), F.col("w") * F.col("level")).otherwise(F.col("top").cast("double"))
    return d.select("source", "source_size", target.alias("target"))


def unit_hash(key: Column, seed: str) -> Column:
    """Uniform number in [0, 1) from a key; the same in every run."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))).substr(1, 13)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """``docs(doc_id, source, text)`` -> one row per row of ``docs``:
    ``doc_id, source, size, source_size, target, copies, taken``.

    A source's rate is target / size; each document is taken floor(rate)
    times, plus once if a hash of its id falls under the fraction, so reruns
    and reordered inputs agree. Null text has size 0, null source is a source
    of its own, rows with the same id make the same draw, a source without
    words has rate 0, no rows give no rows. Other columns are ignored.

    Sizes are counted in the scan and summed map-side: one small row per
    source and task is shuffled; texts never are."""
    sized = docs.select(F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes, weights, cap).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    draw = (unit_hash(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate")).cast("long")
    return (
        sized.join(t, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rate", rate)
        .withColumn("copies", F.floor("rate").cast("long") + draw)
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )


def emit(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as :func:`mix` says,
    with the columns of ``docs``. Rates come from a table of one row per
    source, written first: its size is then known, and the join broadcasts it
    as long as it is under the session's threshold, so the texts stay where
    they were read; beyond that it is a shuffled join. Nulls, repeated ids and
    empty tables as in :func:`mix`; columns of any name pass."""
    of, rate, copies = unused(docs, "of", "rate", "copies")
    sized = docs.select("source", n_words(F.col("text")).alias("size"))
    t = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    t = t.select(
        F.col("source").alias(of),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias(rate),
    )
    t = Scratch(docs.sparkSession, "mix").keep(t.coalesce(1), "rates")
    whole = F.floor(F.col(rate))
    draw = (unit_hash(F.col("doc_id"), seed) < F.col(rate) - whole).cast("int")
    out = docs.join(t, F.col("source").eqNullSafe(F.col(of)))
    out = out.withColumn(copies, whole.cast("int") + draw).where(F.col(copies) > 0)
    out = out.withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {docs}
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, 3 * source_size AS top FROM s
), h AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(top) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS share FROM w
), l AS (
  SELECT *, max(CASE WHEN top > w * share THEN share END) OVER () AS level FROM h
), t AS (
  SELECT source, source_size, CASE WHEN top > w * share THEN w * level ELSE top::DOUBLE END AS target FROM l
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t
), c AS (
  SELECT d.*, r.source_size, r.target,
    floor(rate)::BIGINT + (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < rate - floor(rate))::BIGINT AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
"""
OP6_SQL = MIX_SQL.format(docs="documents") + "SELECT doc_id, source, size, source_size, target, copies, size * copies AS taken FROM c"
