import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F
from roadlens.llm.sieve import key, sieve


def test_nothing_wanted_is_held_back(spark):
    ids = spark.range(0, 30_000, 3, 7).withColumnRenamed("id", "doc_id")
    got = sieve(ids.select(key("doc_id")), 10_000).value
    every = spark.range(30_000).select(key("id").alias("k"), (F.col("id") % 3 == 0).alias("wanted")).toArrow().combine_chunks()
    has = got.has(every["k"].chunk(0))
    wanted = every["wanted"].to_numpy()
    assert has[wanted].all()
    assert has[~wanted].mean() < 0.02


def test_full_and_empty_sieves(spark):
    ids = spark.range(100_000).select(key("id"))
    small = sieve(ids, 100_000, most_bits=1 << 12).value
    assert len(small.packed) == 1 << 9
    assert small.has(pa.array(np.arange(50), pa.int64())).all()  # passes all, the join decides
    none = sieve(ids.limit(0), 0).value
    assert not none.has(pa.array([1, -5], pa.int64())).any()
    assert len(none.has(pa.array([], pa.int64()))) == 0
