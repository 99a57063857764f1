from pyspark.sql import functions as F
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import component_ids, linked, shingle_set

from llm_fixtures import SF, edge_docs, make_docs  # noqa: F401
from roadlens.llm import ngram_join, queries
from roadlens.llm.prefix import prefix_size


def check(rows, got):
    """rows: (doc_id, text) with ids, all different"""
    sets = [shingle_set(t) for _, t in rows]
    comp = component_ids([d for d, _ in rows], lambda i, j: linked(sets[i], sets[j]))
    want = {d: (len(s), c) for (d, _), s, c in zip(rows, sets, comp, strict=True)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    return want


def edited(words, rng, share):
    x = list(words)
    for _ in range(int(len(x) * share)):
        x[rng.randrange(len(x))] = f"e{rng.randint(0, 10**6)}"
    return " ".join(x)


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = check(rows, queries.op4_ngram_join(spark, SF).collect())
    assert any(c != d for d, (_, c) in want.items())


@pytest.mark.parametrize("heavy,hot,fragments", [(1 << 18, 20_000, 4), (64, 7, 1)])
def test_groups_of_near_copies(make_docs, heavy, hot, fragments):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(300)]
    rows = []
    passage = rng.choices(vocabulary, k=60)
    for size, share in ((60, 0.03), (25, 0.05), (4, 0.01)):
        base = rng.choices(vocabulary, k=rng.randint(80, 200))
        rows += [edited(base, rng, rng.random() * share) for _ in range(size)]
        rows += [" ".join(base)] * 3
    rows += [" ".join(rng.choices(vocabulary, k=50) + passage) for _ in range(30)]
    rows += [" ".join(rng.choices(vocabulary, k=rng.randint(0, 7))) for _ in range(40)]
    ids = rng.sample(range(10**9), len(rows))
    rows = list(zip(ids, rows, strict=True))
    got = ngram_join.ngram_components(make_docs(rows), heavy=heavy, hot=hot, fragments=fragments, per_counter=5000).collect()
    want = check(rows, got)
    assert len({c for _, c in want.values()}) < len(want)


def test_edges(edge_docs, make_docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(edge_docs).collect()), key=str)
    long_n = len(shingle_set(edge_docs.where("doc_id = 6").first().text))
    long_m = len(shingle_set(edge_docs.where("doc_id = 7").first().text))
    assert got == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (5, 1, 5), (None, 1, None), (None, 0, None),
        (6, long_n, 6), (7, long_m, 6), (8, 1, 8), (9, 2, 9), (10, 2, 9),
    ], key=str)
    empty = make_docs([])
    assert ngram_join.ngram_components(empty).count() == 0
    assert ngram_join.keep_one(empty).count() == 0


def test_one_of_each_group_stays(edge_docs):
    out = ngram_join.keep_one(edge_docs)
    assert out.schema == edge_docs.schema
    got = sorted(((r.doc_id, r.text if r.doc_id != 6 else "") for r in out.collect()), key=str)
    assert got == sorted([
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "another text"), (None, "one"), (None, None), (6, ""),
        (8, "é ß 日本 \U0001f600 ▁x"), (9, "A B C D E F"),
    ], key=str)


def test_unlinked_texts_of_one_id_stay(make_docs):
    rows = [(4, "x y z 1"), (5, "one two"), (5, "near copy"), (4, "near copy"), (5, "one two"), (6, "one two"), (7, ""), (7, ""), (7, None)]
    out = ngram_join.keep_one(make_docs(rows).withColumn("of_id", F.lit(1)).withColumn("hash", F.lit(2)))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(4, "x y z 1"), (4, "near copy"), (5, "one two"), (7, ""), (7, ""), (7, None)], key=str)
    assert {(r.of_id, r.hash) for r in out.collect()} == {(1, 2)}


def test_packed_postings_are_bounded_by_their_number(monkeypatch):
    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    class Order:
        value = ngram_join.Order(np.empty(0, np.uint32), np.empty(0, np.int64))

    monkeypatch.setattr(ngram_join, "_POSTINGS", 300)
    texts = [" ".join(f"w{i}x{j}" for j in range(504)) for i in range(9)]
    run = ngram_join._postings(Docs(), 5, (4, 5), Order, 20_000, 1)
    got = list(run(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
    held = [np.frombuffer(b.column("postings")[0].as_py(), "<u4", 1)[0] for b in got]
    each = prefix_size(500, (4, 5))
    assert sum(held) == 9 * each and max(held) < 300 + each and len(held) == 3
