from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brute import space_words, targets

from llm_fixtures import SF, edge_docs, make_docs  # noqa: F401
from roadlens.llm import mix


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_targets_and_taken_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, texts = defaultdict(int), {}
    for r in docs.collect():
        sizes[r.source] += len(space_words(r.text))
        texts[r.doc_id] = r.text
    want = targets(sizes)
    got = rows_of(mix.mix(docs))
    assert len(got) == docs.count()
    for r in got:
        assert r["size"] == len(space_words(texts[r["doc_id"]]))
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in {r["size"] * k for k in range(4)}
        rate = want[r["source"]] / sizes[r["source"]]
        assert int(rate) <= r["copies"] <= int(rate) + 1
    assert sum(r["taken"] for r in got) == pytest.approx(sum(sizes.values()), rel=0.25)
    assert sorted(map(str, got)) == sorted(map(str, rows_of(mix.mix(docs.repartition(3)))))


def test_emit_agrees_with_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r["doc_id"]: r["copies"] for r in rows_of(mix.mix(docs)) if r["copies"]}
    out = mix.emit(docs)
    assert out.schema == docs.schema
    assert Counter(r.doc_id for r in out.collect()) == want


def test_caps_are_shared_again(spark):
    sizes = {"a": 100, "b": 1, "c": 1, "d": 0, None: 5}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mix.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))
    assert got["b"] == 3.0 and got["c"] == 3.0 and got["d"] == 0.0 and got[None] == 15.0


def test_columns_of_any_name(spark, make_docs):
    docs = make_docs([(i, "a b c", "xyz"[i % 3]) for i in range(30)])
    for n in ("__of", "__rate", "__copies", "of", "rate", "copies"):
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id")))
    out = mix.emit(docs)
    assert out.schema == docs.schema
    assert Counter(r.doc_id for r in out.collect()) == {r["doc_id"]: r["copies"] for r in rows_of(mix.mix(docs)) if r["copies"]}
    assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in ("__of", "__rate", "__copies", "of", "rate", "copies"))


def test_edges(spark, make_docs, edge_docs):
    got = rows_of(mix.mix(edge_docs))
    assert len(got) == edge_docs.count()
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    some = mix.mix(make_docs([(1, None, None), (2, "a b", None), (None, "c", "z")]))
    assert {(r["source"], r["source_size"]) for r in rows_of(some)} == {(None, 2), ("z", 1)}
    assert rows_of(mix.mix(make_docs([]))) == []
    assert mix.emit(make_docs([])).count() == 0
    assert mix.emit(edge_docs).columns == edge_docs.columns
