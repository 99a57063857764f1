import numpy as np
import pytest
import sentencepiece
from brute import component_ids, linked, removed_lines, shingle_set
from llm_fixtures import SF, edge_docs, make_docs, piece_model  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from roadlens.llm import mix, toxicity


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, as the driver runs them."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        f(spark, docs, SF).write.parquet(f"{root}/{name}")
        new = spark.read.parquet(f"{root}/{name}")
        out.append((docs, new))
        docs = new
    return out


def test_columns(stages):
    for docs, out in stages[:-1]:
        assert out.dtypes == docs.dtypes
    assert stages[-1][1].dtypes == [
        *stages[0][0].dtypes, ("token_ids", "array<int>"), ("round_trip", "boolean"), ("parity", "boolean"),
    ]


def test_toxic_documents_go(spark, stages):
    docs, out = stages[0]
    scores = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    want = {r.doc_id for r in scores.collect() if not r.predicted}
    assert {r.doc_id for r in out.collect()} == want and want


def test_lines_go(stages):
    docs, out = stages[1]
    rows = [tuple(r) for r in docs.select("doc_id", F.xxhash64("text"), "text").collect()]
    want = {}
    for i, gone in removed_lines(rows).items():
        kept = [x for j, x in enumerate((rows[i][2] or "").split("\n")) if j not in gone]
        if not gone or any(x.split() for x in kept):
            want[rows[i][0]] = "\n".join(kept)
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_one_of_each_group(stages):
    docs, out = stages[2]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [shingle_set(t) for _, t in rows]
    comp = component_ids([d for d, _ in rows], lambda i, j: linked(sets[i], sets[j]))
    assert {r.doc_id for r in out.collect()} == set(comp)


def test_mix(stages):
    docs, out = stages[3]
    want = {r.doc_id: r.copies for r in mix.mix(docs).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == want


def test_tokens(stages, piece_model):
    docs, out = stages[4]
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    assert out.count() == docs.count()
    for r in out.collect():
        assert np.array_equal(r.token_ids, sp.encode(r.text or ""))
        assert r.parity and r.round_trip == (sp.decode(sp.encode(r.text or "")) == (r.text or ""))


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(stages[-1][1])


def test_edge_rows_through_all_stages(spark, edge_docs, make_docs):
    clash = edge_docs
    for n in ("__h", "__cut", "__id", "__copies", "__rate", "hash", "of_id", "token_ids"):
        clash = clash.withColumn(n, F.lit(n))
    for docs in (clash, make_docs([])):
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, docs, SF)
            if name != "sentencepiece":
                assert out.dtypes == docs.dtypes
            if docs.isEmpty():
                assert out.isEmpty()
            docs = out.persist()
        if "__h" in docs.columns:
            assert docs.select("__h", "__rate", "of_id").distinct().collect() == [("__h", "__rate", "of_id")]
            assert docs.where("doc_id = 6").count() >= 1


def test_batches_hold_few_texts(spark, make_docs):
    before = spark.conf.get(corpus_pipeline.BATCH)
    try:
        for set_to, want in (("10000", "1000"), ("0", "1000"), ("50", "50")):
            for _, f in corpus_pipeline.STAGES[1:2]:
                spark.conf.set(corpus_pipeline.BATCH, set_to)
                f(spark, make_docs([(1, "a b\nc")]), SF)
                assert spark.conf.get(corpus_pipeline.BATCH) == want
    finally:
        spark.conf.set(corpus_pipeline.BATCH, before)
