import random
import zlib

import numpy as np

from llm_fixtures import SF, edge_docs, make_docs  # noqa: F401
from roadlens.llm import queries, toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op9_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.7)
    test = [(got[d].predicted, t, got[d].score) for d, t in labels.items() if d in got and got[d].held_out]
    tp = sum(p and t for p, t, _ in test)
    assert tp / sum(p for p, _, _ in test) >= 0.9
    assert tp / sum(t for _, t, _ in test) >= 0.8
    # Calibration: mean score near the share of label 1.
    assert abs(np.mean([s for *_, s in test]) - np.mean([t for _, t, _ in test])) < 0.03


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = labels.where(~toxicity.held_out(labels["doc_id"]))
    flipped = known.union(labels.where(toxicity.held_out(labels["doc_id"])).selectExpr("doc_id", "quality", "1 - toxic"))
    a = toxicity.score(docs, toxicity.fit(docs, known)).collect()
    b = toxicity.score(docs, toxicity.fit(docs, flipped)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_index_is_exact():
    rng = random.Random(4)
    idf = np.array([rng.uniform(1, 5) for _ in range(30)])
    vec = lambda: toxicity.unit({rng.randrange(30): rng.randint(1, 4) for _ in range(rng.randint(1, 5))}, idf)
    vectors = [vec() for _ in range(500)]
    ids = rng.sample(range(10**6), 500)
    for block in (1, 7, 64):
        index = toxicity.BlockMaxIndex(vectors, ids, block)
        for _ in range(40):
            q, but = vec(), rng.choice([None, ids[3]])
            near = sorted(
                (-round(sum(w * v.get(t, 0.0) for t, w in q.items()), 12), i, n) for n, (v, i) in enumerate(zip(vectors, ids, strict=True)) if i != but
            )
            want = [(-s, i, n) for s, i, n in near if s < 0][:15]
            got = index.top(q, 15, but)
            assert [(i, n) for _, i, n in got] == [(i, n) for _, i, n in want]
            assert np.allclose([s for s, *_ in got], [s for s, *_ in want])


def test_isotonic():
    x, y = toxicity.isotonic(np.array([3.0, 1.0, 2.0, 2.0]), np.array([1.0, 0.0, 1.0, 0.0]), np.ones(4))
    assert np.interp([0, 1, 2, 3, 9], x, y).tolist() == [0.0, 0.0, 0.5, 1.0, 1.0]


def test_edges(spark, edge_docs, make_docs):
    labels = spark.createDataFrame([(1, None, 1), (4, 1, 0), (4, 0, 1), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(edge_docs, toxicity.fit(edge_docs, labels)).collect()
    assert len(got) == edge_docs.count()
    assert all(0.0 <= r.score <= 1.0 for r in got)
    none = labels.limit(0)
    blank = toxicity.score(edge_docs, toxicity.fit(edge_docs, none)).collect()
    assert {r.score for r in blank} == {0.0}
    assert toxicity.score(make_docs([]), toxicity.fit(make_docs([]), none)).count() == 0
    kept = toxicity.reject(edge_docs, toxicity.fit(edge_docs, none))
    assert kept.schema == edge_docs.schema and kept.count() == edge_docs.count()


def test_passages_and_copies_of_labelled_texts(spark, make_docs):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = " ".join(f"p{i}" for i in range(12))
    copied = " ".join(f"c{i}" for i in range(80))
    rows, labels = [], []
    for i in range(1200):
        kind = "passage" if i % 10 == 0 else "copy" if i % 10 == 1 else "clean"
        rows.append((i, {"passage": f"{text(30)} {passage} {text(30)}", "copy": copied, "clean": text(70)}[kind]))
        labels.append((i, int(kind != "clean")))
    rows += [(2000, f"{text(30)} {passage} {text(30)}"), (2001, copied), (2002, copied + " " + text(5)), (2003, text(70))]
    docs = make_docs(rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).where("doc_id >= 2000").collect()}
    assert [got[i].predicted for i in range(2000, 2004)] == [1, 1, 1, 0]
    assert abs(got[2001].evidence[0].cosine - 1.0) < 1e-9
    # Every labelled example that is not held out is in the index.
    assert sorted(model.index.ids.tolist()) == [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1]


def test_words_of_one_label_count(spark, make_docs):
    """A text finds its nearest example by words that tell nothing of labels."""
    docs = make_docs([(i, f"a{i} b{i} c{i} shared") for i in range(60)])
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    known = set(model.index.ids.tolist())
    for r in toxicity.score(docs, model).collect():
        if r.doc_id in known:
            assert r.evidence[0].doc_id == r.doc_id and abs(r.evidence[0].cosine - 1.0) < 1e-9


def test_blocks_are_skipped_and_nothing_is_lost():
    """Of 3,000 examples in groups the far ones' blocks are not completed, yet
    all queries get what a full scan gives."""
    rng = np.random.default_rng(3)
    groups = rng.random((30, 200)) * (rng.random((30, 200)) < 0.2)
    dense = groups[rng.integers(0, 30, 3000)] * (rng.random((3000, 200)) < 0.8) + 0.02 * (rng.random((3000, 200)) < 0.1)
    dense = dense[np.linalg.norm(dense, axis=1) > 0]
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    vectors = [{int(t): float(v[t]) for t in np.flatnonzero(v)} for v in dense]
    index = toxicity.BlockMaxIndex(vectors, range(len(vectors)))
    q = rng.integers(0, len(vectors), 300)
    near = index.tops(toxicity.Rows.of([vectors[i] for i in q]), 15)
    for i, got in zip(q, near, strict=True):
        exact = np.round(dense @ dense[i], 12)
        want = np.lexsort((np.arange(len(exact)), -exact))[:15]
        assert np.allclose([c for c, *_ in got], exact[want], atol=1e-11)
        assert got[0][0] == 1.0 and min(c for c, *_ in got) >= exact[want[-1]] - 1e-11
    assert 0 < index.completed < 0.75 * index.offered
