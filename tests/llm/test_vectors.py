import random
from collections import defaultdict

import numpy as np
import pytest
from brute import component_ids, cosine, good

from llm_fixtures import SF
from roadlens.llm import ann, hnsw, queries

VEC = "vec_id long, embedding array<float>, label int, v string, rep int, shard int"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = random.Random(2)
    rows = []
    for g in range(12):
        base = [rng.gauss(0, 1) for _ in range(8)]
        for k in range(rng.choice([1, 2, 30])):
            rows.append((len(rows) * 5, [x + rng.gauss(0, 0.15) for x in base], g % 3))
    rows += [(100_000 + 50 * i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0], 1) for i in range(20)]
    nan, inf = float("nan"), float("inf")
    rows += [(7, None, 1), (8, [0.0] * 8, 1), (9, [nan] + [1.0] * 7, 1), (150, [inf] + [1.0] * 7, 1), (200, [None] + [1.0] * 7, 1),
             (13, [1.0] * 8, None), (None, [1.0] * 8, 1), (300, [], 1), (15, [1.0, 1.0], 1), (350, [1.0, 2.0], 1), (16, [1e-30] * 8, 2), (17, [1e30] * 8, 2)]
    rows.append(rows[0])
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VEC)


def floats(df):
    return [(r.vec_id, None if r.embedding is None else [None if x is None else float(np.float32(x)) for x in r.embedding], r.label) for r in df.collect()]


def links(rows, least):
    out = defaultdict(set)
    ok = [r for r in rows if r[0] is not None and r[2] is not None and good(r[1])]
    for i, (a, v, l) in enumerate(ok):
        for b, w, m in ok[:i]:
            if a != b and l == m and len(v) == len(w) and np.dot(v, w) > 0 and cosine(v, w) >= least:
                out[a].add(b)
                out[b].add(a)
    return out


def brute_components(rows, near):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    return dict(zip(ids, component_ids(ids, lambda i, j: ids[j] in near[ids[i]]), strict=True))


def test_near_dedup_query(spark, tmp_path):
    """Labels of several shards, with groups of two and large groups of near copies."""
    rng = np.random.default_rng(5)
    rows, sizes = [], [2] * 700 + [3] * 100 + [400] + [1] * 5000
    for size in sizes:
        centre = rng.normal(size=16)
        rows += [(centre + 0.09 * rng.normal(size=16)).astype(np.float32).tolist() for _ in range(size)]
    order = rng.permutation(len(rows)).tolist()
    table = [(i, rows[j], "big" if j % 10 else "small") for i, j in enumerate(order)]
    sf = str(tmp_path)
    spark.createDataFrame(table, "vec_id long, embedding array<float>, label string").write.parquet(f"{sf}/embeddings.parquet")
    df = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = {r.vec_id: r for r in queries.op5_embedding_dedup(spark, sf).collect()}
    assert len(got) == len(df)
    found = there = right = 0
    for _, g in df.groupby("label"):
        x = np.array(g.embedding.tolist(), np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= 0.93
        np.fill_diagonal(near, False)
        ids = g.vec_id.tolist()
        near_of = {ids[i]: {ids[j] for j in np.flatnonzero(near[i])} for i in range(len(ids)) if near[i].any()}
        comp = {i: i for i in ids}
        for i in sorted(near_of):  # smallest first, so a walk names all it reaches
            todo = [i] if comp[i] == i else []
            while todo:
                for j in near_of[todo.pop()]:
                    if comp[j] > i:
                        comp[j] = i
                        todo.append(j)
        for i in ids:
            assert got[i].n_links <= len(near_of.get(i, ()))
            assert got[i].kept == (got[i].component_id == i)
            found += got[i].n_links
            there += len(near_of.get(i, ()))
            right += got[i].component_id == comp[i]
    assert there and found >= 0.98 * there and right >= 0.98 * len(got)


@pytest.mark.parametrize("shard,ef", [(4096, 48), (16, 4)])
def test_near_dedup_edges(odd_vectors, shard, ef):
    rows = floats(odd_vectors)
    near = links(rows, 0.93)
    got = hnsw.near_vectors(odd_vectors, shard=shard, ef=ef).collect()
    assert len(got) == len(rows)
    want = brute_components(rows, near)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id) == (0, None)
        else:
            assert (r.n_links, r.component_id) == (len(near[r.vec_id]), want[r.vec_id]), r
    assert hnsw.near_vectors(odd_vectors.limit(0)).count() == 0


def test_graph_recall_and_audit():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(60, 32))
    x = centres[rng.integers(0, 60, 3000)] + 0.25 * rng.normal(size=(3000, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    g = hnsw.Graph(x)
    truth = x @ x.T >= 0.93
    np.fill_diagonal(truth, False)
    for ef in (4, 48):  # a beam too narrow is widened until the audit passes
        a, b = hnsw.within(g, x, 0.93, ef=ef, same=True)
        got = np.zeros_like(truth)
        got[a, b] = True
        np.fill_diagonal(got, False)
        assert not (got & (x @ x.T < 0.93 - 1e-5)).any()
        assert (got | got.T).sum() >= 0.97 * truth.sum()


def nearest(rows, every=50, k=5):
    ok = [r for r in rows if r[0] is not None and good(r[1])]
    out = {}
    for q, v, _ in ok:
        if q % every == 0 and q not in out:
            near = sorted((-cosine(v, w), b) for b, w, _ in ok if b != q and len(w) == len(v))
            out[q] = near[:k]
    return {(q, i + 1): (b, -s) for q, near in out.items() for i, (s, b) in enumerate(near)}


def test_nearest_query(spark):
    rows = floats(spark.read.parquet(f"{SF}/embeddings.parquet"))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in queries.op10_nearest(spark, SF).collect()}
    want = nearest(rows)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-12 for k in want)


@pytest.mark.parametrize("block,query_block", [(4096, 512), (7, 2)])
def test_nearest_edges(odd_vectors, block, query_block):
    df = odd_vectors.dropDuplicates(["vec_id"])
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.nearest(df, block=block, query_block=query_block).collect()}
    want = nearest(floats(df))
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k][1] - want[k][1]) < 1e-12
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert ann.nearest(df.limit(0)).count() == 0


def test_int8_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(50, 64)).astype(np.float32), rng.normal(size=(400, 64)).astype(np.float32)
    (qc, qs, qe), (cc, cs, ce) = ann.quantise(a), ann.quantise(b)
    prod = (qc.astype(int) @ cc.astype(int).T) * (qs[:, None] * cs[None, :])
    err = qe[:, None] + (1 + qe[:, None]) * ce[None, :]
    exact = np.array([[cosine(x.tolist(), y.tolist()) for y in b] for x in a])
    assert (np.abs(prod - exact) <= err).all() and err.max() < 0.1


def test_pairs_over_many_shards(spark):
    """Groups of two dealt over shards of more than 8 * ef nodes, beside one
    large group: a beam of one finds few of the pairs unless the label's
    audit widens it."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(900, 24))
    x = np.concatenate([base, base + 0.12 * rng.normal(size=base.shape), rng.normal(size=(1, 24)) + 0.02 * rng.normal(size=(200, 24))]).astype(np.float32)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in hnsw.near_vectors(df, shard=250, ef=2).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    there = near.sum(axis=1)
    pairs = [i for i in range(1800) if there[i]]
    assert len(pairs) > 1000
    assert all(n <= there[i] for i, n in got.items())
    assert np.mean([got[i] / there[i] for i in pairs]) >= 0.98
