import math
import random
from collections import Counter

import numpy as np
import pytest
from brute import lower
from llm_fixtures import DOC, SF, edge_docs, make_docs  # noqa: F401

from roadlens.llm import lexical_search as S


def terms(text):
    out, word = [], ""
    for c in lower(text) + " ":
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(docs, items, k):
    """docs: (id, text), items: (id, text) -> {item: [(score, id), ...]}, by scoring every document."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(x for _, c in held for x in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = {}
    for i, ts in wanted.items():
        rows = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * c[x] // (1000 * c[x] + 20 * m)) for x in ts if x in c
            )
            if s > 0:
                rows.append((-s, d is None, d or 0))
        out[i] = [(-s, None if none else d) for s, none, d in sorted(rows)[:k]]
    return {i: r for i, r in out.items() if r}


def check(spark, docs, items, k=50):
    item_table = spark.createDataFrame(items, "item_id long, text string, rank int, doc_id long")
    got = {}
    for r in S.search(S.build_index(docs), item_table, k).orderBy("rank").collect():
        got.setdefault(r.item_id, []).append((r.score, r.doc_id))
        assert r.rank == len(got[r.item_id])
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(i[0], i[1]) for i in items], k)
    assert got == want
    return got


def test_edge_rows(spark, edge_docs):
    items = [(1, "one", 1, 1), (2, None, 1, 1), (3, "", 1, 1), (4, "A b C", 1, 1), (4, "ANOTHER one", 1, 1), (None, "w1x1 end é", 1, 1), (5, "nowhere", 1, 1)]
    got = check(spark, edge_docs, items)
    assert None in got and 5 not in got


@pytest.mark.parametrize("k,block", [(1, 8), (7, 3), (50, 1 << 14)])
def test_ties_and_blocks(spark, make_docs, monkeypatch, k, block):
    monkeypatch.setattr(S, "BLOCK_DOCS", block)
    rng = random.Random(k)
    vocabulary = [f"t{int(rng.paretovariate(0.6))}" for _ in range(300)]
    docs = [(rng.randint(0, 10**6), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    docs += [(-i, docs[0][1]) for i in range(1, 60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40))), 0, 0) for i in range(12)]
    check(spark, make_docs(docs), items, k)


def test_items_in_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "ITEM_TERMS", 40)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    check(spark, docs, [(r.item_id, r.text, 0, 0) for r in items[:6]])


def test_empty_tables(spark, make_docs):
    no_items = spark.createDataFrame([], "item_id long, text string")
    index = S.build_index(make_docs([(1, None)]))
    assert (index.docs, index.terms) == (0, 0)
    assert S.search(index, no_items).collect() == []
    assert S.search(index, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


@pytest.mark.parametrize("limit", [1 << 21, 64])
def test_treap_skips_ranges(monkeypatch, limit):
    """Cells hold the maximum below them, and most ranges are never opened."""
    monkeypatch.setattr(S, "_OPEN", limit)
    rng = np.random.default_rng(0)
    cell = rng.choice(60 * 4000, 20_000, replace=False)
    row, column, value = cell // 4000, cell % 4000, rng.integers(1, 1000, 20_000)
    value[column == 1234] += 10**6
    tree = S.K2Treap(row, column, value)
    assert tree.top[1] == value.max()
    ids = np.arange(4000)[::-1].copy()
    opened, add = [], S.Best.add
    monkeypatch.setattr(S.Best, "add", lambda self, s, d, n: (opened.append(len(s)), add(self, s, d, n)))
    best = S.Best(1)
    rows = np.flatnonzero(np.isin(np.arange(60), row[column == 1234]))
    tree.search(rows, ids, np.zeros(4000, np.uint8), best)
    total = np.bincount(column[np.isin(row, rows)], value[np.isin(row, rows)], minlength=4000)
    assert best.score[0] == total.max() and best.doc[0] == ids[total.argmax()]
    assert sum(opened) < 600
