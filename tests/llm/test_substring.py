import hashlib
import random
import re

import pytest
from llm_fixtures import edge_docs, make_docs  # noqa: F401

from roadlens.llm import substring_dedup as S


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, width):
    """rows: (doc_id, text) -> covered flags per row, looking at every pair of windows."""
    docs = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows})
    seen, covered = set(), {}
    for d in docs:
        w = words(d[2])
        cover = [False] * len(w)
        for p in range(len(w) - width + 1):
            x = tuple(w[p : p + width])
            if x in seen:
                cover[p : p + width] = [True] * width
            seen.add(x)
        covered[d] = cover
    return [covered[r[0] is not None, r[0] or 0, r[1] or ""] for r in rows]


def check(df, rows, width):
    want = []
    for (doc, text), cover in zip(rows, brute(rows, width), strict=True):
        w = words(text)
        want.append((doc, len(w), sum(cover), " ".join(x for x, c in zip(w, cover, strict=True) if not c)))
    got = [tuple(r) for r in S.without_repeats(df, width).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return want


@pytest.mark.parametrize("width", [2, 5, 20])
def test_shared_passages(make_docs, width):
    rng = random.Random(width)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(80):
        w = [rng.choice(["a", "b", f"w{rng.randint(0, 50)}", "The", "the"]) for _ in range(rng.randint(0, 90))]
        if i % 3:
            x = rng.randrange(40)
            w[10:10] = passage[x : x + rng.randint(1, 60)]
        rows.append((rng.randint(-20, 10**9), " ".join(w)))
    rows += [(10**10 + i, rows[0][1]) for i in range(40)] + [(5, "x " * 300), (6, "x " * 300)]
    want = check(make_docs(rows), rows, width)
    assert any(r[2] for r in want)


def test_edge_rows(edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    # Rows of one id are ordered by a hash of their texts; these share no passage.
    want = check(edge_docs, rows, 20)
    assert any(r[2] for r in want)


def test_repeated_rows_are_one_document(make_docs):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text), (3, text), (3, text + " end"), (None, text), (4, text)]
    got = {(r.doc, r.n_words): r.n_removed for r in S.without_repeats(make_docs(rows)).collect()}
    assert got[(None, 30)] == 0 and got[(3, 30)] == 30 and got[(3, 31)] == 30 and got[(4, 30)] == 30


def test_passages(make_docs):
    shared = " ".join(f"s{i}" for i in range(25))
    df = make_docs([(1, f"a b {shared} c"), (2, f"x {shared} y {shared}"), (3, shared.upper()), (4, None)])
    got = sorted(tuple(r) for r in S.repeated_places(df).collect())
    assert got == [(2, 1, 25), (2, 27, 25)]


def test_empty_table_and_digest(make_docs):
    assert S.dedup_digest(make_docs([])).collect() == []
    r = S.dedup_digest(make_docs([(1, None)])).collect()[0]
    assert tuple(r) == (1, 0, 0, hashlib.sha256(b"").hexdigest())


def test_groups_by_longer_prefixes(make_docs, monkeypatch):
    """Common first words are split by longer prefixes, and nothing is lost."""
    monkeypatch.setattr(S, "GROUP", 4)
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice(["a", "b"]) for _ in range(60))) for i in range(30)]
    check(make_docs(rows), rows, 8)
