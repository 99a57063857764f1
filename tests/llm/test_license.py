import random
import re


from llm_fixtures import SF, edge_docs, make_docs  # noqa: F401
from roadlens.llm import license_scan as ls
from roadlens.llm import queries


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_places(text):
    w = plain_words(text)
    out = []
    for phrase, label in ls.BASE:
        p = phrase.split()
        out += [(label, i) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return w, out


def check(text, r):
    w, places = base_places(text)
    assert r.n_words == len(w)
    assert r.n_base == len(places)
    assert r.first_word == min((i for _, i in places), default=None)
    assert r.last_word == max((i for _, i in places), default=None)
    assert r.base_labels == ",".join(sorted({x for x, _ in places}))
    assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
    assert 0.0 <= r.score <= 1.0 and (r.score == 1.0 or not places)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries.op1_license_scans(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts)
    for r in got:
        check(texts[r.doc_id], r)
    assert sum(r.n_base for r in got) > 0


def test_matching_statistics_are_longest_matches():
    rng = random.Random(3)
    for _ in range(30):
        templates = [("t", " ".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))) for _ in range(3)]
        sc = ls.Scanner((("a b", "x"), ("c", "y"), ("b a b", "z")), templates)
        seqs = [t.split() for _, t in templates] + [["a", "b"], ["c"], ["b", "a", "b"]]
        subs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        text = [rng.choice("abcd") for _ in range(60)]
        got = {i: n for i, _, n in sc.statistics([(i, sc.ids.get(w.encode(), -1)) for i, w in enumerate(text)])}
        for i in range(len(text)):
            longest = max((n for n in range(1, i + 2) if tuple(text[i - n + 1 : i + 1]) in subs), default=0)
            assert got.get(i, 0) == longest
        want = sorted(
            (p, i) for p, (phrase, _) in enumerate((("a b", ""), ("c", ""), ("b a b", "")))
            for i in range(len(text)) if text[i : i + len(phrase.split())] == phrase.split()
        )
        assert sorted(sc.scan(" ".join(text))["places"]) == want


def test_spans_with_gaps_and_edits():
    sc = ls.Scanner()
    for t, (label, text) in enumerate(ls.TEMPLATES):
        spans = sc.scan(f"lorem ipsum {text} dolor")["spans"]
        hit = [s for s in spans if s[0] == t]
        assert hit and hit[0][1] == 2 and hit[0][3] == 1.0, label
    mit = ls.TEMPLATES[10][1].split()
    edited = " ".join([*mit[:20], "NOVEL", *mit[21:]])
    (span,) = [s for s in sc.scan(edited)["spans"] if s[0] == 10]
    assert 0.9 < span[3] < 1.0
    assert not [s for s in sc.scan(" ".join(mit[:20]))["spans"] if s[0] == 10]
    assert sc.scan("the software without restriction is free of charge")["spans"] == []


def test_edges(spark, edge_docs, make_docs):
    got = ls.scan_licenses(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {}
    for r in edge_docs.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    for r in got:
        if len(by[r.doc_id]) == 1:
            check(by[r.doc_id][0], r)
    many = make_docs([(1, "MIT License, mit-license; MIT_LICENSE cc by cc by"), (2, "cc\nBY-NC"), (3, "mitlicense"), (4, "apacheé license")])
    got = {r.doc_id: r for r in ls.scan_licenses(many).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (5, 0, 8, "cc-by,mit")
    assert got[2].base_labels == "cc-by" and got[3].n_base == 0 and got[4].n_base == 0
    assert ls.scan_licenses(make_docs([])).count() == 0
