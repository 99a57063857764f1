"""Plain versions of the operators, for small inputs."""

import math
import re
from collections import Counter


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingle_set(text):
    w = space_words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def linked(a, b):
    i = len(a & b)
    return bool(a) and bool(b) and 100 * i >= 80 * (len(a) + len(b) - i)


def component_ids(ids, link):
    """ids[i] with link(i, j) -> smallest id reachable, per position."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if link(i, j):
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(d, low.get(find(i), d))
    return [low[find(i)] for i in range(len(ids))]


def removed_lines(rows, least=0.8, min_words=1):
    """rows: (doc_id, order within the id, text) -> {(position of the row): removed line numbers}"""
    lines = []
    for at, (d, o, text) in enumerate(rows):
        for j, x in enumerate((text or "").split("\n")):
            s = set(re.findall(r"[^\x20\x09-\x0D]+", lower(x)))
            if s:
                lines.append(((d, o, j), at, s))
    lines.sort(key=lambda x: x[0])
    gone = {at: set() for at in range(len(rows))}
    earlier = []
    for (d, o, j), at, s in lines:
        if len(s) < min_words:
            continue
        for key, t in earlier:
            if key < (d, o, j) and 5 * len(s & t) >= 4 * len(s | t):
                gone[at].add(j)
                break
        earlier.append(((d, o, j), s))
    return gone


def cosine(a, b):
    return math.fsum(x * y for x, y in zip(a, b)) / (math.sqrt(math.fsum(x * x for x in a)) * math.sqrt(math.fsum(y * y for y in b)))


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def targets(sizes, weights=(1, 2, 3), cap=3):
    """{source: size} -> {source: target}: share, stop, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out = {s: 0.0 for s in names}
    free, left = set(names), float(sum(sizes.values()))
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total >= cap * sizes[s]}
        if not over:
            for s in free:
                out[s] = left * w[s] / total
            break
        for s in over:
            out[s] = float(cap * sizes[s])
        left -= sum(out[s] for s in over)
        free -= over
    return out


def counts(xs):
    return Counter(xs)
