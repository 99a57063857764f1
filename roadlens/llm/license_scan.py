"""License scans with a generalised suffix automaton of licence words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.text import plain_words

# Phrases whose every place counts, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Customary wording of licence notices, and a label for each.
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "no-warranty",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("mit-notice", "Released under the MIT License."),
    (
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

MIN_MATCH = 3
MIN_COVER = 0.8
MAX_GAP = 8


@dataclass
class Automaton:
    """Suffix automaton of several word sequences. Every state stands for the
    substrings that end at the same places; ``seen`` names, for each state,
    one place (sequence, end) of every sequence that holds it."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    seen: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def _state(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        self.seen.append({})
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the part of ``q`` that is one longer than ``p``."""
        c = self._state(self.size[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = c
            p = self.link[p]
        return c

    def add(self, words: Sequence[int]) -> list[int]:
        """Adds a sequence; the state that the whole prefix ends in, by word."""
        last, path = 0, []
        for w in words:
            q = self.step[last].get(w)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, q, w)
            else:
                new = self._state(self.size[last] + 1, {}, 0)
                p = last
                while p >= 0 and w not in self.step[p]:
                    self.step[p][w] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.step[p][w]
                    self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, w)
                last = new
            path.append(last)
        return path


class Scanner:
    """Automaton of all phrases and templates, and the scan of one text."""

    def __init__(self, base: Iterable[tuple[str, str]] = BASE, templates: Iterable[tuple[str, str]] = TEMPLATES,
                 min_match: int = MIN_MATCH, min_cover: float = MIN_COVER, max_gap: int = MAX_GAP):
        self.min_match, self.min_cover, self.max_gap = min_match, min_cover, max_gap
        self.ids: dict[bytes, int] = {}
        word = lambda w: self.ids.setdefault(w, len(self.ids))
        self.base = [(label, [word(w) for w in plain_words(p)]) for p, label in base]
        self.templates = [(label, [word(w) for w in plain_words(t)]) for label, t in templates]
        self.shortest = min([self.min_match, *(len(ws) for _, ws in self.base)])
        self.auto = a = Automaton()
        for _, ws in self.base:
            a.add(ws)
        for _, ws in self.templates:
            a.add(ws)
        # Places: walk every template once more, and pass each state's places
        # on to its suffixes, longest states first.
        for t, (_, ws) in enumerate(self.templates):
            v = 0
            for end, w in enumerate(ws):
                v = a.step[v][w]
                a.seen[v].setdefault(t, end)
        order = sorted(range(1, len(a.size)), key=lambda s: -a.size[s])
        for s in order:
            for t, end in a.seen[s].items():
                a.seen[a.link[s]].setdefault(t, end)
        # Base phrases that end in a state: (index, words).
        ends: dict[int, list[tuple[int, int]]] = {}
        for i, (_, ws) in enumerate(self.base):
            v = 0
            for w in ws:
                v = a.step[v][w]
            ends.setdefault(v, []).append((i, len(ws)))
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in a.size]
        for s in reversed(order):
            self.phrases[s] = ends.get(s, []) + self.phrases[a.link[s]]

    def statistics(self, words: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """(position, state, length): the longest piece of any template that
        ends at each position. -1 is a word of no template."""
        step, link, size = self.auto.step, self.auto.link, self.auto.size
        v = n = 0
        for i, w in words:
            if w < 0:
                v = n = 0
                continue
            while v and w not in step[v]:
                v = link[v]
                n = size[v]
            if w in step[v]:
                v = step[v][w]
                n += 1
            yield i, v, n

    def scan(self, text: str | None) -> dict:
        """n_words; base places (phrase, start); spans: (template, first word,
        last word, covered share) of every template found."""
        words = plain_words(text)
        got = np.fromiter((self.ids.get(w, -1) for w in words), np.int32, len(words))
        known = np.flatnonzero(got >= 0)
        places: list[tuple[int, int]] = []
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        pending: tuple[int, int, int] | None = None

        def close() -> None:
            if pending is not None and pending[2] >= self.min_match:
                i, v, n = pending
                for t, end in self.auto.seen[v].items():
                    anchors.setdefault(t, []).append((i - n + 1, end - n + 1, n))

        if len(known):
            # Words outside the vocabulary only matter as breaks between runs.
            broken = np.flatnonzero(np.diff(known) > 1) + 1
            stream = list(zip(known.tolist(), got[known].tolist(), strict=True))
            lo = 0
            for hi in [*broken.tolist(), len(stream)]:
                for i, v, n in self.statistics(stream[lo:hi]) if hi - lo >= self.shortest else ():
                    for p, size in self.phrases[v]:
                        if n >= size:
                            places.append((p, i - size + 1))
                    # A match is maximal when the next one is not it, grown.
                    if pending is not None and n <= pending[2]:
                        close()
                    pending = (i, v, n)
                close()
                pending = None
                lo = hi
        spans = [s for t, hits in anchors.items() for s in self.chain(t, hits)]
        return {"n_words": len(words), "places": places, "spans": spans}

    def chain(self, t: int, hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Joins matches of template ``t`` that follow each other in text and
        template, in text order, and keeps chains that cover enough of it."""
        out = []
        first = last = covered = at = 0
        for start, place, n in sorted(hits):
            skip = max(0, at - place, last + 1 - start) if covered else 0
            if covered and n - skip > 0 and start + skip - last - 1 <= self.max_gap and place + skip >= at:
                covered += n - skip
            else:
                if covered:
                    out.append((t, first, last, covered / len(self.templates[t][1])))
                first, covered = start, n
            last, at = start + n - 1, place + n
        if covered:
            out.append((t, first, last, covered / len(self.templates[t][1])))
        return [s for s in out if s[3] >= self.min_cover]


SPAN = "array<struct<label:string,first_word:long,last_word:long,cover:double>>"


def scan_licenses(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  min_match: int = MIN_MATCH, min_cover: float = MIN_COVER, max_gap: int = MAX_GAP) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row: ``doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score, spans``.

    Each text is streamed once through the automaton. Places of base phrases
    are exact; matches of at least ``min_match`` words are chained per
    template (gaps of up to ``max_gap`` words), and a chain that covers
    ``min_cover`` of its template is a span. ``labels`` joins the labels of
    phrases and spans; ``score`` is 1 where a base phrase stands, else the
    best span's cover, else 0. ``first_word`` and ``last_word`` are the
    smallest and largest start of a base place, null if there is none.

    Null text is empty; null and repeated ids pass through; no rows give no
    rows; other columns are ignored. One scan, no shuffle; the automaton is
    built in each task from the constant templates."""
    base, templates = tuple(base), tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sc = Scanner(base, templates, min_match, min_cover, max_gap)
        for b in batches:
            cols: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for text in b.column("text").to_pylist():
                r = sc.scan(text)
                starts = [s for _, s in r["places"]]
                found = {sc.base[p][0] for p, _ in r["places"]}
                spans = [(sc.templates[t][0], a, z, c) for t, a, z, c in sorted(r["spans"], key=lambda s: (s[1], s[2], s[0]))]
                cols["n_words"].append(r["n_words"])
                cols["n_base"].append(len(starts))
                cols["first_word"].append(min(starts, default=None))
                cols["last_word"].append(max(starts, default=None))
                cols["base_labels"].append(",".join(sorted(found)))
                cols["labels"].append(",".join(sorted(found | {s[0] for s in spans})))
                cols["score"].append(1.0 if starts else float(min(1.0, max((s[3] for s in spans), default=0.0))))
                cols["spans"].append([dict(zip(("label", "first_word", "last_word", "cover"), s, strict=True)) for s in spans])
            span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(v, t) for v, t in zip(cols.values(), kinds, strict=True)]], names=["doc_id", *cols]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {SPAN}",
    )
