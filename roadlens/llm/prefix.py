"""Prefix lists for set-similarity joins: which sets share one of the first
tokens of the global order, lists of one set left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import release, small_batches
from roadlens.llm.text import mix

PACKED = "part int, postings binary"
LISTED = "token long, salt int, k1 long, n int, left int, lead long, lead_n int, lead_left int"
BITS = ", bits long"  # of :data:`LISTED` with parity maps
PAIR = -1  # salt of a row that is a pair of sets, k1 and lead, and not a posting
PER_PART = 300_000  # postings that one task sorts at a time
_WIDER = 100 << np.arange(6)  # sizes of sets above which a parity map doubles its width, from 64 to 4,096 bits


class Frequent:
    """The most frequent tokens of a corpus with their counts, by the upper
    half of their hashes. Everything else counts as rare; as any order serves,
    tokens that share their upper half do no harm."""

    def __init__(self, upper: np.ndarray, count: np.ndarray):
        o = np.argsort(upper)
        self.upper, self.count = upper[o].astype(np.uint32), count[o].astype(np.int64)
        self._table: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}

    def _filled(self) -> np.ndarray:
        """Token (upper half) and count in one number each, at the place that
        the token's first bits name or the next that is free; 0 is free."""
        self._shift = np.uint64(32 - min(32, max(8, (2 * len(self.upper)).bit_length())))
        slot = (self.upper >> self._shift.astype(np.uint32)).astype(np.int64)
        i = np.arange(len(slot))
        at = i + np.maximum.accumulate(slot - i)
        out = np.zeros(max(1 << (32 - int(self._shift)), at[-1] + 1) + 1, np.uint64)
        out[at] = (self.upper.astype(np.uint64) << np.uint64(32)) | np.minimum(self.count, (1 << 32) - 1).astype(np.uint64)
        return out

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        """Counts of the tokens, 0 for rare ones."""
        if not len(self.upper):
            return np.zeros(len(tokens), np.int64)
        if self._table is None:
            self._table = self._filled()
        top = tokens >> np.uint64(32)
        at = (top >> self._shift).view(np.int64)
        got = self._table[at]
        other = (got >> np.uint64(32)) != top
        out = (got & np.uint64(0xFFFFFFFF)).view(np.int64)
        out[other] = 0
        left = np.flatnonzero(other & (got != 0))
        at = at[left]
        while len(left):
            at += 1
            got = self._table[at]
            same = (got >> np.uint64(32)) == top[left]
            out[left[same]] = (got[same] & np.uint64(0xFFFFFFFF)).view(np.int64)
            on = ~same & (got != 0)
            left, at = left[on], at[on]
        return out


class Counter:
    """Counts tokens in a task and packs them: per part of the hash range the
    gaps of the sorted upper halves and their counts, as byte planes: some two
    bytes a distinct token."""

    def __init__(self, parts: int, limit: int = 1_000_000):
        self.parts, self.limit = parts, limit
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        self.held.append((tokens >> np.uint64(32)).astype(np.uint32))
        self.size += len(tokens)
        if self.size >= self.limit:
            yield self.packed()

    def packed(self) -> tuple[np.ndarray, list[bytes]]:
        v = np.sort(np.concatenate(self.held)) if self.held else np.empty(0, np.uint32)
        self.held, self.size = [], 0
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))) if len(v) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(v))).astype("<u4")
        v = v[first]
        cut = np.searchsorted(v, np.linspace(0, 1 << 32, self.parts + 1).astype(np.uint64))
        some = np.flatnonzero(np.diff(cut))
        blobs = []
        for p in some.tolist():
            s = slice(cut[p], cut[p + 1])
            blobs.append(_planes(np.diff(v[s].astype(np.uint64), prepend=np.uint64(0)).astype("<u4")) + _planes(times[s]))
        return some.astype(np.int32), blobs


COUNTED = "part int, counts binary"


def most_frequent(counted: DataFrame, parts: int, most: int) -> Frequent:
    """The ``most`` most frequent tokens of packed counts ``(part, counts)``.
    Each part sends its own largest, so what the driver gets is bounded by
    about twice ``most``."""
    keep = -(-2 * most // parts) + 64

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, times = [], []
        for b in batches:
            for x in b.column("counts"):
                buf = memoryview(x.as_buffer())
                gaps, at = _unplanes(buf, 0, len(buf) // 8, "<u4")
                upper.append(np.cumsum(gaps, dtype=np.uint64).astype(np.uint32))
                times.append(_unplanes(buf, at, len(buf) // 8, "<u4")[0])
        v, t = np.concatenate(upper), np.concatenate(times)
        o = np.argsort(v, kind="stable")
        v, t = v[o], t[o]
        first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
        n = np.add.reduceat(t.astype(np.int64), first)
        some = np.flatnonzero(n > 1)
        if len(some) > keep:
            some = some[np.argpartition(n[some], len(some) - keep)[-keep:]]
        yield pa.RecordBatch.from_arrays([pa.array(v[first[some]].astype(np.int64)), pa.array(n[some])], names=["token", "n"])
        del upper, times, v, t, o, first, n
        release()

    with small_batches(counted.sparkSession):
        top = counted.groupBy("part").applyInArrow(run, "token long, n long").orderBy(F.desc("n"), "token").limit(most).toPandas()
    return Frequent(top["token"].to_numpy().astype(np.uint32), top["n"].to_numpy())


def prefix_size(n: np.ndarray | int, similar: tuple[int, int]) -> np.ndarray | int:
    """n - ceil(t n) + 1: two sets of Jaccard similarity t or more share a
    token among that many of each."""
    num, den = similar
    return n - -(-num * n // den) + 1


def possible(n: Column, left: Column, m: Column, m_left: Column, similar: tuple[int, int]) -> Column:
    """Length and positional filter: whether sets of n and m tokens whose
    common ones lie in the last ``left`` and ``m_left`` of them can be similar."""
    num, den = similar
    most = F.least(left, m_left).cast("long")
    return (num + den) * most >= num * (n.cast("long") + m.cast("long"))


def alike(n: Column, bits: Column, m: Column, m_bits: Column, similar: tuple[int, int]) -> Column:
    """Parity filter: whether sets of n and m tokens with these parity maps can
    be similar (see :func:`_pairs`)."""
    num, den = similar
    differ = F.bit_count(bits.bitwiseXOR(m_bits)).cast("long")
    return (num + den) * differ <= (den - num) * (n.cast("long") + m.cast("long"))


def salts(count: np.ndarray, k1: np.ndarray, hot: int) -> np.ndarray:
    """0, or for tokens of more than ``hot`` sets a number from 1 on that
    deals their sets over tasks."""
    many = -(-count // hot)
    return np.where(many > 1, 1 + k1 % np.maximum(many, 1), 0).astype(np.int32)


def _planes(a: np.ndarray) -> bytes:
    """Byte planes: what the shuffle's compression makes little of."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()


def _unplanes(buf: memoryview, at: int, n: int, kind: str) -> tuple[np.ndarray, int]:
    w = np.dtype(kind).itemsize
    a = np.frombuffer(buf, np.uint8, n * w, at).reshape(w, n)
    return np.ascontiguousarray(a.T).view(kind).ravel(), at + n * w


def parity(tokens: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit parity map of each set: every token flips one bit. Two maps
    differ in no more bits than their sets in tokens."""
    if not len(tokens):
        return np.zeros(len(start), np.uint64)
    return np.bitwise_xor.reduceat(np.uint64(1) << (mix(tokens) >> np.uint64(58)), start)


def _doublings(n: np.ndarray) -> np.ndarray:
    """How often a set's parity map doubles its 64 bits: in one that holds more
    tokens than bits, sets that have little in common hardly differ."""
    return np.searchsorted(_WIDER, n)


def _further(n: np.ndarray) -> np.ndarray:
    """Words of a set's parity map beyond the first."""
    return (1 << _doublings(n)) - 1


def further_parity(tokens: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The words of wider parity maps but the first, set after set; that one
    is what :func:`parity`, all words in one, leaves. Sets of few tokens have
    none. Halves of a map in one are the map of half the width."""
    more = _further(n)
    out = np.zeros(int(more.sum()), np.uint64)
    wide = np.flatnonzero(more)
    if len(wide):
        size = n[wide].astype(np.int64)
        own = np.repeat(wide, size)
        h = mix(tokens[np.arange(len(own)) + np.repeat(start[wide] - (np.cumsum(size) - size), size)])
        word = (h & more[own].astype(np.uint64)).astype(np.int64)
        some = word > 0
        at = (np.cumsum(more) - more)[own[some]] + word[some] - 1
        np.bitwise_xor.at(out, at, np.uint64(1) << (h[some] >> np.uint64(58)))
    return out


def pack(token: np.ndarray, salt: np.ndarray, owner: np.ndarray, left: np.ndarray, k1: np.ndarray, n: np.ndarray, parts: int,
         bits: np.ndarray | None = None, more: np.ndarray | None = None) -> pa.RecordBatch:
    """Postings as one row per part: ``owner`` points into the sets' names
    ``k1``, sizes ``n`` and, if given, parity maps: ``bits``, and ``more`` of
    large sets (:func:`further_parity`). A token's part is its place in the
    hash range, moved on by its salt."""
    bits = np.zeros(len(k1), np.uint64) if bits is None else bits
    words = np.zeros(len(k1), np.int64) if more is None else _further(n)
    first = np.cumsum(words) - words
    wide = token >> np.uint64(32)
    part = ((wide * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
    part = np.where(salt > 0, (part + salt.astype(np.int64) * 7919) % parts, part)
    # Without salts the parts lie in the order of the tokens.
    o = np.lexsort((token, part)) if salt.any() else np.argsort(token)
    token, salt, owner, left, part = token[o], salt[o], owner[o], left[o], part[o]
    cut = np.searchsorted(part, np.arange(parts + 1))
    which, blobs = [], []
    for p in np.flatnonzero(np.diff(cut)).tolist():
        s = slice(cut[p], cut[p + 1])
        own, idx = np.unique(owner[s], return_inverse=True)
        many = words[own]
        further = np.empty(0, np.uint64) if more is None else more[np.arange(many.sum()) + np.repeat(first[own] - (np.cumsum(many) - many), many)]
        head = np.array([s.stop - s.start, len(own), len(further)], "<u4").tobytes()
        gaps = np.diff(token[s], prepend=np.uint64(0))
        which.append(p)
        blobs.append(b"".join([
            head, _planes(gaps), _planes(salt[s].astype("<u2")), _planes(idx.astype("<u4")), _planes(left[s].astype("<u4")),
            _planes(k1[own].astype("<i8")), _planes(n[own].astype("<u4")), _planes(bits[own]), _planes(further),
        ]))
    return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "postings"])


def _unpack(blob: memoryview) -> tuple[list[np.ndarray], np.ndarray]:
    """The postings: token, salt, name, size, share still to come, parity map
    and where the map's further words start in the second result."""
    m, d, e = np.frombuffer(blob, "<u4", 3).tolist()
    gaps, at = _unplanes(blob, 12, m, "<u8")
    salt, at = _unplanes(blob, at, m, "<u2")
    idx, at = _unplanes(blob, at, m, "<u4")
    left, at = _unplanes(blob, at, m, "<u4")
    k1, at = _unplanes(blob, at, d, "<i8")
    n, at = _unplanes(blob, at, d, "<u4")
    bits, at = _unplanes(blob, at, d, "<u8")
    more, at = _unplanes(blob, at, e, "<u8")
    words = _further(n) if e else np.zeros(d, np.int64)
    first = np.cumsum(words) - words
    return [np.cumsum(gaps, dtype=np.uint64), salt.astype(np.int32), k1[idx], n[idx].astype(np.int32), left.astype(np.int32), bits[idx], first[idx]], more


def lists(packed: DataFrame, similar: tuple[int, int], pair_list: int = 0, maps: bool = False) -> DataFrame:
    """Postings of tokens that several sets hold, each with its list's leader:
    the set with the largest share of itself still to come. Equal sets are
    one. Postings that the filters leave no partner in their list end here,
    lists of one, most of all, among them; not so those of lists dealt over
    salts, whose partners may be elsewhere.

    Lists of up to ``pair_list`` postings come as their pairs (salt PAIR) that
    pass length, positional and parity filters. ``maps``: the others come with
    their sets' parity maps, for :func:`alike`."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from listed(batches)
        release()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, further, held = [], [], 0
        for b in batches:
            for x in b.column("postings"):
                rows, more = _unpack(memoryview(x.as_buffer()))
                rows[6] = rows[6] + held
                held += len(more)
                got.append(rows)
                further.append(more)
        rows = [np.concatenate(c) for c in zip(*got, strict=True)]
        more = np.concatenate(further)
        got.clear()
        further.clear()
        # Lists of one go first: parts of a list come sorted, so this merges.
        o = np.argsort(rows[0], kind="stable")
        t = rows[0][o]
        twice = np.concatenate(([False], t[1:] == t[:-1])) if len(t) else np.empty(0, bool)
        twice[:-1] |= twice[1:]
        rows = _chosen(rows, o[twice | (rows[1][o] > 0)])
        rows = _chosen(rows, np.lexsort((rows[2], rows[1], rows[0])))
        rows = _chosen(rows, _starts(*rows[:2]) | (np.diff(rows[2], prepend=0) != 0))
        new = _starts(*rows[:2])
        if not len(new):
            return
        of = np.cumsum(new) - 1
        size = np.bincount(of)[of]
        short = (size <= pair_list) & (rows[1] == 0)
        if short.any():
            a, b = _pairs(*_chosen(rows, short)[2:], more, of[short], similar)
            none = np.zeros(len(a), np.int32)
            yield _listed(np.zeros(len(a), np.int64), none + PAIR, a, none, none, b, none, none, *[np.zeros(len(a), np.int64)] * maps)
        rows = _chosen(rows, ~short)
        rows = _chosen(rows, _has_partner(*rows[:5], similar))
        if not len(rows[0]):
            return
        size = np.bincount(np.cumsum(_starts(*rows[:2])) - 1)[np.cumsum(_starts(*rows[:2])) - 1]
        rows = _chosen(rows, (size > 1) | (rows[1] > 0))
        token, salt, k1, n, left, bits, _ = _chosen(rows, np.lexsort((rows[2], -(rows[4] / np.maximum(rows[3], 1)), rows[1], rows[0])))
        new = _starts(token, salt)
        if len(new):
            f = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            yield _listed(token.view(np.int64), salt, k1, n, left, k1[f], n[f], left[f], *[bits.view(np.int64)] * maps)

    return packed.groupBy("part").applyInArrow(run, LISTED + BITS * maps)


def _listed(*cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[x.split()[0] for x in (LISTED + BITS).split(", ")][: len(cols)])


def _map(bits: np.ndarray, first: np.ndarray, more: np.ndarray, held: np.ndarray, doublings: int) -> np.ndarray:
    """Parity maps of 2 ** ``doublings`` words, a row each, of sets that have
    2 ** ``held`` or more."""
    out = np.empty((len(bits), 1 << doublings), np.uint64)
    for d in np.unique(held).tolist():
        i = np.flatnonzero(held == d)
        rest = more[first[i][:, None] + np.arange((1 << d) - 1)]
        whole = np.column_stack([bits[i] ^ np.bitwise_xor.reduce(rest, axis=1), rest])
        while whole.shape[1] > 1 << doublings:
            half = whole.shape[1] // 2
            whole = whole[:, :half] ^ whole[:, half:]
        out[i] = whole
    return out


def _pairs(k1: np.ndarray, n: np.ndarray, left: np.ndarray, bits: np.ndarray, first: np.ndarray, more: np.ndarray, of: np.ndarray,
           similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, smaller name first, of rows of one list (``of``) that
    pass the filters: overlap o of sets n, m needs (num + den) o >= num (n + m),
    so they differ in n + m - 2 o <= (den - num) (n + m) / (num + den) tokens.
    The first words of the parity maps decide first, the whole maps of what
    is left then."""
    num, den = similar
    o = np.lexsort((n, of))
    k1, n, left, bits, first, of = k1[o], n[o].astype(np.int64), left[o].astype(np.int64), bits[o], first[o], of[o]
    # Of the rows of a list by rising size, those that one can pass with end
    # where the first is larger than its room.
    room = ((num + den) * left) // num - n
    found = [np.empty((0, 2), np.int64)]
    held = _doublings(n) if len(more) else np.zeros(len(n), np.int64)
    i = np.arange(len(of))
    step = 1
    while True:
        i = i[i + step < len(of)]
        i = i[(of[i + step] == of[i]) & (n[i + step] <= room[i])]
        if not len(i):
            break
        j = i + step
        ok = np.flatnonzero(room[j] >= n[i])
        ok = ok[(num + den) * np.bitwise_count(bits[i[ok]] ^ bits[j[ok]]).astype(np.int64) <= (den - num) * (n[i[ok]] + n[j[ok]])]
        width = np.minimum(held[i[ok]], held[j[ok]])
        for d in np.unique(width[width > 0]).tolist():
            these = ok[width == d]
            u, v = i[these], j[these]
            differ = np.bitwise_count(_map(bits[u], first[u], more, held[u], d) ^ _map(bits[v], first[v], more, held[v], d)).sum(axis=1, dtype=np.int64)
            ok = np.setdiff1d(ok, these[(num + den) * differ > (den - num) * (n[u] + n[v])], assume_unique=True)
            width = np.minimum(held[i[ok]], held[j[ok]])
        x, y = k1[i[ok]], k1[j[ok]]
        found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
        step += 1
    p = np.unique(np.concatenate(found), axis=0)
    return p[:, 0], p[:, 1]


def _chosen(rows: list[np.ndarray], i: np.ndarray) -> list[np.ndarray]:
    return [c[i] for c in rows]


def _has_partner(token: np.ndarray, salt: np.ndarray, k1: np.ndarray, n: np.ndarray, left: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """False where no other row of the list can pass the filters. Sets n, m
    pass if (num + den) * min(left, left') >= num * (n + m), that is if each
    is no larger than the room u = (num + den) / num * left - n of the other;
    a partner of size at most u, and one with room for n, must be there."""
    if not len(token):
        return np.empty(0, bool)
    num, den = similar
    room = ((num + den) * left.astype(np.int64)) // num - n
    of = np.cumsum(_starts(token, salt)) - 1
    small = _other_extreme(n.astype(np.int64), of)
    wide = -_other_extreme(-room, of)
    return (salt > 0) | ((small <= room) & (wide >= n))


def _other_extreme(v: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each element the smallest of its group's others; the largest value
    there is if it is alone. ``of`` numbers the groups in rising order."""
    o = np.lexsort((v, of))
    g = of[o]
    first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    second = first + 1
    there = (second < len(g)) & (g[np.minimum(second, len(g) - 1)] == g[first])
    lowest = v[o][first]
    next_ = np.where(there, v[o][np.minimum(second, len(g) - 1)], np.iinfo(np.int64).max)
    out = lowest[of]
    out[o[first]] = next_
    return out


def _starts(token: np.ndarray, salt: np.ndarray) -> np.ndarray:
    if not len(token):
        return np.empty(0, bool)
    return np.concatenate(([True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])))


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())
