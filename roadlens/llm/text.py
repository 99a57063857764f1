"""Words, lines and shingles of Arrow text columns, hashed with numpy.

Words come in two kinds, both after lower-casing A-Z only:

* *space words*: runs of anything but space and \\t \\n \\v \\f \\r
* *plain words*: runs of 0-9, a-z and every non-ASCII character

A space word's hash is 64 bits: a polynomial over random values of its bytes,
mixed; it depends on the word alone. A shingle mixes the hashes of five words
in order. Equal sets of hashes stand for equal sets of words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

_PLAIN = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_FOLDED = bytes(0x20 if 0x09 <= c <= 0x0D else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_LONG = 64  # bytes beyond which a word is hashed by itself
_WORDS = 1 << 16  # words that are hashed at a time
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x5851F42D4C957F2D  # odd
_PIECE = 1 << 18


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def plain_words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_PLAIN).split()


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _K1
        h = (h ^ (h >> np.uint64(29))) * _K2
        return h ^ (h >> np.uint64(32))


def packed_texts(docs: DataFrame, keys: list[str], only: Broadcast | None = None) -> DataFrame:
    """``keys`` and the text, compressed for a shuffle (``packed``): some two
    thirds of what the shuffle's own compression makes of it. With a sieve
    (``only``), rows whose ``sieve_key`` it doesn't hold are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            if only is not None:
                b = b.filter(pa.array(only.value.has(b.column("sieve_key"))))
            raw, o = utf8_column(b.column("text"))
            view = memoryview(raw)
            blobs = [zip_(view[x:y]) for x, y in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], pa.array(blobs, pa.binary())], names=[*keys, "packed"])

    d = docs.select(*keys, "text", *([] if only is None else ["sieve_key"]))
    schema = ", ".join(f"{k} {d.schema[k].dataType.simpleString()}" for k in keys)
    return d.mapInArrow(run, f"{schema}, packed binary")


def unpacked(col: Iterable[pa.Scalar]) -> pa.Array:
    """The texts of a column of :func:`packed_texts`."""
    unzip = zstandard.ZstdDecompressor().decompress
    return pa.array([unzip(x.as_buffer()).decode("utf-8", "surrogatepass") for x in col], pa.string())


def unzip(value: pa.Scalar) -> bytes:
    """The UTF-8 bytes of one value of :func:`packed_texts`."""
    return zstandard.ZstdDecompressor().decompress(value.as_buffer())


def _byte_values() -> np.ndarray:
    with np.errstate(over="ignore"):
        v = mix(np.arange(1, 257, dtype=np.uint64) * _K1)
    v[0x41:0x5B] = v[0x61:0x7B]  # A-Z as a-z
    v[_SPACE] = 0
    return v


def _exact_values() -> np.ndarray:
    with np.errstate(over="ignore"):
        v = mix(np.arange(1, 257, dtype=np.uint64) * _K1)
    v[_SPACE] = 0
    return v


_VALUE = _byte_values()
_VALUE_EXACT = _exact_values()
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _PIECE)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def utf8_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts."""
    wide = pa.types.is_large_string(col.type)
    if col.null_count or not (wide or pa.types.is_string(col.type)):
        col = col.cast(pa.string()).fill_null("")
        wide = False
    _, offsets, data = col.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def slices(col: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about ``limit`` bytes each."""
    _, o = utf8_column(col)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(o, o[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def _piece_hashes(raw: np.ndarray, begins: np.ndarray, value: np.ndarray = _VALUE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of one piece; ``begins`` marks bytes
    that start a text, ``value`` holds the value of each byte."""
    word = ~_SPACE[raw]
    first = word.copy()
    first[1:] &= ~word[:-1] | begins[1:]
    last = word.copy()
    last[:-1] &= ~word[1:] | begins[1:]
    s, e = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _powers(len(raw))
    with np.errstate(over="ignore"):
        total = np.cumsum(value[raw] * up[: len(raw)])
        before = np.where(s > 0, total[s - 1], np.uint64(0))
        h = (total[e] - before) * down[s]
        return mix(h + (e - s + 1).astype(np.uint64) * _K2), s


def space_hashes(raw: np.ndarray, offsets: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the space words of all texts and where each starts; ``exact``
    tells upper and lower case apart. Work goes in pieces of a quarter
    megabyte, cut at white space or between texts."""
    hashes, starts = [], []
    n = len(raw)
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    lo = 0
    while lo < n:
        hi = min(n, lo + _PIECE)
        while hi < n and not begins[hi] and not _SPACE[raw[hi]]:
            hi += 1
        h, s = _piece_hashes(raw[lo:hi], begins[lo:hi], _VALUE_EXACT if exact else _VALUE)
        hashes.append(h)
        starts.append(s + lo)
        lo = hi
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like :func:`space_hashes`, with other values and some three times as
    fast: words are read eight bytes at a time instead of byte by byte."""
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low = np.frombuffer(raw.tobytes().translate(_FOLDED) + bytes(16 - n % 8), np.uint8)
    word = np.zeros(n + 2, bool)
    np.not_equal(low[:n], 0x20, out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    # Texts that end and begin without white space between them.
    cut = np.unique(offsets)
    cut = cut[(cut > 0) & (cut < n)]
    cut = cut[word[cut] & word[cut + 1]]
    if len(cut):
        at = np.searchsorted(start, cut)
        start, end = np.insert(start, at, cut), np.insert(end, at - 1, cut)
    eight = low.view("<u8")
    parts = [_hashed(low, eight, start[i : i + _WORDS], end[i : i + _WORDS]) for i in range(0, len(start), _WORDS)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), start


def _hashed(low: np.ndarray, eight: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words from ``start`` to ``end``: eight bytes at a time are
    cut out of two neighbours of ``eight``."""
    size = end - start
    shift = ((start & 7) << 3).view(np.uint64)
    at = start >> 3

    def bytes_at(at: np.ndarray, shift: np.ndarray, left: np.ndarray) -> np.ndarray:
        got = (eight[at] >> shift) | (eight[at + 1] << (np.uint64(64) - shift))
        return got & (_ONES >> ((8 - np.minimum(left, 8)) << 3).view(np.uint64))

    with np.errstate(over="ignore"):
        h = mix(bytes_at(at, shift, size) + size.view(np.uint64) * _K2)
        more = np.flatnonzero((size > 8) & (size <= _LONG))
        done = 8
        while len(more):
            h[more] = mix(h[more] + bytes_at(at[more] + (done >> 3), shift[more], size[more] - done) * _K1)
            done += 8
            more = more[size[more] > done]
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(low[start[i] : end[i]].tobytes())
    return h


def plain_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the plain words of all texts and the row each is in."""
    raw, offsets = utf8_column(col)
    hashes, at = space_hashes(np.frombuffer(raw.tobytes().translate(_PLAIN), np.uint8), offsets)
    return hashes, np.searchsorted(offsets, at, "right") - 1


def shingle_sets(col: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words;
    a shorter text gives one, its whole sequence, an empty one none."""
    for lo, hi in slices(col):
        yield from _shingles(col.slice(lo, hi - lo), width)


def _shingles(col: pa.Array, width: int) -> Iterator[np.ndarray]:
    raw, offsets = utf8_column(col)
    words, starts = space_hashes(raw, offsets)
    cut = np.searchsorted(starts, offsets)
    run = chain_hash([words[i : len(words) - width + 1 + i] for i in range(width)], width) if len(words) >= width else words[:0]
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if hi - lo >= width:
            h = np.sort(run[lo : hi - width + 1])
            yield h[np.concatenate(([True], h[1:] != h[:-1]))]
        elif hi > lo:
            yield chain_hash([words[i : i + 1] for i in range(lo, hi)], hi - lo)
        else:
            yield words[:0]


class RunHashes:
    """Hashes of runs of consecutive words, of any length, from one pass over
    the words' hashes."""

    def __init__(self, words: np.ndarray):
        up, self._down = _powers(len(words) + 1)
        with np.errstate(over="ignore"):
            self._sum = np.concatenate(([np.uint64(0)], np.cumsum(words * up[: len(words)])))

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            n = np.asarray(lengths).astype(np.uint64)
            return mix((self._sum[starts + lengths] - self._sum[starts]) * self._down[starts] + n * _K2)


def pack_columns(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one compressed block: each column's bytes go
    plane by plane, so equal high bytes cost next to nothing."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack_columns(blob: bytes, *kinds: type) -> list[np.ndarray]:
    """The columns of :func:`pack_columns`, given their number types."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n = len(raw) // sum(sizes)
    out, at = [], 0
    for kind, size in zip(kinds, sizes, strict=True):
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * size
    return out


def chain_hash(parts: list[np.ndarray], n: int) -> np.ndarray:
    """Element by element one hash of ``n`` hashes in order."""
    with np.errstate(over="ignore"):
        h = np.full(len(parts[0]), n, np.uint64)
        for p in parts:
            h = (h ^ p) * _K1
            h ^= h >> np.uint64(29)
    return mix(h)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128-bit name of a sorted set of hashes, as two signed longs."""
    d = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return _signed(d & 0xFFFFFFFFFFFFFFFF), _signed(d >> 64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x
