"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read as plain protobuf; normaliser, space mark, piece
scores and byte fallback are rebuilt as a ``tokenizers`` pipeline. Words that
repeat are encoded once per task, and the result is compared with the
SentencePiece library itself.
"""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_WORDS_MAX = 600_000
_BARE = "\ud800"  # before a first word without a mark; no text holds it
GROUP_BYTES = 1 << 20


def _fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buf[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, buf[at : at + size]
        at += size


@dataclass(frozen=True)
class Model:
    pieces: list[tuple[str, float, int]]  # text, score, kind
    kind: int
    byte_fallback: bool
    unk_id: int
    charsmap: bytes
    add_prefix: bool
    squeeze: bool


def parse_model(data: bytes) -> Model:
    """The parts of a SentencePiece model that encoding depends on."""
    pieces: list[tuple[str, float, int]] = []
    kind, fallback, unk = _UNIGRAM, False, 0
    charsmap, prefix, squeeze = b"", True, True
    for field, value in _fields(data):
        if field == 1:
            d = dict(_fields(value))
            score = struct.unpack("<f", d[2])[0] if 2 in d else 0.0
            pieces.append((d.get(1, b"").decode("utf-8"), score, d.get(3, _NORMAL)))
        elif field == 2:
            d = dict(_fields(value))
            kind, fallback, unk = d.get(3, _UNIGRAM), bool(d.get(35, 0)), d.get(40, 0)
        elif field == 3:
            d = dict(_fields(value))
            charsmap, prefix, squeeze = d.get(2, b""), bool(d.get(3, 1)), bool(d.get(4, 1))
    return Model(pieces, kind, fallback, unk, charsmap, prefix, squeeze)


def build_tokenizer(m: Model):
    """``tokenizers`` twin of a parsed model, from normalised text with space
    marks to ids. BPE merges are every split of a piece into two pieces, in
    the order of the piece's score; unigram scores are taken as they are."""
    from tokenizers import Tokenizer, models

    if m.kind == _UNIGRAM:
        return Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], m.unk_id, m.byte_fallback))
    if m.kind != _BPE:
        raise ValueError(f"model type {m.kind} is neither unigram nor BPE")
    ids = {p: i for i, (p, _, _) in enumerate(m.pieces)}
    score = {p: s for p, s, k in m.pieces if k in (_NORMAL, _USER)}
    merges = sorted(
        (-s, ids[p[:cut]], ids[p[cut:]])
        for p, s in score.items()
        for cut in range(1, len(p))
        if p[:cut] in score and p[cut:] in score
    )
    text = [p for p, _, _ in m.pieces]
    return Tokenizer(
        models.BPE(ids, [(text[a], text[b]) for _, a, b in merges], unk_token=text[m.unk_id], fuse_unk=True, byte_fallback=m.byte_fallback)
    )


class _Numbers(dict):
    """word -> number by first appearance; ``new`` has those not yet encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        at = self[word] = len(self)
        return at


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, threads: int):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        from tokenizers import normalizers

        with open(path, "rb") as f:
            self.model = m = parse_model(f.read())
        self.tok = build_tokenizer(m)
        self.charsmap = normalizers.Precompiled(m.charsmap) if m.charsmap else None
        # No piece has a space mark behind another character: then nothing
        # joins over the start of a marked word, and words encode on their own.
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, k in m.pieces if k in (_NORMAL, _USER))
        self.bytes = [
            bytes([int(p[3:5], 16)]) if k == _BYTE else b"" if k == _CONTROL else " ⁇ ".encode() if k == _UNKNOWN else p.replace(MARK, " ").encode()
            for p, _, k in m.pieces
        ]
        self.forget()
        # Space, then a lookahead for a non-space: the start of a marked word.
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall

    def forget(self) -> None:
        """Drops the words seen so far: a worker outlives its tasks, and what
        one task learnt is not to fill the memory of the next stage."""
        self.seen, self.flat, self.start = _Numbers(), np.empty(0, np.int32), np.zeros(1, np.int64)

    def normalise(self, text: str) -> str:
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        if self.model.add_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _marked(self, text: str) -> list[str]:
        """The words of a normalised text, each with its space marks, without
        the first mark; spaces in a row belong to the word behind them."""
        m = self.model
        if m.add_prefix and self.charsmap is None and not m.squeeze and "  " not in text and MARK not in text and text[:1] not in ("", " ") and text[-1] != " ":
            return text.split(" ")
        text = self.normalise(text)
        if text[:1] != MARK:
            return [_BARE + w if i == 0 else w[1:] for i, w in enumerate(self.words(text))]
        return [w[1:] for w in self.words(text)]

    def _learn(self, new: list[str]) -> None:
        """Encodes the words that were first seen in this batch, in the order
        of their numbers, in one multithreaded call."""
        full = [w[1:] if w[:1] == _BARE else MARK + w for w in new]
        got = [e.ids for e in self.tok.encode_batch_fast(full, add_special_tokens=False)]
        ends = np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))
        more = np.fromiter(chain.from_iterable(got), np.int32, int(ends[-1]))
        self.start = np.concatenate([self.start, len(self.flat) + ends])
        self.flat = np.concatenate([self.flat, more])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The distinct words of all texts that are new to
        this task go to the library in one multithreaded batch."""
        if not self.by_word:
            done = self.tok.encode_batch_fast([self.normalise(t) for t in texts], add_special_tokens=False)
            return [np.asarray(e.ids, np.int32) for e in done]
        if len(self.seen) > _WORDS_MAX:
            self.forget()
        number = self.seen.__getitem__
        rows = [np.fromiter(map(number, ws), np.int64, len(ws)) for ws in map(self._marked, texts)]
        if self.seen.new:
            self._learn(self.seen.new)
            self.seen.new = []
        out = []
        for w in rows:
            first, size = self.start[w], self.start[w + 1] - self.start[w]
            ends = np.cumsum(size)
            at = np.arange(int(ends[-1]) if len(w) else 0) + np.repeat(first - (ends - size), size)
            out.append(self.flat[at])
        return out

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes
        raw = b"".join(map(table.__getitem__, ids.tolist()))
        if self.model.add_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def _codec(path: str, threads: int) -> Codec:
    return Codec(path, threads)


def _until_done(batches: Iterator[pa.RecordBatch], codec: Codec) -> Iterator[pa.RecordBatch]:
    try:
        yield from batches
    finally:
        codec.forget()
        pa.default_memory_pool().release_unused()


@functools.lru_cache(maxsize=2)
def _reference(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _parity(path: str, texts: list[str], ids: list[np.ndarray]) -> list[bool]:
    """Whether the SentencePiece library gives the same ids for each text."""
    return [len(x) == len(y) and x.tolist() == y for x, y in zip(ids, _reference(path).encode(texts, num_threads=1), strict=True)]


def _groups(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def encode(docs: DataFrame, path: str, threads: int = 2, verify: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> every row with its columns ``doc_id, ids,
    decoded, parity``: the model's ids for the whole text (no begin or end
    tokens), the text decoded from them, and whether the SentencePiece
    library gives the same ids (null if ``verify`` is off).

    Null text is empty (no ids, parity true); null and repeated ids pass
    through; no rows give no rows; other columns are ignored. One scan, no
    shuffle, groups of about 1 MB of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, threads)
        for b in _until_done(batches, codec):
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in _groups(texts, GROUP_BYTES):
                part = texts[lo:hi]
                ids = codec.encode(part)
                same = [None] * len(part)
                if verify:
                    same = _parity(path, part, ids)
                flat = np.concatenate([np.empty(0, np.int32), *ids])
                ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(lo, hi - lo),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array([codec.decode(x) for x in ids], pa.string()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "ids", "decoded", "parity"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string, parity boolean")


def encode_digest(docs: DataFrame, path: str, threads: int = 2, verify: bool = True) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, ids_hash`` (xxh3 of the ids as
    little-endian 32-bit integers), ``round_trip`` (the decoded text is the
    text) and ``parity``; the ids and texts themselves stay in the task.
    Edge cases as in :func:`encode`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, threads)
        for b in _until_done(batches, codec):
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in _groups(texts, GROUP_BYTES):
                part = texts[lo:hi]
                ids = codec.encode(part)
                same = [None] * len(part)
                if verify:
                    same = _parity(path, part, ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(lo, hi - lo),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([xxhash.xxh3_64_hexdigest(x.tobytes()) for x in ids], pa.string()),
                        pa.array([codec.decode(x) == t for x, t in zip(ids, part, strict=True)], pa.bool_()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "n_tokens", "ids_hash", "round_trip", "parity"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_hash string, round_trip boolean, parity boolean"
    )


ADDED = {"token_ids": T.ArrayType(T.IntegerType()), "round_trip": T.BooleanType(), "parity": T.BooleanType()}


def with_tokens(docs: DataFrame, path: str, threads: int = 2, check: bool = False) -> DataFrame:
    """``docs`` with the column ``token_ids`` and, with ``check``, ``round_trip``
    (the text decoded from them is the text) and ``parity`` (the SentencePiece
    library gives the same ids), replacing columns of these names: the last
    stage of a corpus pipeline. Null text gives no ids; repeated rows and ids
    pass through; no rows give no rows."""
    added = {n: k for n, k in ADDED.items() if check or n == "token_ids"}
    cols = [c for c in docs.columns if c not in added]
    part = docs.select(*[F.col(f"`{c}`") for c in cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, threads)
        for b in _until_done(batches, codec):
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in _groups(texts, GROUP_BYTES):
                some = texts[lo:hi]
                ids = codec.encode(some)
                ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *ids])
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if check:
                    new.append(pa.array([codec.decode(x) == t for x, t in zip(ids, some, strict=True)], pa.bool_()))
                    new.append(pa.array(_parity(path, some, ids), pa.bool_()))
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, *new], names=[*cols, *added])

    return part.mapInArrow(run, T.StructType([*part.schema.fields, *[T.StructField(n, k) for n, k in added.items()]]))
