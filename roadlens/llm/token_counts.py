"""Token counts with a library tokenizer, in Arrow batches."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 16_384
BATCH_BYTES = 1 << 18
TOKEN_LIMIT = 4096

# A lone space between two ASCII letters or digits.
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def pieces_of(text: str, chunk: int, cut_ok: bool) -> Iterator[str]:
    """``text`` in parts of about ``chunk`` characters, cut at lone spaces
    between ASCII letters or digits; the space itself is left out (the model
    puts its own in front of each part). No such place: no cut."""
    at = 0
    while cut_ok and len(text) - at > chunk:
        m = _CUT.search(text, at + chunk)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.end()
    yield text[at:]


@functools.lru_cache(maxsize=2)
def load_counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """(function from texts to token counts, whether texts may be cut at
    spaces). SentencePiece: a cut is exact when a space mark is put in front
    of a text, white space is kept, and no piece has the mark behind another
    character, so that no merge can reach over it. ``.json``: texts stay whole."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        over = re.compile("[^▁]▁")
        inside = any(over.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size()))
        prefixed = sp.encode("a b") == sp.encode("a") + sp.encode("b")
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)], prefixed and not inside
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)], False


def count_texts(texts: list[str | None], path: str, chunk: int = CHUNK_CHARS, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Tokens of each text. Parts of all texts go to the library in batches
    of about equal bytes, whatever the texts' lengths."""
    count, cut_ok = load_counter(path)
    out = np.zeros(len(texts), np.int64)
    parts: list[str] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if parts:
            np.add.at(out, owner, count(parts))
            parts.clear()
            owner.clear()
            size = 0

    for i, t in enumerate(texts):
        if t:
            for p in pieces_of(t, chunk, cut_ok):
                parts.append(p)
                owner.append(i)
                size += len(p) + 16
                if size >= batch_bytes:
                    flush()
    flush()
    return out


def token_counts(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT, chunk: int = CHUNK_CHARS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row: ``doc_id, n_bytes, n_tokens,
    over_limit``. Counts are the library's for the whole text, without begin
    or end tokens. Null text is empty (0, 0); null and repeated ids are
    passed through; no rows give no rows; other columns are ignored. One scan,
    no shuffle; only lengths leave Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = count_texts(b.column("text").to_pylist(), path, chunk, batch_bytes)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    part = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = part.schema["doc_id"].dataType.simpleString()
    out = part.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
