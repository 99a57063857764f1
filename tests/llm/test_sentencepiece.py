import struct

import pytest
import sentencepiece
import xxhash

import numpy as np
from llm_fixtures import SF, edge_docs, make_docs, piece_model  # noqa: F401
from roadlens.llm import queries, sentencepiece_codec as codec


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(byte_fallback):
    words = [("▁", -2.0), ("▁a", -1.5), ("▁ab", -1.0), ("b", -2.5), ("c", -2.5), ("bc", -3.0), ("a", -2.2), ("▁abc", -4.5), ("ab", -2.9)]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    pieces += [(w, s, 1) for w, s in words]
    body = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    body += field(2, field(3, 1) + field(4, len(pieces)) + field(35, int(byte_fallback)))
    return body + field(3, field(1, b"identity") + field(3, 1) + field(4, 1) + field(5, 1))


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_unigram(tmp_path, byte_fallback):
    path = tmp_path / "u.model"
    path.write_bytes(unigram_model(byte_fallback))
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    c = codec.Codec(str(path), 1)
    for t in ["abc ab a", "  ab   bc ", "abcabc", "", " ", "b c"] + (["xé a"] if byte_fallback else []):
        assert c.encode([t])[0].tolist() == sp.encode(t), t
        assert c.decode(np.array(sp.encode(t))) == sp.decode(sp.encode(t))


def test_query(spark, piece_model):
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op3_sentencepiece(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(sp.encode(texts[r.doc_id]), np.int32)
        assert (r.n_tokens, r.ids_hash, r.round_trip, r.parity) == (len(ids), xxhash.xxh3_64_hexdigest(ids.tobytes()), True, True)


def test_odd_texts(piece_model):
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    c = codec.Codec(piece_model, 1)
    odd = ["", " ", "  a  b ", "a\tb\n\nc", "<s> x </s> <unk>", "▁a ▁▁ b", "é日本語\U0001f600​", "a▁ b", "\x00x", "x" * 300, "ﬁ ㍻ ½"]
    for t, ids in zip(odd, c.encode(odd), strict=True):
        assert ids.tolist() == sp.encode(t), t
        if "▁" not in t:
            assert c.decode(ids) == t


def test_edges(spark, piece_model, edge_docs, make_docs):
    got = codec.encode(edge_docs, piece_model).collect()
    want = [(r.doc_id, (r.text or "").replace("▁", " ")) for r in edge_docs.collect()]
    assert sorted(map(str, ((r.doc_id, r.decoded) for r in got))) == sorted(map(str, want))
    assert all(r.parity for r in got)
    assert codec.encode(make_docs([]), piece_model).count() == 0
    out = codec.with_tokens(edge_docs, piece_model)
    assert out.columns == [*edge_docs.columns, "token_ids"]
    again = codec.with_tokens(out, piece_model)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
