import numpy as np
import pytest
import sentencepiece

from llm_fixtures import SF, edge_docs, make_docs, piece_model  # noqa: F401
from roadlens.llm import queries, token_counts


@pytest.fixture(scope="module")
def sp(piece_model):
    return sentencepiece.SentencePieceProcessor(model_file=piece_model)


def test_query_equals_whole_texts(spark, sp):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(sp.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


@pytest.mark.parametrize("chunk", [1, 2, 7, 64])
def test_cuts_are_safe(sp, piece_model, chunk):
    texts = ["a b c", " a  b ", "a▁ b x▁y z", "x y\nz  1 2", "é a é b", "<s> a </s> b", "", None, "日本 a b 日本", "aaaa " * 50, "a " * 99 + " "]
    got = token_counts.count_texts(texts, piece_model, chunk=chunk, batch_bytes=40)
    assert got.tolist() == [len(sp.encode(t or "")) for t in texts]


def test_json_tokenizer(spark, make_docs):
    from tokenizers import Tokenizer

    path = queries.model_path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> world", "", None, " x y "]
    got = token_counts.token_counts(make_docs(list(enumerate(texts))), path).collect()
    assert [r.n_tokens for r in sorted(got, key=lambda r: r.doc_id)] == [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_edges(spark, sp, piece_model, edge_docs, make_docs):
    got = token_counts.token_counts(edge_docs, piece_model).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in edge_docs.collect()]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens) for r in got))) == sorted(map(str, want))
    assert token_counts.token_counts(make_docs([]), piece_model).count() == 0
    assert np.array_equal(token_counts.count_texts([], piece_model), np.zeros(0))
