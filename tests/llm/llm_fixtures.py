"""Tables and fixtures of the training-data tests (``spark`` comes from the\nfolder above)."""

import pytest

from roadlens.llm.queries import PIECE_MODEL, model_path

SF = "/root/testdata/sf0.001"

# id, text, and columns that clash with names used inside the operators
DOC = "doc_id long, text string, lang string, source string, n_chars long, n int, k1 string, row int, label string"


@pytest.fixture(scope="session")
def piece_model():
    return model_path(PIECE_MODEL)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)"""
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 1, "x", 2, "y") for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    """Nulls, empty and very long texts, ties, repeated rows and ids."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    return make_docs([
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (5, "another text"), (None, "one"), (None, None),
        (6, long_text), (7, long_text + " end"), (8, "é ß 日本 \U0001f600 ▁x"), (9, "A B C D E F"), (10, "a b c d e f"),
    ])
