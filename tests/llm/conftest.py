import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))

#: Null id, null text, empty and blank texts, ties, repeated rows, a very long text.
EDGES = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n\r ", None), (4, "same text here " * 30, "a"), (5, "same text here " * 30, "b"),
    (4, "same text here " * 30, "a"), (None, "no id " * 40, "a"), (None, None, None), (6, LONG, "b"), (7, LONG, "c"),
    (8, "é中\U0001f600 " * 60, "c"), (9, "x", "c"), (10, "\x0b\x0c", "c"),
]


@pytest.fixture()
def edges(docs):
    """EDGES with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    return docs(EDGES).withColumns({c: F.lit(1) for c in (
        "row", "t", "w", "l", "s", "h", "kept", "flags", "lines", "host", "key", "fp", "root", "id", "size", "block", "n_words",
        "words", "value", "target", "__id", "__key", "__h", "k1", "start", "end", "base", "found", "order", "range")})
