from __future__ import annotations

import pytest

#: Columns that the operators use as names of their own.
CLASHING = (
    "id", "row", "fp", "row_key", "kept_id", "size", "of", "copies", "nth", "given", "rules", "lines", "whole_text",
    "host", "place", "block", "bucket", "part", "order", "number", "value", "rank", "code0", "label", "held_out",
    "m", "kind", "hits", "start", "odds", "text_hash", "n_words", "component",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHING
)


def words(n: int, start: int = 0) -> str:
    return " ".join(f"w{i}" for i in range(start, start + n))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, source) with every clashing column set."""

    def make(rows):
        full = [(i, t, "en", s, len(t or ""), *["x"] * len(CLASHING)) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def messy(docs_of):
    """Nulls, empty and white-space texts, a very long one, copies, ties and repeated rows."""
    long_text = "\n".join(words(50, 50 * i) for i in range(400))
    return docs_of(
        [
            (None, words(60), "a"),
            (1, None, "a"),
            (2, "", None),
            (3, " \t\n\x0b ", "b"),
            (4, long_text, "b"),
            (5, words(80, 5), "a"),
            (6, words(80, 5), "b"),
            (7, words(80, 5), None),
            (8, "Ärger über Öl 日本 語 \U0001f600 x@y.example.com +1 (234) 555-0199 " + words(55), "a"),
            (9, "one", "c"),
            (9, "one", "c"),
            (10, "<|endoftext|>  two  spaces ", "c"),
        ]
    )


@pytest.fixture(scope="session")
def nothing(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
