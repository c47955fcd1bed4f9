"""Frames of odd rows for the training-data operators."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, score double, win string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i % 977} of line {i % 13}" for i in range(40_000))
    rows = [(1, "Same Text here", "en", "a"), (2, "same text HERE", "en", None), (3, "same text here", None, "a"),
            (3, "same text here", None, "a"), (4, None, "de", "a"), (5, "", None, None), (None, "lonely text", "en", "b"),
            (None, None, None, None), (6, long, "en", "a"), (7, long + " tail", "en", "a"), (8, "   \n\t ", "fr", "a"),
            (9, "ÉCOLE É école", "fr", "c"), (10, "école É école", "fr", "c"), (11, "!!! 123 ???", "en", "c")]
    return spark.createDataFrame([(*r, len(r[1] or ""), 0, 0.5, "x") for r in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
