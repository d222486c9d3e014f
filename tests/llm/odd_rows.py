"""Awkward rows shared by the tests: nulls, empty, very long, repeated and tied texts, clashing columns."""

from __future__ import annotations

import pytest

LONG = "tok " * 30000 + "a" * 20000 + " " + "x@" * 2000 + " 1.2" * 500
ROWS = [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "12345 !!!", "de"),
        (5, "one two three four", "en"), (6, "One two THREE four", "en"), (7, "one two three four", None),
        (7, "one two three four", None), (8, LONG, "en"), (9, "mail a.b@c.example.org or +49 (30) 123-4567 x", "en"),
        (None, "row without an id has five words and more", "en"), (10, "Ärger über Öl <|endoftext|> und 日本語 😀", "de")]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """documents with extra columns whose names operators use themselves."""
    from meterwise.llm.common import ship

    ship(spark)
    schema = ("doc_id long, text string, lang string, source string, n_chars long, id long, key string, n_words string, "
              "score string, sequence_id string, features int, count int, size int")
    return spark.createDataFrame([(i, t, k, "s", len(t or ""), 5, "k", "n", "s", "q", 1, 2, 3) for i, t, k in ROWS], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
