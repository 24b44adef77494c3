from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, size int, key string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text[, lang[, source]]) rows, with further columns whose names clash with inner ones."""

    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), 0, "x", 1, "k") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = "lorem ipsum dolor sit amet consectetur " * 60_000  # over two million characters


@pytest.fixture(scope="session")
def odd(documents):
    """The cases every operator must have an answer for."""
    return documents(
        [
            (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "x", "en", None), (5, LONG, "en", "b"),
            (6, "same words here again", "en", "a"), (6, "same words here again", "en", "a"), (None, "no id at all", "en", "a"),
            (7, "...!!! 12345 —  ", "en", "a"), (8, "你好 \U0001f600 naïve", None, "c"),
        ]
    )
