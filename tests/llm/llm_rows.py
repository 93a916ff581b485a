"""Rows and fixtures that the tests of the llm operators share."""

from __future__ import annotations

import re

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that an operator could name its own.
CLASHES = "score double, component_id long, row long, node long, size long, key string, n long, taken long, _key string, hash string"

LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(60_000))


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text[, lang, source]) rows, with columns that clash."""

    def make(rows: list[tuple], clash: bool = True):
        full = [(*r, *[None] * (4 - len(r)), None) for r in rows]
        extra = (None,) * len(CLASHES.split(", "))
        if clash:
            return spark.createDataFrame([(*r, *extra) for r in full], f"{DOC_SCHEMA}, {CLASHES}")
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture
def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    text = "The river begins in the hills and runs past three villages and a mill to the sea"
    return [
        (1, text, "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, " \t\n ", "en", "b"),
        (5, LONG, "en", "a"),
        (6, text, "en", "b"),
        (1, text, "en", "a"),
        (None, text, None, "a"),
        (None, None, None, None),
        (7, "1234 -- ??", "de", "c"),
        (8, "éß \U00010400\U0001f600 x", "fr", None),
        (9, "one", "en", "a"),
    ]


def words_of(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)
