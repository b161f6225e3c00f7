from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, o string, tag string, at int, starts int, k int, words string, quality string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators also use."""

    def make(rows):
        wide = [(i, x, "en", "o", "t", 1, 2, 3, "w", "q") for i, x in rows]
        return spark.createDataFrame(wide, SCHEMA)

    return make


PASSAGE = " ".join(f"shared{i}" for i in range(30))
ODD = [
    (1, "one two three " + PASSAGE + " end"),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "other start " + PASSAGE),
    (5, "other start " + PASSAGE),
    (None, "null key " + PASSAGE),
    (7, "short"),
    (8, "x " * 5000 + "tail"),
    (9, "Überraschung mit \x00 Zeichen 日本語 " + PASSAGE.upper()),
    (10, "one two three " + PASSAGE + " end"),
]


@pytest.fixture(scope="session")
def odd(frame):
    """Null key, null, empty, blank and very long texts, a repeated row, copies, a shared passage."""
    return frame(ODD)


@pytest.fixture(scope="session")
def odd_rows():
    return ODD


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
