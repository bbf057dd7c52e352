"""Small frames for the edge cases that every operator must bear."""

from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, start int"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from (doc_id, text[, lang[, source]]) rows, with extra columns whose names clash with outputs."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, 7.5, 1, None) for r in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, one long text, other scripts."""
    long = " ".join(f"word{i % 97}" for i in range(30_000))
    return [
        (1, "plain words in a row"), (1, "plain words in a row"), (2, None), (3, ""), (4, " \n\t "), (None, "no id here"), (None, None),
        (5, "Ünï cödé ñandú 文字   x"), (6, long), (7, "a"), (8, "same id, text one"), (8, "same id, text two"), (9, "word " * 200),
    ]


@pytest.fixture(scope="session")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 3, 0.5) for i, v in rows], "vec_id long, embedding array<float>, label int, score double").repartition(3)

    return make
