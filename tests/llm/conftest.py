from __future__ import annotations

import random

import pytest

from blotter.llm.common import prepare

# Extra columns whose names the operators use inside.
CLASHING = ("_id", "_th", "_text", "_row", "kept", "n", "t", "x", "words", "lost", "limits", "m")


@pytest.fixture(autouse=True)
def shipped(spark):
    prepare(spark)


@pytest.fixture
def documents(spark):
    """A documents table from texts or (doc_id, text) or (doc_id, text, lang, source), with clashing columns."""

    def build(*rows):
        full = []
        for place, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (place, row)
            doc_id, text, lang, source = (*row, "en", "src0")[:4] if len(row) == 2 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        frame = spark.createDataFrame(full, schema)
        for name in CLASHING:
            frame = frame.withColumn(name, frame["doc_id"] * 0 - 7)
        return frame

    return build


def prose(words: int, seed: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    text = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    for place in range(12, words, 13):
        text[place] += "\n"
    return " ".join(text)


# Nulls in any column, empty texts, white space only, repeated rows, equal ids with other texts.
ODD_ROWS = [
    (None, "a text without an id that is long enough to be a line", "en", "s"),
    (None, None, None, None),
    (1, None, "en", "s"),
    (2, "", "en", None),
    (3, " \t\n\x0b\n", None, "s"),
    (4, prose(120, 1), "en", "s"),
    (4, prose(120, 1), "en", "s"),
    (5, prose(90, 2), "en", "s"),
    (5, prose(90, 3), "de", "s"),
    (6, "one", "en", "s"),
    (7, "ONE", "en", "s"),
    (8, "Übung macht den Meister 日本語 \U0001f600", "de", "s"),
]
