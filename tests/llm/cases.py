"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "class_id string, slot string, gone string, score string, node long, host string"
)
EXTRA = ("x", "y", "z", "s", 7, "h")


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


def prose(seed: int, words: int, line: int = 12) -> str:
    drawn = random.Random(seed)
    made = ["".join(drawn.choices("abcdefghiklmnoprstu", k=drawn.randint(2, 9))) for _ in range(words)]
    lines = [" ".join(made[i : i + line]) for i in range(0, words, line)]
    return "\n".join(lines)


def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing names."""
    long_text = prose(99, 30_000)
    rows = [
        row(1, prose(1, 120)),
        row(2, None),
        row(3, ""),
        row(4, "   \n\n\t "),
        row(5, prose(1, 120)),
        row(6, prose(6, 80), None, None),
        row(6, prose(6, 80), None, None),
        row(7, prose(7, 60)),
        row(7, prose(8, 60), "fr", "b"),
        row(None, prose(9, 60), "de", "b"),
        row(None, None, None, None),
        row(8, "x" * 5000),
        row(9, long_text, "fr", "c"),
        row(10, "é漢😀 \x00 <|endoftext|> !", "fr", "c"),
        (11, None, None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def documents(spark, texts, **columns):
    """doc_id 0, 1, 2, ... with these texts, over several partitions."""
    rows = [
        (i, t, columns.get("lang", ["en"] * len(texts))[i], columns.get("source", ["a"] * len(texts))[i])
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
