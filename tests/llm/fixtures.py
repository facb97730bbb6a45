"""Small tables with every awkward case: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not mounted")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def awkward_rows():
    words = SENTENCE.split()
    long_text = " ".join(words[(i * i) % 20] + str(i % 97) for i in range(60_000))
    return [
        (1, SENTENCE, "en", "a", 1), (2, SENTENCE, "en", "a", 1), (3, SENTENCE.upper(), None, None, None),
        (4, None, "en", "a", 0), (5, "", "en", "a", 0), (6, " \t\n ", None, "b", 3), (7, "1234 5678 !!", "de", "b", 3),
        (8, long_text, "en", "b", 9), (9, "one", "fr", "b", 3), (9, "one", "fr", "b", 3), (None, "ein zwei drei vier", "de", None, None),
        (None, None, None, None, None), (10, "Ünïcödé ñandú 漢字 текст 🙂 line\nline two\nline\n", "es", "c", 5),
        (11, "stupid idiot trash clown moron loser " * 3, "en", "c", 5), (12, " ".join(reversed(words)), "en", "c", 5),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


#: Names that operators use inside, in other types than theirs.
CLASHES = [
    "score", "toxic_score", "quality_score", "print", "key", "root", "rows", "component_id", "kept_print", "kept_component", "kept_rows",
    "contaminated", "label", "n", "words", "chunk", "shard", "length", "part", "first", "h", "HELD_OUT",
]


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)
