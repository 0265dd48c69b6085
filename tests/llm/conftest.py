import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside
CLASH = ("component", "cid", "n", "score", "block", "whole", "kept", "held_out", "doc", "of", "sha", "spans", "piece")

PROSE = (
    "The quick brown fox jumps over the lazy dog while seven wise owls watch from a tall old oak tree. "
    "Nobody expected the weather to change so quickly on that bright morning near the quiet river bank."
)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, copies, near copies, ties, repeated rows."""
    words = PROSE.split()
    near = " ".join(words[:30] + ["stormy"] + words[31:])
    long = " ".join(f"w{i % 7919}x{i % 13}" for i in range(30000))
    return [
        (1, PROSE, "en", "a", len(PROSE)),
        (2, None, "en", "a", None),
        (3, "", "en", None, 0),
        (4, PROSE, None, "b", len(PROSE)),
        (5, PROSE + " Indeed it was a day to remember.", "en", "b", 0),
        (6, near, "de", "b", 1),
        (None, PROSE, "en", "a", 1),
        (7, long, "en", "c", len(long)),
        (8, "12 34 -- !!", "en", "c", 11),
        (9, "word", "en", "c", 4),
        (9, "word", "en", "c", 4),
        (10, " \t\n ", "en", "c", 4),
        (11, "un  deux trois été \U0001f642 THE the The", "fr", "c", 5),
        (12, " ".join(["again"] * 200), "en", "c", 5),
        (13, "Line one\nLine one\n\nLine two\nLine one", "en", "c", 5),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, COLUMNS)
    for c in CLASH:
        from pyspark.sql import functions as F

        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
