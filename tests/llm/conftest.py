"""Hand-made documents for the operators."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first=0, lang="en"):
    rows = [(first + i, t, lang, f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, words=400):
    draw = random.Random(seed)
    names = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9))) for _ in range(words)]
    return " ".join(draw.choice(names) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing names."""
    rows = [
        (1, prose(1, 120), "en", "a", 5),
        (1, prose(1, 120), "en", "a", 5),
        (1, prose(2, 90), None, None, None),
        (2, None, "de", "a", None),
        (3, "", "de", None, 0),
        (None, prose(1, 120), "en", "b", 1),
        (None, None, None, None, None),
        (4, " \t\n\x0b\x0c\r ", "fr", "b", 7),
        (5, prose(3, 30_000), "en", "c", 1),
        (6, "é" * 300 + " ß " + "🙂" * 40, "de", "c", 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", "1 AS kept", "'x' AS fp", "2 AS text_key", "3 AS n_words", "4 AS sampled", "5 AS _words")
