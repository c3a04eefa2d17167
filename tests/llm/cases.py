"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats, clashing further columns."""

import random

WORDS = ["alpha", "Beta", "gamma", "delta", "the", "of", "Épsilon", "ζήτα", "x1", "42", "don't", "end.", "a_b"]
LONG = " ".join(random.Random(1).choice(WORDS) for _ in range(30_000))

TEXTS = [
    (1, "the alpha of the Beta gamma"),
    (2, "the alpha of the Beta gamma"),
    (2, "the alpha of the Beta gamma"),
    (3, "THE ALPHA of the beta GAMMA"),
    (4, None),
    (5, ""),
    (6, "   \n\t "),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "!!! ??? ..."),
    (10, "日本語 のテキスト 😀"),
    (None, "a row without id"),
    (None, "a row without id"),
    (11, "nbsp and　wide\x00nul\x1cfs"),
    (12, LONG),
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, block string, codes int, row int, kind string, start int"


def frame(spark, rows=TEXTS):
    full = [(i, t, "en" if k % 2 else None, None, None, "x", "y", k, None, None, 1) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).coalesce(2)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
