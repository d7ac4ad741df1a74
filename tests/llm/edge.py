"""Rows that every operator has to stand: nulls, empty and very long texts, ties,
repeated rows, and columns named like the operators' own."""

import random

CLASHING = (
    "row", "size", "source_size", "target", "taken", "begin", "bucket", "shard", "slot", "kept",
    "component_id", "n_shingles", "found", "between", "n_pseudonyms", "at", "range_id", "v",
    "score", "n_words", "doc", "s", "ids", "id", "verdict", "fresh",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{name}` string" for name in CLASHING
)


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))


LONG = words(30_000, 5)
ROWS = [
    (1, None, "en", "a", 0),
    (2, "", None, "a", 0),
    (3, " \t\n ", "en", None, None),
    (4, "one", "en", "b", 3),
    (5, "One two", "en", "b", 7),
    (6, words(80, 1), "fr", "b", 500),
    (7, words(80, 1), "fr", "é", 500),
    (7, words(80, 1), "fr", "é", 500),
    (None, words(80, 1), None, None, None),
    (8, words(80, 1) + " tail", "fr", "c", 500),
    (9, LONG, "en", "c", len(LONG)),
    (10, "la " * 400, "en", "c", 1200),
    (11, "x" * 50_000, "en", None, 50_000),
    (12, "dup line here\n" * 3 + words(60, 2) + "\n#$%", "en", "d", 600),
    (None, None, None, None, None),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, *("x" for _ in CLASHING)) for r in rows], SCHEMA)


def empty(spark):
    return frame(spark, [])
