"""Rows that every operator has to take."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
# Names that operators use inside, so that a clash would show.
EXTRA = ("_row", "_text", "_key", "_mark", "node", "bucket", "uid", "label", "p0", "copies", "pieces_", "n_words", "found")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in EXTRA)

TEXTS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n ", None),
    (4, "one", "de"),
    (5, "the quick brown fox jumps over the lazy dog again and again " * 8, "en"),
    (6, "the quick brown fox jumps over the lazy dog again and again " * 8, "en"),
    (6, "the quick brown fox jumps over the lazy dog again and again " * 8, "en"),
    (7, "the  quick\tbrown\nfox jumps over the lazy dog again and again " * 8, "fr"),
    (8, LONG, "en"),
    (9, LONG + " tail", "en"),
    (None, "no id but a text of some words", "es"),
    (None, None, None),
    (10, "▁ öäü 日本語 😀\u2028 line\r\nbreak \x00 end", "de"),
    (11, "a " * 200, "en"),
]


def rows(spark, texts=TEXTS):
    full = [(i, t, lang, "src", len(t or ""), *["x"] * len(EXTRA)) for i, t, lang in texts]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, items):
    return spark.createDataFrame(items, "doc_id bigint, quality int, toxic int")
