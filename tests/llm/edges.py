"""Awkward documents: nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""

from __future__ import annotations

CLASH = (
    "size long, score double, spans string, n_words long, kept boolean, shard int, target double, n_links long, "
    "class_id long, tail double, token_ids string, n_tokens string, Label int, rank int, number int, block int, `_n` int"
)
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
LONG = "word " * 60_000 + "password=abcdefghijkl0123 end"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def documents(spark):
    plain = " ".join(WORDS * 4)
    rows = [
        (1, plain, "en", "a"),
        (1, plain, "en", "a"),  # repeated row
        (2, plain, None, None),  # copy
        (3, plain + " extra", "en", "b"),  # near copy
        (4, None, "en", "a"),
        (5, "", "en", "a"),
        (None, None, None, None),
        (None, "no id here", "fr", "b"),
        (None, "no id here", "fr", "b"),
        (6, " \n\t ", "de", "a"),
        (7, LONG, "en", "a"),
        (8, "é😀 漢字\u0085  x", "zz", "c"),
        (9, "one two", "en", "a"),
        (10, "one\ntwo", "en", "a"),
    ]
    full = [(i, t, a, s, len(t or ""), *([None] * 17)) for i, t, a, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (3, 1, 0), (7, 0, 1), (9, None, None), (None, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
