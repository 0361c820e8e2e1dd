"""Rows for the tests: ordinary ones, and the odd ones every operator must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, fingerprint int, _slice int"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows; clashing column names."""
    long = prose(1, 60_000, 5000)
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "Ünïcode ÉCOLE — 漢字 текст\x00 end"), (6, long),
        (7, prose(2, 80)), (7, prose(2, 80)), (7, prose(3, 80)), (None, prose(2, 80)), (None, None), (None, "lost id"),
        (8, prose(2, 80).upper()), (9, "  two  spaces\n\nlines\n"), (10, "<|endoftext|> it's 12's"),
    ]
    rows = [(i, t, "en", "a", len(t or ""), "x", 1, 2) for i, t in texts]
    return [*rows, (11, "les mots et la suite", None, None, None, None, None, None)]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same_rows(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)
