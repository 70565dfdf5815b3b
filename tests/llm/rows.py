"""Small documents with every odd case the operators define."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, part int"


def prose(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join(
        "".join(draw.choice(("ka", "lo", "mi", "ne", "ru", "ta", "vo")) for _ in range(draw.randrange(1, 4)))
        for _ in range(count)
    )


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, a very long one, repeated rows, odd characters."""
    base = prose(1, 300)
    texts = [
        None, "", " \t\n ", "a", base, base, base + " more words", "x" * 70_000, prose(2, 30_000),
        "日本語 ▁ text\r\nß €", "7 7 7 !!!", "\n\n", base.upper(),
    ]
    rows = [(n, t, ("en", None)[n % 2], ("a", "b", None)[n % 3], 1, "clash", 3) for n, t in enumerate(texts)]
    return [*rows, rows[4], rows[0], (None, base, None, None, None, None, None)]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
