import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row int, mark string, kept string, key int, n int"


def frame(spark, rows):
    """Documents of (doc_id, text, lang, source), with further columns whose names clash with inner ones."""
    full = [(i, t, g, s, None if t is None else len(t), "x", 1, "m", "k", 2, 3) for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def prose():
    """Made-up prose: ``prose(n, seed)`` gives n words."""
    def words(n, seed=0):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n))

    return words


@pytest.fixture(scope="session")
def docs(spark):
    return lambda rows: frame(spark, rows)


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls in every column, empty and long texts, ties, repeated rows and ids, other scripts."""
    long = prose(3000, 5)
    return [
        (None, prose(60, 1), "en", "a"), (1, None, None, None), (2, "", "en", "a"), (3, prose(60, 1), "de", "b"),
        (3, prose(60, 1), "de", "b"), (4, prose(60, 2), None, "b"), (4, prose(60, 3), "fr", None), (5, long, "en", "a"),
        (6, long + " end", "en", "a"), (7, "\n\n \t\n", "en", "c"), (8, "Füße über Öl 漢字 😀 é", "de", "c"), (9, "one", "en", "c"),
        (-5, prose(60, 4), "en", "a"), (10, "x" * 5000, "en", "a"), (None, None, "en", "a"),
    ]


@pytest.fixture(scope="session")
def odd(docs, odd_rows):
    return docs(odd_rows)


@pytest.fixture(scope="session")
def empty(docs):
    return docs([])
