import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, repeated and tied rows,
    and extra columns whose names operators use inside."""
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta", "en", "a", 9),
        (2, "ALPHA beta gamma delta epsilon zeta", "en", "a", 9),
        (3, "", "en", "b", 0), (4, None, None, None, None), (None, None, None, None, None),
        (None, "alpha beta gamma delta epsilon zeta", "en", "a", 9),
        (5, "one", "de", "b", 1), (5, "one", "de", "b", 1), (5, "two", "de", None, 1),
        (6, "É é 日本 🙂\x00 \t\n", "fr", "c", 1), (7, "word " * 3000, "en", "a", 15000), (8, "x" * 9000, "en", "c", 1),
        (9, "12 !? ..", "es", "c", 8),
    ]
    return spark.createDataFrame(
        [(*r, "k", 1, 2, "t") for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, key string, no int, size int, _kept string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
