"""Text expressions: SQL twins of the Tokenizer and StopWordsRemover stages.

The ML pipeline uses the built-in stages; these twins compute the same tokens
as plain expressions, for exact-term operators (exact TF-IDF, linear SQL
scoring) and for oracle checks.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace class of the tokenizer (Java's \s).
WHITESPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"


@functools.cache
def stop_words() -> tuple[str, ...]:
    """Spark's default English stop words."""
    from pyspark.ml.feature import StopWordsRemover
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(col: str | Column) -> Column:
    """Lower-case, split on single whitespace characters.

    Matches ``Tokenizer``: repeated blanks give empty tokens, a leading blank
    gives a leading empty token, trailing blanks give none, ``''`` gives
    ``['']`` and an all-blank text gives ``[]``.
    """
    low = F.lower(_c(col))
    trimmed = F.regexp_replace(low, WHITESPACE_CLASS + "+$", "")
    return (F.when(low == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, WHITESPACE_CLASS, -1)))


def remove_stop_words(col: str | Column, drop: list[str] | None = None) -> Column:
    """Drop stop words, comparing case-insensitively (``''`` is kept)."""
    words = [w.lower() for w in (stop_words() if drop is None else drop)]
    return F.filter(_c(col), lambda t: ~F.lower(t).isin(words)) if words else _c(col)
