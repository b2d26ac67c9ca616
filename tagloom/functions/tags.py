"""Tag-set expressions: split, filter, per-label targets, index coding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a tag is a maximal run of characters other than '<' and '>'.
TAG_PATTERN = "[^<>]+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_tags(col: str | Column) -> Column:
    """``'<Python><c#>'`` -> ``['python', 'c#']`` (lower-cased, order kept).

    Same result as ``RegexTokenizer(pattern=TAG_PATTERN, gaps=False)`` but as
    a plain SQL expression. ``''`` gives an empty array, NULL stays NULL.
    """
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TAG_PATTERN), 0)


def keep_tags(col: str | Column, tags: Sequence[str]) -> Column:
    """Keep only the listed tags; order and repeats of the kept ones stay."""
    allowed = list(tags)
    return F.filter(_c(col), lambda t: t.isin(allowed))


def target_column(col: str | Column, tag: str) -> Column:
    """0.0/1.0 binary-relevance target for one tag; a NULL tag set gives 0.0."""
    return F.coalesce(F.array_contains(_c(col), F.lit(tag)).cast("double"), F.lit(0.0))


def label_indexes(col: str | Column, vocabulary: Sequence[str], keep_unknown: bool = False) -> Column:
    """Tag strings -> array<double> of vocabulary positions (0-based).

    Unknown tags are dropped, or (``keep_unknown``) coded as -1.0 so that they
    still count as missed labels in the metrics.
    """
    vocab = F.create_map(*[x for i, t in enumerate(vocabulary) for x in (F.lit(t), F.lit(float(i)))]) \
        if vocabulary else F.create_map().cast("map<string,double>")
    coded = F.transform(_c(col), lambda t: F.coalesce(F.element_at(vocab, t), F.lit(-1.0)))
    if keep_unknown:
        return coded
    return F.filter(coded, lambda i: i >= 0)


def decode_indexes(col: str | Column, vocabulary: Sequence[str]) -> Column:
    """array<double> of positions -> array<string> tags."""
    names = F.array(*[F.lit(t) for t in vocabulary]) if vocabulary else F.array().cast("array<string>")
    return F.transform(_c(col), lambda i: F.element_at(names, i.cast("int") + 1))
