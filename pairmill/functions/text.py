"""Tokens, canonical pairs and decades."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anything that is not a Unicode letter separates tokens.
SEPARATORS = r"[^\p{L}]+"

# Decades are counted from 1900; earlier ones are negative.
FIRST_YEAR = 1900


def words(text: Column) -> Column:
    """Maximal runs of letters, in order."""
    return F.array_remove(F.split(text, SEPARATORS), "")


def tokens(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Lower-cased words, in order."""
    found = words(F.lower(text))
    if stop_words:
        dropped = list(stop_words)
        found = F.filter(found, lambda t: ~t.isin(dropped))
    return found


def decade_of(year: Column) -> Column:
    """Decade index: 1900-1909 is 0, 2000-2009 is 10."""
    return F.floor((year - F.lit(FIRST_YEAR)) / F.lit(10)).cast("int")


def canonical_pair(a: Column, b: Column, lowercase: bool = True) -> tuple[Column, Column]:
    """The two words of an unordered pair, smaller first.

    With `lowercase` the pair ignores case; without it both the order and the words
    keep their case.
    """
    if lowercase:
        a, b = F.lower(a), F.lower(b)
    return F.least(a, b), F.greatest(a, b)
