"""Token and text expressions on columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: whitespace as Python's ``str.split()`` sees it.  ``(?U)`` adds the
# Unicode spaces to ``\s``; U+001C to U+001F are separators in Python only.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def words(text: Column) -> Column:
    """Whitespace-separated words, no empty strings; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITESPACE), "")


def keep_tokens(tokens: Column, stopwords: Iterable[str] = (), min_len: int = 2) -> Column:
    """Tokens of at least ``min_len`` characters that are not stopwords."""
    stop = sorted(set(stopwords))
    # more than ten literals become a hash-set lookup in Catalyst
    def keep(token: Column) -> Column:
        long_enough = F.char_length(token) >= min_len
        return long_enough & ~token.isin(stop) if stop else long_enough

    return F.filter(tokens, keep)


def non_empty(text: Column) -> Column:
    """Non-null and at least one character; blanks count as text."""
    return text.isNotNull() & (F.char_length(text) > 0)
