"""Text expressions: Java-style regex split and word tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the word separator of the reference's word count, a run of
# Unicode non-word characters (Java regex with UNICODE_CHARACTER_CLASS).
WORD_SEPARATOR = r"(?U)\W+"

# The same class spelled out for engines whose \W is ASCII-only (RE2/DuckDB):
# letters, marks, decimal digits, letter numbers and connector punctuation.
WORD_SEPARATOR_EXPLICIT = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+"


def _is_run_pattern(pattern: str) -> bool:
    """A pattern ending in an unescaped greedy ``+``: its matches never touch,
    so a limit -1 split has at most one empty token at each end."""
    return pattern.endswith("+") and not pattern.endswith("\\+")


def java_split(s: Column, pattern: str) -> Column:
    """Split like ``java.util.regex.Pattern.split(s)``: a leading empty token
    is kept when the text starts with a separator, trailing empty tokens are
    dropped, ``''`` gives ``['']`` and a text made only of separators gives
    ``[]``. Spark's ``split`` (limit -1) keeps trailing empties, so they are
    trimmed with array functions afterwards - no second regex pass.

    The result refers to the split more than once; on large texts project the
    split into a column first and use ``java_trim`` (see ``words``)."""
    return java_trim(F.split(s, pattern, -1), s, pattern)


def java_trim(parts: Column, s: Column, pattern: str) -> Column:
    """Java's trailing-empty rule applied to a limit -1 split ``parts`` of ``s``."""
    n = F.size(parts)
    empty = F.array().cast("array<string>")
    if _is_run_pattern(pattern):
        trimmed = F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, 1, n - 1)).otherwise(parts)
        only_sep = (n == 2) & (F.element_at(parts, 1) == F.lit("")) & (F.element_at(parts, 2) == F.lit(""))
        kept = F.when(only_sep, empty).otherwise(trimmed)
    else:
        # 1-based position, from the end, of the last non-empty token (0: none)
        last = F.array_position(F.transform(F.reverse(parts), lambda x: x != F.lit("")), True)
        kept = F.when(last == 0, empty).otherwise(F.slice(parts, 1, n - last + 1))
    return F.when(s == F.lit(""), F.array(F.lit(""))).otherwise(kept)


def word_tokens(s: Column, pattern: str = WORD_SEPARATOR) -> Column:
    """Lower-case, then Java-style split on the word separator."""
    return java_split(F.lower(s), pattern)


def split_fields(s: Column, sep: str = ",") -> Column:
    """Delimited text to an array, keeping empty fields (limit -1)."""
    return F.split(s, sep if sep != "|" else r"\|", -1)


def field(arr: Column, i: int) -> Column:
    """0-based element access that yields null past the end (``[]`` raises
    under ANSI)."""
    return F.get(arr, i)
