"""Text column functions: all JVM-side expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace of Python's str pattern \s: Unicode White_Space plus the four separators FS-US.
# Measured against spelled-out character classes and translate(): this form is the fastest.
_WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def collapse_whitespace(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), _WHITESPACE, " "))


def content_hash(content: Column | str) -> Column:
    """MD5 of the lower-cased text with whitespace runs collapsed; missing text hashes as ''."""
    return F.md5(collapse_whitespace(F.lower(default_empty(content))))


def text_length(c: Column | str) -> Column:
    """Length in characters, as a long."""
    return F.length(col(c)).cast("long")


def truncate_text(c: Column | str, n: int, ellipsis: str = "") -> Column:
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit(ellipsis))).otherwise(c)


def regex_contains(c: Column | str, pattern: str) -> Column:
    """Case-sensitive regex search."""
    return col(c).rlike(pattern)


def _any_of(conditions: Sequence[Column]) -> Column:
    """OR as a balanced tree, so that long lists do not nest deeply."""
    conditions = list(conditions)
    while len(conditions) > 1:
        conditions = [
            reduce(lambda a, b: a | b, conditions[i : i + 2]) for i in range(0, len(conditions), 2)
        ]
    return conditions[0]


def minimal_terms(terms: Sequence[str]) -> list[str]:
    """Terms without those that contain another term: a substring test gives the same answer."""
    unique = list(dict.fromkeys(terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def lower_contains(
    c: Column | str,
    terms: Sequence[str],
    lower_terms: bool = True,
    word_boundary: bool = False,
) -> Column:
    """True if any term is a substring of the lower-cased text; an empty list gives false.

    ``lower_terms=False`` takes the terms as they are. ``word_boundary=True`` wants whole words.
    """
    if not terms:
        return F.lit(False)
    terms = [t.lower() for t in terms] if lower_terms else list(terms)
    if word_boundary:
        return F.lower(col(c)).rlike(r"(?U)\b(?:" + "|".join(_quote(t) for t in terms) + r")\b")
    terms = minimal_terms(terms)
    # The one-element array makes Spark lower-case the text once per row, not once per term.
    return F.exists(F.array(F.lower(col(c))), lambda t: _any_of([F.contains(t, F.lit(k)) for k in terms]))


def _quote(term: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in term)
