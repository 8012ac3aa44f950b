"""Column functions around article labelling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..defaults import CATEGORIES, CATEGORY_TERMS, PROMPT
from .text import col, default_empty, truncate_text


def build_prompt(
    title: Column | str,
    content: Column | str,
    categories: Sequence[str] = CATEGORIES,
    max_chars: int | None = None,
) -> Column:
    """The full classifier question for one article, with the whole text or its first ``max_chars`` characters."""
    text = PROMPT.replace("{categories}", "\n".join(f"- {c}" for c in categories))
    head, rest = text.split("{title}")
    middle, tail = rest.split("{content}")
    return F.concat(
        F.lit(head), default_empty(title), F.lit(middle),
        default_empty(content) if max_chars is None else truncate_text(default_empty(content), max_chars, "..."), F.lit(tail),
    )


def normalize_category(answer: Column | str, allowed: Sequence[str] | None = None) -> Column:
    """Stripped answer; '' -> 'unknown'; NULL (a failed call) -> 'error'.

    With ``allowed`` an answer outside the list also becomes 'unknown'.
    """
    raw = col(answer)
    name = F.regexp_replace(raw, r"^[\s\x{85}\x{a0}]+|[\s\x{85}\x{a0}]+$", "")
    valid = name != ""
    if allowed is not None:
        valid = valid & name.isin(list(allowed))
    return F.when(raw.isNull(), "error").when(valid, name).otherwise("unknown")


def keyword_category(
    title: Column | str,
    content: Column | str,
    terms: Mapping[str, Sequence[str]] = CATEGORY_TERMS,
    fallback: str = "miscellaneous",
) -> Column:
    """Category whose terms occur most often as distinct hits; earlier category on ties."""
    text = F.lower(F.concat_ws(" ", default_empty(title), default_empty(content)))
    names = list(terms)

    def ballot(t: Column, rank: int) -> Column:
        hits = reduce(lambda a, b: a + b, [F.contains(t, F.lit(k.lower())).cast("int") for k in terms[names[rank]]])
        return F.struct(hits.alias("hits"), F.lit(-rank).alias("rank"), F.lit(names[rank]).alias("name"))

    best = F.transform(F.array(text), lambda t: F.greatest(*[ballot(t, i) for i in range(len(names))]))[0] \
        if len(names) > 1 else F.transform(F.array(text), lambda t: ballot(t, 0))[0]
    return F.when(best["hits"] > 0, best["name"]).otherwise(fallback)


