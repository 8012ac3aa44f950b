"""Language guess from function words, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "was", "for", "with", "as", "on", "are", "by", "have"],
    "fr": ["le", "la", "les", "des", "et", "un", "une", "que", "qui", "dans", "pour", "sur", "pas", "au", "est"],
    "de": ["der", "die", "das", "und", "ein", "eine", "ist", "nicht", "mit", "von", "zu", "den", "im", "auf", "sich"],
    "es": ["el", "los", "las", "que", "y", "por", "una", "con", "para", "del", "su", "como", "se", "no", "es"],
}


def _found_words(text: Column, words: Mapping[str, Sequence[str]]) -> Column:
    """The function words of any language that occur in the whole text: one pass, a short array."""
    every = list(dict.fromkeys(w for ws in words.values() for w in ws))
    return F.array_intersect(F.split(F.lower(text), r"[^\p{L}]+"), F.array(*[F.lit(w) for w in every]))


def _votes(found: Column, words: Sequence[str]) -> Column:
    return F.size(F.array_intersect(found, F.array(*[F.lit(w) for w in words]))).cast("long")


def language_votes(text: Column | str, words: Mapping[str, Sequence[str]] = FUNCTION_WORDS) -> dict[str, Column]:
    """Per language, how many of its function words occur in the whole text."""
    found = _found_words(col(text), words)
    return {lang: _votes(found, ws) for lang, ws in words.items()}


def detect_language(text: Column | str, words: Mapping[str, Sequence[str]] = FUNCTION_WORDS) -> Column:
    """Language with most votes; 'unknown' on a tie for the lead or without any vote."""

    def ballots(found: Column) -> Column:
        rows = [F.struct(_votes(found, ws).alias("votes"), F.lit(lang).alias("lang")) for lang, ws in words.items()]
        return F.sort_array(F.array(*rows), asc=False)

    # One-element arrays: the words are looked up once, the ballots counted once, whatever reads them.
    counted = F.transform(F.array(_found_words(col(text), words)), ballots)
    winner = F.transform(
        counted,
        lambda b: F.when((b[0]["votes"] > 0) & (b[0]["votes"] > F.coalesce(F.get(b, F.lit(1))["votes"], F.lit(0))), b[0]["lang"]),
    )
    return F.coalesce(winner[0], F.lit("unknown"))
