"""Page -> article: title, main text, language, quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import LANGUAGES, MIN_TEXT_CHARS
from ..functions import default_empty, detect_language, source_domain, truncate_text
from ..functions.html_outline import BLOCK, html_outline


def with_outline(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``outline``; ``html`` is text or UTF-8 bytes (invalid bytes are dropped)."""
    return pages.withColumn("outline", html_outline(F.col(html)))


def extract_title(outline: Column) -> Column:
    return outline["title"]


def extract_main_text(outline: Column, min_chars: int = MIN_TEXT_CHARS) -> Column:
    """First <main>, else first <article>, else a container div, else the longest p or div, each only
    if longer than ``min_chars``; else all text."""
    elements = F.arrays_zip(outline["kinds"], outline["starts"], outline["sizes"], outline["chars"])
    big = F.filter(elements, lambda e: e["chars"] > min_chars)
    ranked = F.transform(
        big,
        lambda e, i: F.struct(
            e["kinds"].alias("kind"),
            F.when(e["kinds"] == BLOCK, -e["chars"]).otherwise(0).alias("size_rank"),
            i.alias("position"),
            e["starts"].alias("start"),
            e["sizes"].alias("size"),
        ),
    )
    # One-element array: the choice is made once and its fields are then read twice.
    chosen = F.transform(
        F.array(F.array_min(ranked)),
        lambda b: F.when(b.isNull(), F.array_join(outline["texts"], " ")).otherwise(
            F.array_join(F.slice(outline["texts"], b["start"] + 1, b["size"]), " ")
        ),
    )
    return chosen[0]


def longest_block(outline: Column, min_chars: int = MIN_TEXT_CHARS) -> Column:
    """Longest p or div text above ``min_chars``, the first one on ties; NULL if there is none."""
    elements = F.arrays_zip(outline["kinds"], outline["starts"], outline["sizes"], outline["chars"])
    blocks = F.filter(elements, lambda e: (e["kinds"] == BLOCK) & (e["chars"] > min_chars))
    best = F.array_min(
        F.transform(blocks, lambda e, i: F.struct((-e["chars"]).alias("rank"), i.alias("at"), e["starts"], e["sizes"]))
    )
    return F.transform(
        F.array(best), lambda b: F.array_join(F.slice(outline["texts"], b["starts"] + 1, b["sizes"]), " ")
    )[0]


def reject_reason(
    text: Column | str,
    language: Column | str,
    min_chars: int = MIN_TEXT_CHARS,
    languages: Sequence[str] = LANGUAGES,
) -> Column:
    """Why a page is not an article; NULL if it is one."""
    text = F.col(text) if isinstance(text, str) else text
    language = F.col(language) if isinstance(language, str) else language
    return (
        F.when(F.length(default_empty(text)) < min_chars, "text_too_short")
        .when(~F.coalesce(language.isin(list(languages)), F.lit(False)), "language_not_allowed")
    )


def quality_gate(
    rows: DataFrame,
    min_chars: int = MIN_TEXT_CHARS,
    languages: Sequence[str] = LANGUAGES,
    text: str = "content",
    language: str = "language",
) -> DataFrame:
    """Rows long enough and in an allowed language."""
    return rows.filter((F.length(text) >= min_chars) & F.col(language).isin(list(languages)))


def extract_pages(
    records: DataFrame,
    url: str = "target_uri",
    html: str = "payload",
    status: Column | str = "status_code",
    min_chars: int = MIN_TEXT_CHARS,
    max_chars: int | None = None,
    languages: Sequence[str] = LANGUAGES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per page with the article fields and ``reject_reason``.

    Rejected pages stay in, so that the costly parse feeds both the articles and the error table. Records
    that bring their ``outline`` are not parsed again.
    """
    text = extract_main_text(F.col("outline"), min_chars)
    content = F.col("_text") if max_chars is None else truncate_text("_text", max_chars)
    parsed = records if "outline" in records.columns else with_outline(records, html)
    out = parsed.select(
        *keep, F.col(url).alias("url"), default_empty(status).alias("status_code"),
        extract_title(F.col("outline")).alias("title"), text.alias("_text"),
    ).withColumn("language", detect_language("_text"))
    fields = F.struct(
        "url", "title", content.alias("content"), source_domain("url").alias("source_domain"), "language",
        "status_code", reject_reason("_text", "language", min_chars, languages).alias("reject_reason"),
    )
    # Unpacking through a generator keeps later filters above it: text and language are computed once.
    return out.select(*keep, F.inline(F.array(fields)))


def accepted(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(extracted: DataFrame) -> DataFrame:
    """Rejected pages as rows of the error table."""
    return extracted.filter(F.col("reject_reason").isNotNull()).select(
        F.col("reject_reason").alias("error_type"),
        F.concat_ws(" ", F.lit("page rejected:"), "reject_reason").alias("message"),
        F.create_map(F.lit("url"), F.col("url"), F.lit("language"), F.col("language")).alias("context"),
    )


def extract_articles(records: DataFrame, **options) -> DataFrame:
    """Only the pages that pass the gate."""
    return accepted(extract_pages(records, **options))
