"""Resumable labelling of articles."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..defaults import CATEGORIES, CATEGORY_TERMS
from ..functions import build_prompt, keyword_category, normalize_category
from ..schemas import CLASSIFICATIONS

Scorer = Callable[[DataFrame], DataFrame]


def keyword_scorer(terms: Mapping[str, Sequence[str]] = CATEGORY_TERMS, fallback: str = "miscellaneous") -> Scorer:
    """Label by term votes, all in column expressions."""
    return lambda rows: rows.select(
        "url", keyword_category("title", "content", terms, fallback).alias("category")
    )


def callable_scorer(
    answer: Callable[[str], str],
    categories: Sequence[str] = CATEGORIES,
    strict: bool = False,
    max_chars: int | None = None,
) -> Scorer:
    """Label with a Python function from prompt to answer, in Arrow batches. A failed call is 'error'.

    The prompt has the whole text, or its first ``max_chars`` characters where a model takes no more.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def safe(prompt: str) -> str | None:
            try:
                return answer(prompt) or ""
            except Exception:
                return None

        for batch in batches:
            yield pd.DataFrame({"url": batch["url"], "answer": batch["prompt"].map(safe).astype(object)})

    def score(rows: DataFrame) -> DataFrame:
        asked = rows.select("url", build_prompt("title", "content", categories, max_chars).alias("prompt"))
        answers = asked.mapInPandas(ask, "url string, answer string")
        return answers.select("url", normalize_category("answer", categories if strict else None).alias("category"))

    return score


def labelled_urls(labels: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Urls that count as done: those with a label, and with ``retry_errors`` only if it is not 'error'."""
    done = labels.filter(F.col("category").isNotNull())
    return (done.filter(F.col("category") != "error") if retry_errors else done).select("url")


def unclassified(articles: DataFrame, labels: DataFrame, retry_errors: bool = False) -> DataFrame:
    return articles.join(labelled_urls(labels, retry_errors), "url", "left_anti")


def one_label_per_url(labels: DataFrame) -> DataFrame:
    """One label per url: the last by ``labelled_at`` where labels have that column. Among those of one time a real
    label goes before 'unknown', that before 'error', and the last in alphabetical order before the rest."""
    rank = F.when(F.col("category").isNull(), 0).when(F.col("category") == "error", 1).when(F.col("category") == "unknown", 2).otherwise(3)
    time = ["labelled_at"] if "labelled_at" in labels.columns else []
    best = F.max(F.struct(*time, rank.alias("rank"), "category"))
    return labels.groupBy("url").agg(best.alias("best")).select("url", F.col("best.category").alias("category"))


def merge_classifications(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old labels overlaid by new ones. Both sides hold a url once. One join, so new labels are worked out once."""
    fresh = new.select("url", F.col("category").alias("_new"), F.lit(True).alias("_is_new"))
    both = old.select(*CLASSIFICATIONS.names).join(fresh, "url", "full_outer")
    return both.select("url", F.when(F.col("_is_new"), F.col("_new")).otherwise(F.col("category")).alias("category"))


def articles_with_category(articles: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels onto articles. Labels hold a url once, so no row is doubled."""
    return articles.join(labels.select("url", "category"), "url", "left")


def classify_articles(
    articles: DataFrame,
    labels: DataFrame,
    scorer: Scorer | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """All labels after one run over what was not labelled before."""
    scorer = scorer or keyword_scorer()
    fresh = one_label_per_url(scorer(unclassified(articles, labels, retry_errors).select("url", "title", "content")))
    return merge_classifications(one_label_per_url(labels), fresh)
