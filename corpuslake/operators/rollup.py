"""Counts kept per source, language, day and crawl: the metrics are summed from them, and no text is read again.

A rollup has one row per combination, however many articles there are; rollups of parts of a table add up to that of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text_length
from .metrics import by_day, nonempty_publish_date

KEYS = ["source_domain", "language", "publish_date", "crawl_id"]
#: Rows, rows with a url, rows with a text, characters of all texts.
SUMS = ["n_rows", "n_urls", "n_texts", "n_chars"]
SCHEMA = ", ".join([*[f"{k} string" for k in KEYS], *[f"{s} long" for s in SUMS]])


def rollup(articles: DataFrame) -> DataFrame:
    """The rollup of some articles, by calendar day."""
    return by_day(articles).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("url").alias("n_urls"), F.count("content").alias("n_texts"),
        F.sum(text_length("content")).cast("long").alias("n_chars"),
    )


def added(rollups: DataFrame, keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """Rollups on top of one another as one, or summed down to fewer keys."""
    return rollups.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in SUMS])


_DESC = lambda name: F.col(name).desc_nulls_first()


def total_count(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("count"))


def stats_by(counts: DataFrame, key: str) -> DataFrame:
    """Articles with a url by source, language or crawl, most first."""
    return added(counts, [key]).select(key, F.col("n_urls").alias("count")).orderBy(_DESC("count"), key)


def salience(counts: DataFrame, key: str) -> DataFrame:
    """As ``source_salience`` and ``language_salience`` over the articles."""
    mean = F.when(F.col("n_texts") > 0, F.col("n_chars") / F.col("n_texts")).alias("avg_content_length")
    return added(counts, [key]).select(key, F.col("n_urls").alias("article_count"), mean).orderBy(_DESC("article_count"), key)


def temporal_salience(counts: DataFrame) -> DataFrame:
    return added(counts, ["publish_date"]).select(
        "publish_date", F.col("n_urls").alias("article_count"), F.col("n_chars").alias("total_content_length")
    ).orderBy(_DESC("publish_date"))


def articles_per(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Articles per day, per source, or per source and day."""
    return added(counts, keys).select(*keys, F.col("n_urls").alias("article_count")).orderBy(*keys)


def total_statistics(counts: DataFrame) -> DataFrame:
    """Rows, different sources, different languages; NULL is a value."""
    def distinct(c: str):
        return F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("long")), F.lit(0))

    return counts.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_articles"), distinct("source_domain").alias("unique_sources"),
        distinct("language").alias("unique_languages"),
    )


def coverage_statistics(counts: DataFrame) -> DataFrame:
    dates = nonempty_publish_date(counts).select("publish_date").distinct()
    return dates.agg(
        F.min("publish_date").alias("date_earliest"), F.max("publish_date").alias("date_latest"),
        F.count("publish_date").alias("days_covered"),
    )


def trend_daily(counts: DataFrame) -> DataFrame:
    return added(nonempty_publish_date(counts), ["publish_date"]).select("publish_date", F.col("n_rows").alias("count")).orderBy("publish_date")


def counts_by(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows by source, by crawl, or by both."""
    return added(counts, keys).select(*keys, F.col("n_rows").alias("len")).orderBy(*keys)
