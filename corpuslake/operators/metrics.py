"""Counts and averages over articles.

``count(url)`` counts rows with a url, ``count(1)`` counts rows. All aggregates are partial first, so a
source with a third of all rows costs the shuffle one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_text, publish_day, text_length
from .ranking import rolling_mean

def by_day(articles: DataFrame, parity: bool = False) -> DataFrame:
    """Articles with the day in place of the publish date. ``parity=True`` leaves the stored string, time and all."""
    return articles if parity else articles.withColumn("publish_date", day_text("publish_date"))


_DESC = lambda name: F.col(name).desc_nulls_first()


def total_count(articles: DataFrame) -> DataFrame:
    return articles.agg(F.count(F.lit(1)).alias("count"))


def _count_urls(articles: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return articles.groupBy(*keys).agg(F.count("url").alias(name))


def stats_by_source(articles: DataFrame) -> DataFrame:
    return _count_urls(articles, ["source_domain"], "count").orderBy(_DESC("count"), "source_domain")


def stats_by_language(articles: DataFrame) -> DataFrame:
    return _count_urls(articles, ["language"], "count").orderBy(_DESC("count"), "language")


def _salience(articles: DataFrame, key: str) -> DataFrame:
    return (
        articles.groupBy(key)
        .agg(F.count("url").alias("article_count"), F.avg(F.length("content")).alias("avg_content_length"))
        .orderBy(_DESC("article_count"), key)
    )


def source_salience(articles: DataFrame) -> DataFrame:
    return _salience(articles, "source_domain")


def language_salience(articles: DataFrame) -> DataFrame:
    return _salience(articles, "language")


def temporal_salience(articles: DataFrame, parity: bool = False) -> DataFrame:
    return (
        by_day(articles, parity).groupBy("publish_date")
        .agg(F.count("url").alias("article_count"), F.sum(text_length("content")).alias("total_content_length"))
        .orderBy(_DESC("publish_date"))
    )


def articles_per_day(articles: DataFrame, parity: bool = False) -> DataFrame:
    """The empty date is a group of its own."""
    return _count_urls(by_day(articles, parity), ["publish_date"], "article_count").orderBy("publish_date")


def articles_per_source(articles: DataFrame) -> DataFrame:
    return _count_urls(articles, ["source_domain"], "article_count").orderBy(_DESC("article_count"), "source_domain")


def articles_per_source_day(articles: DataFrame, parity: bool = False) -> DataFrame:
    keys = ["source_domain", "publish_date"]
    return _count_urls(by_day(articles, parity), keys, "article_count").orderBy(*keys)


def total_statistics(articles: DataFrame) -> DataFrame:
    """Rows, distinct sources and distinct languages, NULL counting as a value.

    Distinct counts run over the (source, language) groups, not over the rows.
    """
    groups = articles.groupBy("source_domain", "language").agg(F.count(F.lit(1)).alias("n"))

    def distinct(c: str) -> Column:
        return F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("long")), F.lit(0))

    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_articles"),
        distinct("source_domain").alias("unique_sources"),
        distinct("language").alias("unique_languages"),
    )


def coverage_statistics(articles: DataFrame, parity: bool = False) -> DataFrame:
    """First and last publish date and number of different dates, empty dates left out."""
    dates = nonempty_publish_date(by_day(articles, parity)).groupBy("publish_date").agg(F.count(F.lit(1)).alias("n"))
    return dates.agg(
        F.min("publish_date").alias("date_earliest"),
        F.max("publish_date").alias("date_latest"),
        F.count("publish_date").alias("days_covered"),
    )


def nonempty_publish_date(articles: DataFrame) -> DataFrame:
    return articles.filter(F.length("publish_date") > 0)


def trend_daily(articles: DataFrame, parity: bool = False) -> DataFrame:
    return _count_rows(nonempty_publish_date(by_day(articles, parity)), ["publish_date"], "count")


def _count_rows(articles: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return articles.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


def counts_by_timestamp(articles: DataFrame) -> DataFrame:
    return _count_urls(articles, ["timestamp"], "count").orderBy("timestamp")


def counts_by_domain(articles: DataFrame) -> DataFrame:
    return _count_rows(articles, ["source_domain"], "len")


def counts_by_crawl(articles: DataFrame) -> DataFrame:
    return _count_rows(articles, ["crawl_id"], "len")


def counts_by_domain_crawl(articles: DataFrame) -> DataFrame:
    return _count_rows(articles, ["source_domain", "crawl_id"], "len")


def timestamp_range(articles: DataFrame) -> DataFrame:
    return articles.agg(F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))


def timestamp_present(articles: DataFrame) -> DataFrame:
    return articles.agg(F.coalesce(F.bool_or(F.col("timestamp").isNotNull()), F.lit(False)).alias("present"))


def category_counts(labelled: DataFrame) -> DataFrame:
    return _count_urls(labelled, ["category"], "count").orderBy(_DESC("count"), "category")


def rolling_daily(articles: DataFrame, window: int = 7, per_source: bool = False, parity: bool = False) -> DataFrame:
    """Daily counts with their trailing mean over ``window`` rows."""
    keys = ["source_domain"] if per_source else []
    daily = _count_urls(by_day(articles, parity), [*keys, "publish_date"], "article_count")
    return rolling_mean(daily, "publish_date", "article_count", window, keys, "rolling_avg")


def pivot_day_source(articles: DataFrame, sources: Sequence[str], parity: bool = False) -> DataFrame:
    """One row per publish date, one column per source, 0 where nothing was published.

    The sources are given, which saves the job that would look them up.
    """
    daily = _count_urls(by_day(articles, parity), ["publish_date", "source_domain"], "article_count")
    return (
        daily.groupBy("publish_date")
        .pivot("source_domain", list(sources))
        .agg(F.first("article_count"))
        .na.fill(0)
    )


def with_parsed_date(frame: DataFrame) -> DataFrame:
    return frame.withColumn("date", publish_day("publish_date"))


def salience_sections(articles: DataFrame) -> DataFrame:
    """Source, language and temporal salience stacked, told apart by ``section``.

    The articles are read once, into one row per source, language and day; a mean is a sum over a count.
    """
    groups = by_day(articles).groupBy("source_domain", "language", "publish_date").agg(
        F.count("url").alias("n"), F.count("content").alias("texts"), F.sum(text_length("content")).alias("chars")
    )
    # Each group counts towards three sections.
    section = F.explode(F.array(*[F.lit(x) for x in ("source", "language", "temporal")]))
    own = lambda name, of: F.when(F.col("section") == of, F.col(name)).alias(name)
    spread = groups.withColumn("section", section).select(
        "section", own("source_domain", "source"), own("language", "language"), own("publish_date", "temporal"),
        "n", "texts", "chars",
    )
    sums = spread.groupBy("section", "source_domain", "language", "publish_date").agg(
        F.sum("n").alias("article_count"), F.sum("texts").alias("texts"), F.sum("chars").alias("chars")
    )
    dated = F.col("section") == "temporal"
    mean = F.when(F.col("texts") > 0, F.col("chars") / F.col("texts"))
    return sums.select(
        "source_domain", "article_count", F.when(~dated, mean).alias("avg_content_length"), "section", "language",
        "publish_date", F.when(dated, F.col("chars")).alias("total_content_length"),
    )


def metric_frames(both: DataFrame) -> dict[str, DataFrame]:
    """The three frames of the metrics export, all from the counts of ``articles_per_source_day``."""
    total = F.sum("article_count").alias("article_count")
    return {
        "articles_per_day": both.groupBy("publish_date").agg(total).orderBy("publish_date"),
        "articles_per_source": both.groupBy("source_domain").agg(total).orderBy(_DESC("article_count"), "source_domain"),
        "articles_per_source_per_day": both.orderBy("source_domain", "publish_date"),
    }
