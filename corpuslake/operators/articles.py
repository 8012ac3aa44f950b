"""Queries over the article table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import PREVIEW_CHARS
from ..functions import publish_day, regex_contains, text_length


def all_articles(articles: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return articles.select(*columns) if columns else articles


def sort_keys(order_by: str) -> list[Column]:
    """'column [ASC|DESC], ...' as sort keys; NULLs come first in both directions."""
    keys = []
    for part in filter(None, (p.strip() for p in order_by.split(","))):
        name, *direction = part.split()
        down = bool(direction) and direction[0].upper() == "DESC"
        keys.append(F.col(name).desc_nulls_first() if down else F.col(name).asc_nulls_first())
    return keys


def query_articles(
    articles: DataFrame,
    where: str | Column | None = None,
    order_by: str = "timestamp DESC",
    limit: int | None = None,
    tie_break: Sequence[str] = ("url",),
) -> DataFrame:
    """Filter, sort and cut. The last sort keys make the cut repeatable."""
    rows = articles
    if where is not None:
        rows = rows.filter(where)
    keys = sort_keys(order_by)
    if keys:
        rows = rows.orderBy(*keys, *tie_break)
    return rows if limit is None else rows.limit(limit)


def recent_articles(articles: DataFrame, limit: int = 10) -> DataFrame:
    return query_articles(articles, order_by="timestamp DESC", limit=limit)


def sample_recent(articles: DataFrame, preview: int = PREVIEW_CHARS) -> DataFrame:
    """The newest article with the start of its text."""
    return recent_articles(articles, 1).select(
        "title", "url", "source_domain", F.left("content", F.lit(preview)).alias("content_preview")
    )


def search_by_keyword(
    articles: DataFrame, keyword: str, limit: int | None = None, order_by: str = ""
) -> DataFrame:
    """Case-sensitive regex in title or content.

    Without ``order_by`` any ``limit`` hits come back, which lets Spark stop reading early.
    """
    hits = articles.filter(regex_contains("title", keyword) | regex_contains("content", keyword))
    return query_articles(hits, order_by=order_by, limit=limit)


def articles_by_date_range(
    articles: DataFrame,
    start_date: str,
    end_date: str,
    limit: int | None = None,
    inclusive_day: bool = True,
    order_by: str = "",
) -> DataFrame:
    """Both ends included, by calendar day. ``inclusive_day=False`` compares strings, so that a time part on the
    last day falls out."""
    if inclusive_day:
        day = publish_day("publish_date")
        # The same bounds on the string reach the scan; they hold for every date that is one.
        after = str(date.fromisoformat(end_date) + timedelta(days=1))
        near = articles.filter((F.col("publish_date") >= start_date) & (F.col("publish_date") < after))
        hits = near.filter(day.between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date")))
    else:
        hits = articles.filter(F.col("publish_date").between(start_date, end_date))
    return query_articles(hits, order_by=order_by, limit=limit)


def hash_exists(articles: DataFrame, content_hash: str) -> DataFrame:
    """One row ``found``: is this content stored?"""
    hit = articles.filter(F.col("content_hash") == content_hash).select("content_hash").limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("found"))


def urls(articles: DataFrame) -> DataFrame:
    return articles.select("url")


def known_urls(wanted: DataFrame, articles: DataFrame) -> DataFrame:
    """Those of the wanted urls that are stored."""
    return wanted.join(articles.select("url"), "url", "left_semi")


def content_length(articles: DataFrame) -> DataFrame:
    return articles.withColumn("content_length", text_length("content"))


def load_articles(
    articles: DataFrame, input_filter: str | Column | None = None, limit: int | None = None
) -> DataFrame:
    """Rows where a boolean column or expression holds, at most ``limit`` of them."""
    rows = articles
    if input_filter is not None:
        rows = rows.filter(F.expr(input_filter) if isinstance(input_filter, str) else input_filter)
    return rows.limit(limit) if limit else rows


def distinct_targets(index: DataFrame) -> DataFrame:
    """Distinct non-empty urls."""
    return index.filter(F.length("url") > 0).select("url").distinct()


def articles_as_of(stored: DataFrame, version: int) -> DataFrame:
    """The table as it was after batch ``version``."""
    return stored.filter(F.col("batch_id") <= version)


def ingest_history(stored: DataFrame, limit: int | None = 10) -> DataFrame:
    """Newest batches first: rows and capture-time span of each."""
    runs = stored.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("articles"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    ).orderBy(F.desc("batch_id"))
    return runs if limit is None else runs.limit(limit)


def current_version(stored: DataFrame) -> DataFrame:
    return stored.agg(F.max("batch_id").alias("version"))
