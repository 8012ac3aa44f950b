"""Counts, averages, trends."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import capture_time
from ..operators import errors as e
from ..operators import metrics as m
from ..operators import monitor
from . import Query

SOURCES = [f"src{i}" for i in range(20)]


def _r(df: DataFrame, name: str = "avg_content_length") -> DataFrame:
    return df.withColumn(name, F.round(name, 6))


def _changes_sql(table: str) -> str:
    return f"""
      SELECT service, check_id, status, previous, check_number, changed,
             changed AND status = 'UP' AND coalesce(previous, '') = 'DOWN' AS recovered
      FROM (SELECT *, status IS DISTINCT FROM previous AS changed
            FROM (SELECT *, lag(status) OVER w AS previous, row_number() OVER w AS check_number FROM {table}
                  WINDOW w AS (PARTITION BY service ORDER BY ts, check_id)))
      WHERE changed OR check_number % 6 = 0"""


def _on_built(queries: dict[str, Query]) -> dict[str, Query]:
    """The metrics by day once more, over dates that have a time: the same SQL must hold."""
    def run(name: str):
        return lambda v: queries[name].run(_Built(v))

    by_day = [
        "temporal_salience", "articles_per_day", "articles_per_source_day", "coverage_statistics", "trend_daily",
        "rolling_7", "rolling_7_by_source", "pivot_day_source", "sections_union",
    ]
    return {f"{name}_built": Query(run(name), queries[name].sql) for name in by_day}


class _Built:
    def __init__(self, views) -> None:
        self.articles = views.built


QUERIES = {
    "total_count": Query(lambda v: m.total_count(v.articles), "SELECT count(*) AS count FROM articles"),
    "stats_by_source": Query(
        lambda v: m.stats_by_source(v.articles), "SELECT source_domain, count(url) AS count FROM articles GROUP BY ALL"
    ),
    "stats_by_language": Query(
        lambda v: m.stats_by_language(v.articles), "SELECT language, count(url) AS count FROM articles GROUP BY ALL"
    ),
    "source_salience": Query(
        lambda v: _r(m.source_salience(v.articles)),
        """SELECT source_domain, count(url) AS article_count, round(avg(length(content)), 6) AS avg_content_length
           FROM articles GROUP BY ALL""",
    ),
    "language_salience": Query(
        lambda v: _r(m.language_salience(v.articles)),
        """SELECT language, count(url) AS article_count, round(avg(length(content)), 6) AS avg_content_length
           FROM articles GROUP BY ALL""",
    ),
    "temporal_salience": Query(
        lambda v: m.temporal_salience(v.articles),
        """SELECT publish_date, count(url) AS article_count, cast(sum(length(content)) AS bigint) AS total_content_length
           FROM articles GROUP BY ALL""",
    ),
    "articles_per_day": Query(
        lambda v: m.articles_per_day(v.articles), "SELECT publish_date, count(url) AS article_count FROM articles GROUP BY ALL"
    ),
    "articles_per_source": Query(
        lambda v: m.articles_per_source(v.articles),
        "SELECT source_domain, count(url) AS article_count FROM articles GROUP BY ALL",
    ),
    "articles_per_source_day": Query(
        lambda v: m.articles_per_source_day(v.articles),
        "SELECT source_domain, publish_date, count(url) AS article_count FROM articles GROUP BY ALL ORDER BY 1, 2",
    ),
    "total_statistics": Query(
        lambda v: m.total_statistics(v.articles),
        """SELECT count(*) AS total_articles,
                  count(DISTINCT source_domain) + max(CASE WHEN source_domain IS NULL THEN 1 ELSE 0 END) AS unique_sources,
                  count(DISTINCT language) + max(CASE WHEN language IS NULL THEN 1 ELSE 0 END) AS unique_languages
           FROM articles""",
    ),
    "coverage_statistics": Query(
        lambda v: m.coverage_statistics(v.articles),
        """SELECT min(publish_date) AS date_earliest, max(publish_date) AS date_latest,
                  count(DISTINCT publish_date) AS days_covered FROM articles WHERE publish_date <> ''""",
    ),
    "nonempty_publish_date": Query(
        lambda v: m.nonempty_publish_date(v.articles).select("url", "publish_date"),
        "SELECT url, publish_date FROM articles WHERE length(publish_date) > 0",
    ),
    "trend_daily": Query(
        lambda v: m.trend_daily(v.articles),
        "SELECT publish_date, count(*) AS count FROM articles WHERE publish_date <> '' GROUP BY ALL",
    ),
    "counts_by_timestamp": Query(
        lambda v: m.counts_by_timestamp(v.articles), "SELECT timestamp, count(url) AS count FROM articles GROUP BY ALL"
    ),
    "counts_by_domain": Query(
        lambda v: m.counts_by_domain(v.articles), "SELECT source_domain, count(*) AS len FROM articles GROUP BY ALL"
    ),
    "counts_by_crawl": Query(
        lambda v: m.counts_by_crawl(v.articles), "SELECT crawl_id, count(*) AS len FROM articles GROUP BY ALL"
    ),
    "counts_by_domain_crawl": Query(
        lambda v: m.counts_by_domain_crawl(v.articles),
        "SELECT source_domain, crawl_id, count(*) AS len FROM articles GROUP BY ALL",
    ),
    "timestamp_range": Query(
        lambda v: m.timestamp_range(v.articles), "SELECT min(timestamp) AS earliest, max(timestamp) AS latest FROM articles"
    ),
    "timestamp_present": Query(
        lambda v: m.timestamp_present(v.articles), "SELECT bool_or(timestamp IS NOT NULL) AS present FROM articles"
    ),
    "rolling_7": Query(
        lambda v: _r(m.rolling_daily(v.articles), "rolling_avg"),
        """SELECT publish_date, article_count, round(CASE WHEN count(*) OVER w = 7 THEN avg(article_count) OVER w END, 6)
                  AS rolling_avg
           FROM (SELECT publish_date, count(url) AS article_count FROM articles GROUP BY ALL)
           WINDOW w AS (ORDER BY publish_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    ),
    "rolling_7_by_source": Query(
        lambda v: _r(m.rolling_daily(v.articles, per_source=True), "rolling_avg"),
        """SELECT source_domain, publish_date, article_count,
                  round(CASE WHEN count(*) OVER w = 7 THEN avg(article_count) OVER w END, 6) AS rolling_avg
           FROM (SELECT source_domain, publish_date, count(url) AS article_count FROM articles GROUP BY ALL)
           WINDOW w AS (PARTITION BY source_domain ORDER BY publish_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    ),
    "pivot_day_source": Query(
        lambda v: m.pivot_day_source(v.articles, SOURCES),
        "SELECT publish_date, "
        + ", ".join(f"count(url) FILTER (source_domain = '{s}') AS {s}" for s in SOURCES)
        + " FROM articles GROUP BY publish_date",
    ),
    "parse_date": Query(
        lambda v: m.with_parsed_date(m.articles_per_day(v.articles)).select(
            F.col("date").cast("string").alias("date"), "article_count"
        ),
        """SELECT cast(try_cast(nullif(publish_date, '') AS date) AS varchar) AS date, count(url) AS article_count
           FROM articles GROUP BY publish_date""",
    ),
    "capture_time": Query(
        lambda v: v.cdx.select("url", F.date_format(capture_time("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("captured")),
        "SELECT url, strftime(strptime(timestamp, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS captured FROM cdx",
    ),
    "sections_union": Query(
        lambda v: _r(m.salience_sections(v.articles)),
        """SELECT 'source' AS section, source_domain, NULL AS language, NULL AS publish_date, count(url) AS article_count,
                  round(avg(length(content)), 6) AS avg_content_length, cast(NULL AS bigint) AS total_content_length
           FROM articles GROUP BY source_domain
           UNION ALL SELECT 'language', NULL, language, NULL, count(url), round(avg(length(content)), 6), NULL
           FROM articles GROUP BY language
           UNION ALL SELECT 'temporal', NULL, NULL, publish_date, count(url), NULL, cast(sum(length(content)) AS bigint)
           FROM articles GROUP BY publish_date""",
    ),
    "errors_by_type": Query(
        lambda v: e.errors_by_type(v.errors, "error").select("event_id", "message"),
        "SELECT event_id, message FROM errors WHERE error_type = 'error'",
    ),
    "error_total": Query(lambda v: e.error_total(v.errors), "SELECT count(*) AS count FROM errors"),
    "error_counts": Query(
        lambda v: e.error_counts(v.errors), "SELECT error_type, count(*) AS count FROM errors GROUP BY ALL"
    ),
    "error_samples": Query(
        lambda v: e.error_samples(v.errors, order=("at", "event_id")).select("error_type", "message", "event_id"),
        """SELECT error_type, message, event_id FROM
             (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY seen_at, event_id) AS rn FROM errors)
           WHERE rn = 1""",
    ),
    "error_samples_two": Query(
        lambda v: e.error_samples(v.errors, 2, order=("at", "event_id")).select("error_type", "message", "event_id"),
        """SELECT error_type, message, event_id FROM
             (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY seen_at, event_id) AS rn FROM errors)
           WHERE rn = 1 ORDER BY seen_at, event_id LIMIT 2""",
    ),
    "status_changes": Query(
        lambda v: monitor.status_changes(v.checks).drop("ts"), _changes_sql("checks")
    ),
    "status_changes_by_service": Query(
        lambda v: monitor.status_changes(v.user_checks, bucket=F.date_trunc("day", "ts")).drop("ts"),
        _changes_sql("user_checks"),
    ),
}
QUERIES |= _on_built(QUERIES)
