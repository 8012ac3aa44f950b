"""Crawl index."""

from pyspark.sql import functions as F

from ..functions import cdx_publish_date, host, lower_contains, source_domain, valid_crawl_id
from ..operators import cdx as c
from ..operators.articles import distinct_targets
from ..sources.cdx import parse_cdx
from . import Query
from .views import CRAWLS

_C = 'url, crawl_id, filename, timestamp, "offset", length'
_COLS = ["url", "crawl_id", "filename", "timestamp", "offset", "length"]
_PAIR = ["crawl_id", "domain_pattern"]
_WORDS = ["/EN/", "page", "ref"]
_URL_HIT = "(contains(lower(url), '/en/') OR contains(lower(url), 'page') OR contains(lower(url), 'ref'))"
_TERMS = ["license", "der", "les "]
_TEXT_HIT = "(contains(lower(content), 'license') OR contains(lower(content), 'der') OR contains(lower(content), 'les '))"

QUERIES = {
    "cdx_json_fields": Query(
        lambda v: parse_cdx(v.cdx.select(F.to_json(F.struct(
            "crawl_id", "url", "filename", "timestamp",
            F.col("offset").cast("string").alias("offset"), F.col("length").cast("string").alias("length"),
        )).alias("value"))),
        f"SELECT {_C} FROM cdx",
    ),
    "cdx_date_range": Query(
        lambda v: c.date_range(v.cdx, "2020-04-05", "2020-04-20").select(*_COLS),
        f"SELECT {_C} FROM cdx WHERE timestamp >= '20200405000000' AND timestamp <= '20200420999999'",
    ),
    "cdx_date_from": Query(
        lambda v: c.date_range(v.cdx, date_start="2020-04-15").select("url", "timestamp"),
        "SELECT url, timestamp FROM cdx WHERE timestamp >= '20200415000000'",
    ),
    "cdx_domain_match": Query(
        lambda v: v.matched.select(*_COLS, "domain_pattern"), f"SELECT {_C}, domain_pattern FROM matched"
    ),
    "domain_suffix_join": Query(
        lambda v: c.domain_match(v.cdx, v.host_patterns).select("url", "domain_pattern"),
        """SELECT h.url, p.domain_pattern
           FROM hosts h JOIN (SELECT DISTINCT domain_pattern, host AS d FROM by_host JOIN hosts USING (page_id)) p
             ON h.host = p.d OR h.host LIKE concat('%.', p.d)""",
    ),
    "query_all_pairs": Query(
        lambda v: c.query_all_pairs(
            v.cdx, v.patterns, CRAWLS, ["/en/", "page"], 20, "2020-04-02", "2020-04-27"
        ).select("url", "timestamp", *_PAIR),
        """SELECT url, timestamp, crawl_id, domain_pattern FROM
             (SELECT *, row_number() OVER (PARTITION BY crawl_id, domain_pattern
                                           ORDER BY url, timestamp, filename, "offset") AS rn
              FROM matched WHERE timestamp >= '20200402000000' AND timestamp <= '20200427999999'
                AND (contains(lower(url), '/en/') OR contains(lower(url), 'page')))
           WHERE rn <= 20""",
    ),
    "filter_keywords_url": Query(
        lambda v: c.filter_keywords(v.cdx, _WORDS).select("url"), f"SELECT url FROM cdx WHERE {_URL_HIT}"
    ),
    "filter_keywords_url_empty": Query(
        lambda v: c.filter_keywords(v.cdx, []).select("url"), "SELECT url FROM cdx WHERE false"
    ),
    "filter_keywords_word": Query(
        lambda v: c.filter_keywords(v.cdx, ["page", "en"], word_boundary=True).select("url"),
        r"SELECT url FROM cdx WHERE regexp_matches(lower(url), '\b(page|en)\b')",
    ),
    "filter_keywords_inline": Query(
        lambda v: c.filter_keywords_inline(v.matched, ["/en/", "/de/"], 10).select("url", *_PAIR),
        """SELECT url, crawl_id, domain_pattern FROM
             (SELECT *, row_number() OVER (PARTITION BY crawl_id, domain_pattern
                                           ORDER BY url, timestamp, filename, "offset") AS rn
              FROM matched WHERE contains(lower(url), '/en/') OR contains(lower(url), '/de/')) WHERE rn <= 10""",
    ),
    "filter_keywords_inline_none": Query(
        lambda v: c.filter_keywords_inline(v.matched, [], 500).select("url", *_PAIR),
        """SELECT url, crawl_id, domain_pattern FROM
             (SELECT *, row_number() OVER (PARTITION BY crawl_id, domain_pattern
                                           ORDER BY url, timestamp, filename, "offset") AS rn FROM matched)
           WHERE rn <= 500""",
    ),
    "filter_keywords_content": Query(
        lambda v: c.filter_keywords_content(v.cdx, v.page_texts, _TERMS).select("url", "filename"),
        f"SELECT url, filename FROM cdx WHERE url IN (SELECT url FROM page_texts WHERE {_TEXT_HIT})",
    ),
    "lower_contains": Query(
        lambda v: v.articles.select("url", lower_contains("content", _TERMS).alias("hit")),
        f"SELECT url, {_TEXT_HIT} AS hit FROM articles",
    ),
    "nonempty_filename": Query(
        lambda v: c.nonempty_filename(v.cdx).select("url", "filename"),
        "SELECT url, filename FROM cdx WHERE length(filename) > 0",
    ),
    "urls_top_n": Query(
        lambda v: c.urls_top_n(v.matched, 15).select("url", *_PAIR),
        """SELECT url, crawl_id, domain_pattern FROM
             (SELECT *, row_number() OVER (PARTITION BY crawl_id, domain_pattern
                                           ORDER BY url, timestamp, filename, "offset") AS rn FROM matched)
           WHERE rn <= 15""",
    ),
    "files_top_n": Query(
        lambda v: c.files_top_n(v.matched, 2).select("url", "filename", *_PAIR),
        """SELECT url, filename, crawl_id, domain_pattern FROM
             (SELECT *, dense_rank() OVER (PARTITION BY crawl_id, domain_pattern ORDER BY filename) AS r
              FROM matched) WHERE r <= 2""",
    ),
    "warc_groups": Query(
        lambda v: c.warc_groups(v.cdx),
        """SELECT filename, count(*) AS n_urls, min("offset") AS first_offset, max("offset" + length) AS end_offset
           FROM cdx WHERE filename <> '' GROUP BY filename""",
    ),
    "group_by_warc": Query(
        lambda v: c.group_by_warc(v.matched, _PAIR).select("url", "filename", *_PAIR, "urls_in_file"),
        """SELECT url, filename, crawl_id, domain_pattern,
                  count(*) OVER (PARTITION BY crawl_id, domain_pattern, filename) AS urls_in_file
           FROM matched WHERE filename <> ''""",
    ),
    "attach_index_row": Query(
        lambda v: c.attach_index_row(
            v.page_texts.select("filename", "url", "language"), v.cdx.filter(F.col("timestamp") >= "20200405")
        ),
        """SELECT p.filename, p.url, p.language, coalesce(c.timestamp, '') AS timestamp
           FROM page_texts p LEFT JOIN
             (SELECT filename, url, min(timestamp) AS timestamp FROM cdx WHERE timestamp >= '20200405'
              GROUP BY ALL) c USING (filename, url)""",
    ),
    "cdx_publish_date": Query(
        lambda v: v.cdx.select("url", cdx_publish_date("timestamp").alias("publish_date"),
                               cdx_publish_date("timestamp", parity=True).alias("publish_date_parity")),
        """SELECT url, concat(substr(timestamp, 1, 4), '-', substr(timestamp, 5, 2), '-', substr(timestamp, 7, 2), ' ',
                  substr(timestamp, 9, 2), ':', substr(timestamp, 11, 2), ':', substr(timestamp, 13, 2)) AS publish_date,
                  '' AS publish_date_parity FROM cdx""",
    ),
    "source_domain": Query(
        lambda v: v.pages.select("url", source_domain("url").alias("source_domain"), host("url").alias("host")),
        r"""SELECT url, regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\.', '')
                   AS source_domain, host FROM hosts""",
    ),
    "valid_crawl_id": Query(
        lambda v: v.cdx.select("url", valid_crawl_id("crawl_id").alias("valid")),
        r"SELECT url, regexp_matches(crawl_id, '^CC-MAIN-\d{4}-\d+$') AS valid FROM cdx",
    ),
    "distinct_targets": Query(
        lambda v: distinct_targets(v.cdx),
        "SELECT DISTINCT url FROM cdx WHERE length(url) > 0",
    ),
}
