"""Article table: reading, searching, sorting, deduplicating, versions."""

from pyspark.sql import functions as F

from ..functions import content_hash, default_empty, regex_contains, text_length
from ..operators import articles as a
from ..operators import dedup
from ..plans.flagship import corpus_report
from . import Query

_A = "url, title, content, source_domain, crawl_id, timestamp, language, status_code, publish_date"
_COLS = [c.strip() for c in _A.split(",")]
_KEY = "url, source_domain, timestamp, publish_date"
_KEYS = [c.strip() for c in _KEY.split(",")]

QUERIES = {
    "corpus_report": Query(
        lambda v: corpus_report(v.articles),
        """SELECT source_domain, count(*) AS article_count, round(avg(length(content)), 6) AS avg_content_length,
                  count(DISTINCT CASE WHEN publish_date <> '' THEN publish_date END) AS days_covered
           FROM ranked WHERE rn = 1 GROUP BY source_domain""",
    ),
    "query_all_articles": Query(
        lambda v: a.all_articles(v.articles, _COLS), f"SELECT {_A} FROM articles"
    ),
    "get_urls": Query(lambda v: a.urls(v.articles), "SELECT url FROM articles"),
    "url_exists": Query(
        lambda v: a.known_urls(v.articles.select(
            F.concat(F.lit("https://src1.example/a/"), F.col("doc_id").cast("string")).alias("url")), v.articles),
        """SELECT w.url FROM (SELECT concat('https://src1.example/a/', cast(doc_id AS varchar)) AS url
                              FROM articles) w SEMI JOIN articles USING (url)""",
    ),
    "search_by_keyword": Query(
        lambda v: a.search_by_keyword(v.articles, r"[Rr]eleased under|Th[a-z]+ing", order_by="url ASC").select(*_KEYS),
        rf"""SELECT {_KEY} FROM articles
             WHERE regexp_matches(title, '[Rr]eleased under|Th[a-z]+ing')
                OR regexp_matches(content, '[Rr]eleased under|Th[a-z]+ing')
             ORDER BY url""",
    ),
    "search_by_keyword_limit": Query(
        lambda v: a.search_by_keyword(v.articles, "Th[a-z]+ing", 50, "url ASC").select(*_KEYS),
        f"""SELECT {_KEY} FROM articles
            WHERE regexp_matches(title, 'Th[a-z]+ing') OR regexp_matches(content, 'Th[a-z]+ing') ORDER BY url LIMIT 50""",
    ),
    "search_by_keyword_all": Query(
        lambda v: a.search_by_keyword(v.articles, "License|lizenz", limit=None).select(*_KEYS),
        f"""SELECT {_KEY} FROM articles
            WHERE regexp_matches(title, 'License|lizenz') OR regexp_matches(content, 'License|lizenz')""",
    ),
    "regex_contains": Query(
        lambda v: v.articles.select("url", regex_contains("content", "[Ll]icense|[0-9]{3}-[0-9]{4}").alias("hit")),
        "SELECT url, regexp_matches(content, '[Ll]icense|[0-9]{3}-[0-9]{4}') AS hit FROM articles",
    ),
    "limit_any": Query(
        lambda v: a.search_by_keyword(v.articles, "the", 50).agg(F.count(F.lit(1)).alias("n_rows")),
        """SELECT least(50, count(*)) AS n_rows FROM articles
           WHERE regexp_matches(title, 'the') OR regexp_matches(content, 'the')""",
    ),
    "text_length": Query(
        lambda v: v.articles.select("url", text_length("title").alias("n"), text_length("content").alias("m")),
        "SELECT url, length(title) AS n, length(content) AS m FROM articles",
    ),
    "default_empty": Query(
        lambda v: v.labels.select("url", default_empty("category").alias("category")),
        "SELECT url, coalesce(category, '') AS category FROM old_labels",
    ),
    "articles_by_date_range": Query(
        lambda v: a.articles_by_date_range(v.articles, "2020-03-10", "2020-04-30", order_by="publish_date ASC").select(*_KEYS),
        f"""SELECT {_KEY} FROM articles WHERE publish_date >= '2020-03-10' AND publish_date <= '2020-04-30'
            ORDER BY publish_date, url""",
    ),
    "articles_by_date_range_limit": Query(
        lambda v: a.articles_by_date_range(v.built, "2020-03-10", "2020-04-30", 100, order_by="url ASC").select("url"),
        """SELECT url FROM articles WHERE publish_date BETWEEN '2020-03-10' AND '2020-04-30'
           ORDER BY url LIMIT 100""",
    ),
    "articles_by_date_range_days": Query(
        lambda v: a.articles_by_date_range(v.articles, "2020-03-10", "2020-04-30", None, inclusive_day=True).select(*_KEYS),
        f"""SELECT {_KEY} FROM articles
            WHERE try_cast(nullif(publish_date, '') AS date) BETWEEN date '2020-03-10' AND date '2020-04-30'""",
    ),
    "hash_exists": Query(
        lambda v: a.hash_exists(v.hashed, "d41d8cd98f00b204e9800998ecf8427e"),
        "SELECT count(*) > 0 AS found FROM hashed WHERE content_hash = 'd41d8cd98f00b204e9800998ecf8427e'",
    ),
    "hash_exists_stored": Query(
        lambda v: a.hash_exists(v.hashed, v.hashed.agg(F.min("content_hash")).first()[0]),
        "SELECT count(*) > 0 AS found FROM hashed WHERE content_hash = (SELECT min(content_hash) FROM hashed)",
    ),
    "content_hash": Query(
        lambda v: v.articles.select("doc_id", content_hash("content").alias("content_hash")),
        "SELECT doc_id, content_hash FROM hashed",
    ),
    "content_length": Query(
        lambda v: a.content_length(v.articles).select("url", "content_length"),
        "SELECT url, length(content) AS content_length FROM articles",
    ),
    "query_articles": Query(
        lambda v: a.query_articles(v.articles).select(*_KEYS),
        f"SELECT {_KEY} FROM articles ORDER BY timestamp DESC, url",
    ),
    "query_articles_limit": Query(
        lambda v: a.query_articles(v.articles, limit=100).select(*_KEYS),
        f"SELECT {_KEY} FROM articles ORDER BY timestamp DESC, url LIMIT 100",
    ),
    "query_articles_where": Query(
        lambda v: a.query_articles(v.articles, "language = 'en'", "publish_date ASC, timestamp DESC", 100).select(*_KEYS),
        f"SELECT {_KEY} FROM articles WHERE language = 'en' ORDER BY publish_date, timestamp DESC, url LIMIT 100",
    ),
    "recent_articles": Query(
        lambda v: a.recent_articles(v.articles).select(*_KEYS),
        f"SELECT {_KEY} FROM articles ORDER BY timestamp DESC, url LIMIT 10",
    ),
    "sample_recent": Query(
        lambda v: a.sample_recent(v.articles),
        """SELECT title, url, source_domain, left(content, 200) AS content_preview
           FROM articles ORDER BY timestamp DESC, url LIMIT 1""",
    ),
    "load_articles": Query(
        lambda v: a.load_articles(v.articles, "language <> 'en' AND length(content) > 500").select(*_KEYS),
        f"SELECT {_KEY} FROM articles WHERE language <> 'en' AND length(content) > 500",
    ),
    "bool_column_filter": Query(
        lambda v: a.load_articles(
            v.articles.join(v.table("labels").select("doc_id", (F.col("quality") == 1).alias("good")), "doc_id"), "good"
        ).select("url"),
        "SELECT url FROM articles JOIN labels USING (doc_id) WHERE quality = 1",
    ),
    "dedup_first": Query(
        lambda v: dedup.dedup_first(v.hashed).select("content_hash", *_COLS),
        f"SELECT content_hash, {_A} FROM ranked WHERE rn = 1",
    ),
    "anti_existing_hash": Query(
        lambda v: dedup.anti_existing_hash(
            v.hashed.filter("crawl_id <> 'CC-MAIN-2020-16'"), v.hashed.filter("crawl_id = 'CC-MAIN-2020-16'")
        ).select("url", "content_hash"),
        """SELECT url, content_hash FROM hashed WHERE crawl_id <> 'CC-MAIN-2020-16' AND content_hash NOT IN
           (SELECT content_hash FROM hashed WHERE crawl_id = 'CC-MAIN-2020-16')""",
    ),
    "distinct_hashes": Query(
        lambda v: v.hashed.select("content_hash").distinct(), "SELECT DISTINCT content_hash FROM hashed"
    ),
    "articles_as_of": Query(
        lambda v: a.articles_as_of(v.stored, 1).select("url", "batch_id"),
        "SELECT url, batch_id FROM stored WHERE batch_id <= 1",
    ),
    "ingest_history": Query(
        lambda v: a.ingest_history(v.stored),
        """SELECT batch_id, count(*) AS articles, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp
           FROM stored GROUP BY batch_id ORDER BY batch_id DESC LIMIT 10""",
    ),
    "current_version": Query(
        lambda v: a.current_version(v.stored), "SELECT max(batch_id) AS version FROM stored"
    ),
}
