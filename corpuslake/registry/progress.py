"""Ledgers and reports."""

from pyspark.sql import functions as F

from ..functions import lower_contains
from ..operators import extract, progress
from ..operators.dedup import with_content_hash
from ..operators.ranking import first_per_key
from ..session import scratch_path
from ..sources.tables import parse_progress, progress_files, progress_pairs, scan_progress
from . import Query, Views
from .views import CRAWLS

_PAIR = ["crawl_id", "domain_pattern"]


def _pairs(v: Views):
    return progress.pairs_cross(v.host_patterns, CRAWLS)


def _funnel(v: Views):
    index = v.matched.withColumn("keyword_hit", lower_contains("url", ["/en/", "/de/"]))
    pages = v.page_texts.select("doc_id", "page_id", "content", "language").join(
        index.filter("keyword_hit").select("page_id", *_PAIR, "timestamp", "url"), "page_id"
    )
    good = with_content_hash(extract.quality_gate(pages, languages=["en", "de"]))
    first = first_per_key(
        good.select("content_hash", "timestamp", "url", "doc_id", *_PAIR), ["content_hash"], ["timestamp", "url", *_PAIR, "doc_id"]
    )
    marked = good.select("doc_id", *_PAIR).join(
        first.select("doc_id", *_PAIR, F.lit(True).alias("inserted")), ["doc_id", *_PAIR], "left"
    ).na.fill(False, ["inserted"])
    return progress.build_funnel(index, marked)


def _checkpoints(v: Views):
    """One checkpoint document per index row of an earlier run, as JSON text."""
    rows = v.by_host.filter(F.col("timestamp") < "20200415")
    key = F.concat_ws(":", "crawl_id", "domain_pattern")
    return parse_progress(rows.select(F.to_json(F.struct(
        F.array(key).alias("completed_crawl_domain_pairs"),
        F.array("filename").alias("completed_warc_files"),
        F.lit(1).alias("total_articles_inserted"),
        F.col("timestamp").alias("last_updated"),
    )).alias("value")))


def _read_checkpoints(v: Views):
    """A checkpoint file per crawl, a broken one among them, and a folder that is not there."""
    path = scratch_path(v.spark, "checkpoints")
    rows = v.by_host.filter(F.col("timestamp") < "20200415")
    key = F.concat_ws(":", "crawl_id", "domain_pattern")
    documents = rows.groupBy("crawl_id").agg(
        F.collect_set(key).alias("completed_crawl_domain_pairs"), F.collect_set("filename").alias("completed_warc_files"),
        F.count(F.lit(1)).cast("int").alias("total_articles_inserted"),
    )
    text = documents.select("crawl_id", F.to_json(F.struct(*documents.columns[1:])).alias("value"))
    broken = text.select(F.lit("broken").alias("crawl_id"), F.substring("value", 1, 40).alias("value")).limit(1)
    text.unionByName(broken).repartition("crawl_id").write.partitionBy("crawl_id").text(path)
    found = scan_progress(v.spark, path).unionByName(scan_progress(v.spark, path + "-none"))
    return found.select(
        F.explode("completed_crawl_domain_pairs").alias("pair"), F.size("completed_warc_files").cast("long").alias("n_files"),
        F.col("total_articles_inserted").alias("total"),
    )


QUERIES = {
    "scan_progress_reader": Query(
        _read_checkpoints,
        """WITH done AS (SELECT * FROM by_host WHERE timestamp < '20200415'),
            s AS (SELECT crawl_id, count(*) AS total, count(DISTINCT filename) AS n_files FROM done GROUP BY crawl_id)
            SELECT DISTINCT concat(crawl_id, ':', domain_pattern) AS pair, n_files, total FROM done JOIN s USING (crawl_id)""",
    ),
    "pairs_cross": Query(_pairs, "SELECT crawl_id, domain_pattern FROM pairs"),
    "remaining_work": Query(
        lambda v: progress.remaining_work(_pairs(v), v.ledger_pairs), "SELECT crawl_id, domain_pattern FROM missing"
    ),
    "remaining_files": Query(
        lambda v: progress.remaining_files(v.by_host, v.ledger_files).select("url", "filename", *_PAIR),
        """SELECT url, filename, crawl_id, domain_pattern
           FROM by_host ANTI JOIN ledger_files USING (crawl_id, domain_pattern, filename)""",
    ),
    "missing_by_crawl": Query(
        lambda v: progress.missing_by_crawl(_pairs(v), v.ledger_pairs),
        """SELECT crawl_id, count(*) AS n_missing,
                  string_agg(domain_pattern, ', ' ORDER BY domain_pattern) FILTER (rn <= 3) AS first_missing,
                  greatest(count(*) - 3, 0) AS n_more
           FROM (SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY domain_pattern) AS rn FROM missing)
           GROUP BY crawl_id""",
    ),
    "missing_top3": Query(
        lambda v: progress.missing_top_n(_pairs(v), v.ledger_pairs),
        """SELECT crawl_id, domain_pattern FROM
             (SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY domain_pattern) AS rn FROM missing)
           WHERE rn <= 3""",
    ),
    "progress_summary": Query(
        lambda v: progress.progress_summary(_pairs(v), v.ledger_pairs).withColumn(
            "last_updated", F.date_format("last_updated", "yyyyMMddHHmmss")
        ),
        """SELECT (SELECT count(*) FROM ledger_pairs) AS completed_pairs,
                  (SELECT cast(sum(articles_inserted) AS bigint) FROM ledger_pairs) AS total_articles_inserted,
                  (SELECT max(completed_at) FROM ledger_pairs) AS last_updated,
                  (SELECT count(*) FROM pairs) AS total_combinations,
                  (SELECT count(*) FROM missing) AS missing""",
    ),
    "scan_progress": Query(
        lambda v: progress_pairs(_checkpoints(v)), "SELECT crawl_id, domain_pattern FROM ledger_pairs"
    ),
    "scan_progress_files": Query(
        lambda v: progress_files(_checkpoints(v)), "SELECT DISTINCT filename FROM ledger_files"
    ),
    "build_funnel": Query(
        _funnel,
        r"""WITH idx AS (SELECT *, contains(lower(url), '/en/') OR contains(lower(url), '/de/') AS hit FROM matched),
            good AS (SELECT i.*, row_number() OVER (
                       PARTITION BY md5(trim(regexp_replace(lower(p.content), '\s+', ' ', 'g')))
                       ORDER BY i.timestamp, i.url, i.crawl_id, i.domain_pattern, p.doc_id) AS rn
                     FROM idx i JOIN page_texts p USING (page_id)
                     WHERE hit AND length(p.content) >= 100 AND p.language IN ('en', 'de')),
            s AS (SELECT crawl_id, domain_pattern, count(*) AS urls_found, count(*) FILTER (hit) AS keyword_urls,
                         count(DISTINCT CASE WHEN hit THEN filename END) AS files FROM idx GROUP BY ALL),
            x AS (SELECT crawl_id, domain_pattern, count(*) AS extracted, count(*) FILTER (rn = 1) AS inserted
                  FROM good GROUP BY ALL)
            SELECT crawl_id, domain_pattern, urls_found, keyword_urls, files, coalesce(extracted, 0) AS extracted,
                   coalesce(inserted, 0) AS inserted, coalesce(extracted, 0) - coalesce(inserted, 0) AS duplicates
            FROM s LEFT JOIN x USING (crawl_id, domain_pattern)""",
    ),
    "batch_counts": Query(
        lambda v: progress.batch_counts(
            with_content_hash(v.stored).select("batch_id", "url", "content_hash", "timestamp").join(
                first_per_key(
                    with_content_hash(v.stored).select("content_hash", "timestamp", "url"),
                    ["content_hash"], ["timestamp", "url"],
                ).select("url", F.lit(True).alias("inserted")),
                "url", "left",
            ).na.fill(False, ["inserted"])
        ),
        """SELECT batch_id, count(*) FILTER (rn = 1) AS inserted, count(*) FILTER (rn > 1) AS skipped
           FROM ranked JOIN (SELECT url, batch_id FROM stored) USING (url) GROUP BY batch_id""",
    ),
}
