"""The given tables seen as corpus tables, once for Spark and once, with the same meaning, in SQL."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import capture_time, host
from ..operators import cdx as cdx_ops
from ..operators.dedup import with_content_hash
from ..schemas import CDX
from ..session import scratch_path
from ..sources.warc import parse_members

CRAWLS = ["CC-MAIN-2020-16", "CC-MAIN-2020-24", "CC-MAIN-2020-32"]
PATTERNS = ["*.example.com/", "*.example.net/", "*.example.org/"]
# Captures before this stamp count as the work of an earlier run.
EARLIER = "20200415"


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def as_articles(documents: DataFrame) -> DataFrame:
        """Batch or stream of ``documents`` as articles."""
        d = F.col("doc_id")
        return documents.select(
            "doc_id",
            F.concat(F.lit("https://"), "source", F.lit(".example/a/"), d.cast("string")).alias("url"),
            F.left("text", F.lit(80)).alias("title"),
            F.col("text").alias("content"),
            F.col("source").alias("source_domain"),
            F.concat(F.lit("CC-MAIN-2020-"), (16 + 8 * (d % 3)).cast("string")).alias("crawl_id"),
            F.concat(
                F.lit("2020"), _two(3 + d % 4), _two(1 + d % 28), _two(d % 24), F.lit("3045")
            ).alias("timestamp"),
            F.col("lang").alias("language"),
            F.lit("200").alias("status_code"),
            F.when(d % 10 == 0, "").otherwise(
                F.concat(F.lit("2020-"), _two(3 + d % 4), F.lit("-"), _two(1 + d % 28))
            ).alias("publish_date"),
        )

    @cached_property
    def articles(self) -> DataFrame:
        return self.as_articles(self.table("documents"))

    @cached_property
    def built(self) -> DataFrame:
        """Articles as a build stores them: the publish date has a time of day."""
        time = F.concat(F.lit(" "), _two(F.col("doc_id") % 24), F.lit(":30:45"))
        dated = F.when(F.col("publish_date") == "", "").otherwise(F.concat("publish_date", time))
        return self.articles.withColumn("publish_date", dated)

    @cached_property
    def hashed(self) -> DataFrame:
        return with_content_hash(self.articles)

    @cached_property
    def stored(self) -> DataFrame:
        """Articles as three ingest batches, one per crawl."""
        n = (F.right("crawl_id", F.lit(2)).cast("long") - 16) / 8
        return self.articles.withColumn("batch_id", n.cast("long"))

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def cdx(self) -> DataFrame:
        p = F.col("page_id")
        return self.pages.select(
            "page_id",
            "url",
            F.concat(F.lit("CC-MAIN-2020-"), (16 + 8 * (p % 3)).cast("string")).alias("crawl_id"),
            F.concat(F.lit("w"), (p % 7).cast("string"), F.lit(".warc.gz")).alias("filename"),
            F.concat(F.lit("202004"), _two(1 + p % 28), F.lit("123045")).alias("timestamp"),
            (p * 1000).alias("offset"),
            F.lit(1000).cast("long").alias("length"),
        )

    @cached_property
    def patterns(self) -> DataFrame:
        return cdx_ops.pattern_table(self.spark, PATTERNS)

    @cached_property
    def matched(self) -> DataFrame:
        return cdx_ops.domain_match(self.cdx, self.patterns)

    @cached_property
    def by_host(self) -> DataFrame:
        """Index rows with one pattern per host: many pairs, as in a wide crawl."""
        return self.cdx.withColumn("domain_pattern", F.concat(F.lit("*."), host("url"), F.lit("/")))

    @cached_property
    def host_patterns(self) -> DataFrame:
        return self.by_host.select("domain_pattern").distinct()

    @cached_property
    def ledger_pairs(self) -> DataFrame:
        earlier = self.by_host.filter(F.col("timestamp") < EARLIER)
        return earlier.groupBy("crawl_id", "domain_pattern").agg(
            F.count(F.lit(1)).alias("articles_inserted"),
            capture_time(F.max("timestamp")).alias("completed_at"),
        )

    @cached_property
    def ledger_files(self) -> DataFrame:
        earlier = self.by_host.filter(F.col("timestamp") < EARLIER)
        return earlier.select("crawl_id", "domain_pattern", "filename").distinct()

    @cached_property
    def page_texts(self) -> DataFrame:
        """Every document as a text of some page; a page has several."""
        page = F.col("doc_id") % self.pages.count()
        texts = self.table("documents").select("doc_id", page.alias("page_id"), "text", "lang")
        return self.cdx.join(texts, "page_id").select(
            "doc_id", "page_id", "url", "filename", "crawl_id", F.col("text").alias("content"), F.col("lang").alias("language")
        )

    @cached_property
    def labels(self) -> DataFrame:
        """Earlier labels: a category, a failed call, or none yet."""
        category = F.when(F.col("toxic") == 1, "error").when(F.col("quality") == 1, "health_outcomes")
        return self.table("labels").join(self.articles.select("doc_id", "url"), "doc_id").select(
            "url", category.alias("category")
        )

    @cached_property
    def errors(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_type").alias("error_type"),
            F.col("props").alias("message"),
            F.col("ts").alias("at"),
            "event_id",
        )

    @cached_property
    def checks(self) -> DataFrame:
        return self.table("events").select(
            F.lit("index").alias("service"),
            "ts",
            F.col("event_id").alias("check_id"),
            F.when(F.col("event_type") == "error", "DOWN").otherwise("UP").alias("status"),
        )

    @cached_property
    def user_checks(self) -> DataFrame:
        return self.checks.drop("service").join(
            self.table("events").select(F.col("event_id").alias("check_id"), F.col("user_id").cast("string").alias("service")),
            "check_id",
        )

    def arriving(self, name: str, parts: list[Column]) -> Iterator[DataFrame]:
        """A table as a stream of folders that come one after the other. Each time the stream is handed out a further part
        has been written, by as many tasks as its size asks for; what is started on it takes up where the last start ended."""
        path, given = scratch_path(self.spark, name), self.table(name)
        for part in parts:
            given.filter(part).write.mode("append").parquet(path)
            yield self.spark.readStream.schema(given.schema).parquet(path)

    def packed_pages(self) -> DataFrame:
        """Pages as archive records: (filename, member) and the index fields but for the byte range."""
        head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"), "html")
        block = head.cast("binary")
        record = F.concat(
            F.concat(
                F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), "url",
                F.lit("\r\nWARC-Date: "),
                F.date_format(capture_time("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                F.lit("\r\nContent-Length: "), F.octet_length(head).cast("string"), F.lit("\r\n\r\n"),
            ).cast("binary"),
            block,
            F.lit("\r\n\r\n").cast("binary"),
        )
        pages = self.cdx.join(self.pages.select("page_id", "html"), "page_id")
        return pages.select("crawl_id", "url", "filename", "timestamp", record.alias("member"))

    @cached_property
    def warc_records(self) -> DataFrame:
        """Pages packed as archive records and read back."""
        return parse_members(self.packed_pages())

    def written_archives(self, base: str, requests: bool = False) -> DataFrame:
        """Pages written as gzip archives below ``base``, one file per task; returns their index. With ``requests`` a
        record of the request stands before each page."""

        def request(url: str) -> bytes:
            block = f"GET {url} HTTP/1.1\r\nAccept: text/html\r\n\r\n".encode()
            head = f"WARC/1.0\r\nWARC-Type: request\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(block)}\r\n\r\n"
            return head.encode() + block + b"\r\n\r\n"

        def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, at = f"part-{TaskContext.get().partitionId():05d}.warc.gz", 0
            storage, folder = fs.FileSystem.from_uri(base)
            storage.create_dir(folder)
            with storage.open_output_stream(f"{folder}/{name}", compression=None) as out:
                for batch in batches:
                    members = [gzip.compress(m) for m in batch["member"]]
                    before = [gzip.compress(request(u)) if requests else b"" for u in batch["url"]]
                    lengths = [len(m) for m in members]
                    out.write(b"".join(b + m for b, m in zip(before, members, strict=True)))
                    ends = [at + x for x in accumulate(len(b) + n for b, n in zip(before, lengths, strict=True))]
                    offsets = [end - n for end, n in zip(ends, lengths, strict=True)]
                    at = ends[-1] if ends else at
                    index = batch[["crawl_id", "url", "timestamp"]]
                    yield index.assign(filename=name, offset=offsets, length=lengths)

        index = self.packed_pages().mapInPandas(
            write, "crawl_id string, url string, timestamp string, filename string, offset long, length long"
        )
        path = scratch_path(self.spark, "index")
        index.write.parquet(path)
        return self.spark.read.schema(CDX).parquet(path)


_ARTICLES = """
  SELECT doc_id, concat('https://', source, '.example/a/', cast(doc_id AS varchar)) AS url,
         left(text, 80) AS title, text AS content, source AS source_domain,
         concat('CC-MAIN-2020-', cast(16 + 8 * (doc_id % 3) AS varchar)) AS crawl_id,
         concat('2020', lpad(cast(3 + doc_id % 4 AS varchar), 2, '0'), lpad(cast(1 + doc_id % 28 AS varchar), 2, '0'),
                lpad(cast(doc_id % 24 AS varchar), 2, '0'), '3045') AS timestamp,
         lang AS language, '200' AS status_code,
         CASE WHEN doc_id % 10 = 0 THEN ''
              ELSE concat('2020-', lpad(cast(3 + doc_id % 4 AS varchar), 2, '0'), '-',
                          lpad(cast(1 + doc_id % 28 AS varchar), 2, '0')) END AS publish_date
  FROM documents"""
_CDX = """
  SELECT page_id, url, concat('CC-MAIN-2020-', cast(16 + 8 * (page_id % 3) AS varchar)) AS crawl_id,
         concat('w', cast(page_id % 7 AS varchar), '.warc.gz') AS filename,
         concat('202004', lpad(cast(1 + page_id % 28 AS varchar), 2, '0'), '123045') AS timestamp,
         page_id * 1000 AS "offset", cast(1000 AS bigint) AS length
  FROM pages"""
_HOST = "regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), ':[0-9]*$', '')"

_CTES = {
    "articles": _ARTICLES,
    "hashed": r"SELECT *, md5(trim(regexp_replace(lower(content), '\s+', ' ', 'g'))) AS content_hash FROM articles",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY timestamp, url) AS rn FROM hashed",
    "stored": "SELECT *, cast((cast(right(crawl_id, 2) AS bigint) - 16) // 8 AS bigint) AS batch_id FROM articles",
    "cdx": _CDX,
    "patterns": "SELECT * FROM (VALUES ('*.example.com/', 'example.com'), ('*.example.net/', 'example.net'), "
                "('*.example.org/', 'example.org')) v(domain_pattern, d)",
    "hosts": f"SELECT *, {_HOST} AS host FROM cdx",
    "matched": "SELECT hosts.* EXCLUDE (host), domain_pattern FROM hosts JOIN patterns "
               "ON host = d OR host LIKE concat('%.', d)",
    "by_host": "SELECT * EXCLUDE (host), concat('*.', host, '/') AS domain_pattern FROM hosts",
    "crawls": "SELECT * FROM (VALUES ('CC-MAIN-2020-16'), ('CC-MAIN-2020-24'), ('CC-MAIN-2020-32')) v(crawl_id)",
    "pairs": "SELECT crawl_id, domain_pattern FROM crawls, (SELECT DISTINCT domain_pattern FROM by_host)",
    "ledger_pairs": "SELECT crawl_id, domain_pattern, count(*) AS articles_inserted, max(timestamp) AS completed_at "
                    f"FROM by_host WHERE timestamp < '{EARLIER}' GROUP BY ALL",
    "ledger_files": f"SELECT DISTINCT crawl_id, domain_pattern, filename FROM by_host WHERE timestamp < '{EARLIER}'",
    "missing": "SELECT * FROM pairs ANTI JOIN ledger_pairs USING (crawl_id, domain_pattern)",
    "page_texts": "SELECT doc_id, page_id, url, filename, crawl_id, text AS content, lang AS language "
                  "FROM cdx JOIN documents ON doc_id % (SELECT count(*) FROM pages) = page_id",
    "old_labels": "SELECT url, CASE WHEN toxic = 1 THEN 'error' WHEN quality = 1 THEN 'health_outcomes' END AS category "
                  "FROM labels JOIN articles USING (doc_id)",
    "errors": "SELECT event_type AS error_type, props AS message, ts AS seen_at, event_id FROM events",
    "checks": "SELECT 'index' AS service, ts, event_id AS check_id, "
              "CASE WHEN event_type = 'error' THEN 'DOWN' ELSE 'UP' END AS status FROM events",
    "user_checks": "SELECT cast(user_id AS varchar) AS service, ts, event_id AS check_id, "
                   "CASE WHEN event_type = 'error' THEN 'DOWN' ELSE 'UP' END AS status FROM events",
}


def with_views(body: str) -> str:
    """A stand-alone query: the views ``body`` uses, directly or through others, then ``body``."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name, sql in _CTES.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(sql)
                if name not in used:
                    used.append(name)

    visit(body)
    if not used:
        return body
    ctes = ",\n".join(f"{n} AS ({_CTES[n].strip()})" for n in used)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"
