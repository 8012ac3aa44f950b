"""Table schemas. Always hand them to the reader: inference would turn ``source_domain=2020`` into an int."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ARTICLE_COLUMNS = [
    "url", "title", "content", "content_hash", "source_domain",
    "crawl_id", "timestamp", "language", "status_code", "publish_date",
]

ARTICLES = StructType([StructField(c, StringType()) for c in ARTICLE_COLUMNS])
STORED_ARTICLES = StructType(ARTICLES.fields + [StructField("batch_id", LongType())])
# As the table lies in storage: the folder is a hash of the source.
BUCKETED_ARTICLES = StructType(STORED_ARTICLES.fields + [StructField("source_bucket", IntegerType())])

CDX = StructType(
    [
        StructField("crawl_id", StringType()),
        StructField("url", StringType()),
        StructField("filename", StringType()),
        StructField("timestamp", StringType()),
        StructField("offset", LongType()),
        StructField("length", LongType()),
    ]
)
# Index answers carry numbers as JSON strings, so the raw lines are read as text and cast afterwards.
CDX_LINES = StructType([StructField(f.name, StringType()) for f in CDX.fields])

WARC_RECORDS = StructType(
    [
        StructField("filename", StringType()),
        StructField("warc_type", StringType()),
        StructField("target_uri", StringType()),
        StructField("warc_date", StringType()),
        StructField("headers", MapType(StringType(), StringType())),
        StructField("status_code", StringType()),
        StructField("payload", BinaryType()),
    ]
)

LEDGER_PAIRS = StructType(
    [
        StructField("crawl_id", StringType()),
        StructField("domain_pattern", StringType()),
        StructField("articles_inserted", LongType()),
        StructField("completed_at", TimestampType()),
    ]
)
LEDGER_FILES = StructType(
    [
        StructField("crawl_id", StringType()),
        StructField("domain_pattern", StringType()),
        StructField("filename", StringType()),
        StructField("completed_at", TimestampType()),
    ]
)
# What dates and keywords the work was done for.
SELECTION = StructField("selection", StringType())
FUNNEL = StructType(
    [StructField("crawl_id", StringType()), StructField("domain_pattern", StringType())]
    + [StructField(c, LongType()) for c in ("urls_found", "keyword_urls", "files", "extracted", "inserted", "duplicates", "batch_id")]
)
CHECKPOINT = StructType(
    [
        StructField("completed_crawl_domain_pairs", ArrayType(StringType())),
        StructField("completed_warc_files", ArrayType(StringType())),
        StructField("total_articles_inserted", LongType()),
        StructField("last_updated", StringType()),
    ]
)
QUARANTINE = StructType(
    [
        StructField("error_type", StringType()),
        StructField("message", StringType()),
        StructField("context", MapType(StringType(), StringType())),
        StructField("at", TimestampType()),
    ]
)
CLASSIFICATIONS = StructType([StructField("url", StringType()), StructField("category", StringType())])
