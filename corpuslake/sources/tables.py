"""Readers of the stored tables. All take an explicit schema and stay lazy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import (
    BUCKETED_ARTICLES,
    CHECKPOINT,
    CLASSIFICATIONS,
    FUNNEL,
    LEDGER_FILES,
    LEDGER_PAIRS,
    QUARANTINE,
    SELECTION,
    STORED_ARTICLES,
)


def table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at ``path``, or no rows if there is nothing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


#: Folders of the article table, whatever the number of sources. Part of the format: the same for every table.
SOURCE_BUCKETS = 64


def source_bucket(source: Column) -> Column:
    """The folder that a source's articles lie in."""
    return F.pmod(F.xxhash64(source), F.lit(SOURCE_BUCKETS)).cast("int")


def init_articles(spark: SparkSession, path: str) -> DataFrame:
    """Create the article table if it is not there; return it either way."""
    empty = spark.createDataFrame([], BUCKETED_ARTICLES)
    empty.write.mode("ignore").partitionBy("source_bucket").parquet(path)
    return scan_articles(spark, path)


def scan_articles(spark: SparkSession, path: str, sources: Sequence[str] | None = None) -> DataFrame:
    """The article table, or the articles of some sources.

    Articles lie in folders by a hash of their source, sorted by source and day inside. With ``sources`` only their
    folders are read, and of those only the row groups whose statistics allow for them. A filter on ``source_domain`` or on
    the other columns uses the statistics of all folders.
    """
    rows = spark.read.schema(BUCKETED_ARTICLES).parquet(path)
    if sources is not None:
        wanted = list(dict.fromkeys(sources))
        rows = rows.filter(F.col("source_bucket").isin([source_bucket(F.lit(s)) for s in wanted]) & F.col("source_domain").isin(wanted))
    return rows.select(*STORED_ARTICLES.names)


def scan_classifications(spark: SparkSession, path: str) -> DataFrame:
    """Earlier labels, each url once; no rows if the table does not exist."""
    from ..operators.classify import one_label_per_url

    return one_label_per_url(table_or_empty(spark, path, CLASSIFICATIONS))


def scan_ledger_pairs(spark: SparkSession, path: str) -> DataFrame:
    return table_or_empty(spark, path, StructType([*LEDGER_PAIRS.fields, SELECTION]))


def scan_ledger_files(spark: SparkSession, path: str) -> DataFrame:
    return table_or_empty(spark, path, StructType([*LEDGER_FILES.fields, SELECTION]))


def scan_funnel(spark: SparkSession, path: str) -> DataFrame:
    """Numbers of each build per pair."""
    return table_or_empty(spark, path, FUNNEL)


def scan_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return table_or_empty(spark, path, QUARANTINE)


def scan_progress(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoint documents (one JSON object per file); none if missing or unreadable."""
    try:
        lines = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return parse_progress(lines, "value")


def parse_progress(lines: DataFrame, column: str = "value") -> DataFrame:
    """Checkpoint JSON text -> typed columns; broken documents are dropped, missing fields are empty."""
    state = F.from_json(column, CHECKPOINT, {"mode": "PERMISSIVE"})
    valid = F.try_parse_json(column).isNotNull() & F.col(column).rlike(r"^\s*\{")
    none = F.array().cast("array<string>")
    return lines.filter(valid).select(state.alias("s")).select(
        F.coalesce("s.completed_crawl_domain_pairs", none).alias("completed_crawl_domain_pairs"),
        F.coalesce("s.completed_warc_files", none).alias("completed_warc_files"),
        F.coalesce("s.total_articles_inserted", F.lit(0)).alias("total_articles_inserted"),
        F.coalesce("s.last_updated", F.lit("")).alias("last_updated"),
    )


def progress_pairs(progress: DataFrame) -> DataFrame:
    """Completed pairs of a checkpoint: 'crawl:pattern' split at the first colon."""
    key = F.explode("completed_crawl_domain_pairs")
    return progress.select(key.alias("k")).distinct().select(
        F.regexp_extract("k", r"^([^:]*):", 1).alias("crawl_id"),
        F.regexp_extract("k", r"^[^:]*:(.*)$", 1).alias("domain_pattern"),
    )


def progress_files(progress: DataFrame) -> DataFrame:
    return progress.select(F.explode("completed_warc_files").alias("filename")).distinct()
