"""Crawl-index answers: JSON lines in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import default_empty
from ..schemas import CDX_LINES

_CRAWL = r"(CC-MAIN-\d{4}-\d+)"


def scan_cdx(spark: SparkSession, path: str, strict: bool = False, crawl_id: str | None = None) -> DataFrame:
    """Index rows from JSON-lines files.

    Answers of an index seldom name their crawl: it is the given ``crawl_id``, else the field, else the crawl
    named in ``filename``, else the one named in the path of the index file, else ''.
    Bad lines (see ``bad_cdx_lines``) and rows without url are dropped; ``strict=True`` fails on the first bad line.
    """
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    lines = spark.read.schema(CDX_LINES).option("mode", mode).json(path)
    return _typed(lines.withColumn("_from", F.col("_metadata.file_path")), crawl_id)


def bad_cdx_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``scan_cdx`` drops because they are no JSON object, as rows of the error table."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    broken = F.try_parse_json("value").isNull() | ~F.col("value").rlike(r"^\s*\{")
    return lines.filter((F.trim("value") != "") & broken).select(
        F.lit("bad_index_line").alias("error_type"), F.col("value").alias("message"),
        F.create_map(F.lit("filename"), F.col("file")).alias("context"),
    )


def parse_cdx(lines: DataFrame, column: str = "value") -> DataFrame:
    """Index rows from a column of JSON lines; bad lines are dropped."""
    entry = F.from_json(column, CDX_LINES)
    return _typed(lines.select(entry.alias("e")).select("e.*"))


def _typed(rows: DataFrame, crawl_id: str | None = None) -> DataFrame:
    named = [F.lit(crawl_id), F.col("crawl_id"), F.regexp_extract("filename", _CRAWL, 1)]
    if "_from" in rows.columns:
        named.append(F.regexp_extract("_from", _CRAWL, 1))
    given = F.coalesce(*[F.when(n != "", n) for n in named], F.lit(""))
    return rows.filter(F.length("url") > 0).select(
        given.alias("crawl_id"),
        "url",
        default_empty("filename").alias("filename"),
        default_empty("timestamp").alias("timestamp"),
        F.expr("try_cast(offset as bigint)").alias("offset"),
        F.expr("try_cast(length as bigint)").alias("length"),
    )
