"""Filters, grouping and per-pair limits over crawl-index rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import CRAWL_IDS, DOMAIN_PATTERNS, KEYWORDS
from ..functions import host, lower_contains, stamp_bound
from .ranking import first_per_key, top_n_per_key

PAIR = ["crawl_id", "domain_pattern"]


def pattern_table(spark: SparkSession, patterns: Sequence[str] = DOMAIN_PATTERNS) -> DataFrame:
    """Host patterns as a table (domain_pattern).

    Built from Arrow data, it becomes a local relation of known size, so Spark broadcasts it while it is
    small; a table made from Python rows has no size and would make the index shuffle.
    """
    return spark.createDataFrame(pa.table({"domain_pattern": list(dict.fromkeys(patterns))}))


#: Parts that the rows of a bare top-level domain are cut into; its rules, a few thousand in the world, go to all of them.
SALTS = 32


def domain_match(index: DataFrame, patterns: DataFrame) -> DataFrame:
    """Index rows with each host pattern they fall under.

    A host is expanded to its suffixes of those lengths (in labels) that some pattern has, so the match is an equi-join: a
    hash join over the patterns when Spark finds them small, a shuffled one otherwise, and never a nested loop. No row is
    made for lengths that no pattern has, so ``com`` is a key only if ``*.com`` is a pattern; and then the key is cut into
    SALTS parts. Adaptive execution cuts longer suffixes that hold a large share.
    """
    bare = F.regexp_replace(F.lower("domain_pattern"), r"^[a-z]+://", "")
    rules = patterns.select(
        "domain_pattern",
        F.startswith(bare, F.lit("*.")).alias("_below"),
        F.regexp_extract(bare, r"^(?:\*\.)?([^/]*)", 1).alias("_suffix"),
    ).withColumn("_labels", F.size(F.split("_suffix", r"\.")))
    depths = rules.agg(F.coalesce(F.collect_set("_labels"), F.array().cast("array<int>")).alias("depths")).scalar()
    salts = F.when(F.col("_labels") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    rules = rules.withColumn("_salt", F.explode(salts)).drop("_labels")
    spread = index.withColumn("_host", host("url")).withColumn("_n", F.explode(depths))
    spread = spread.filter(F.col("_n") <= F.size(F.split("_host", r"\.")))
    spread = spread.withColumn("_suffix", F.call_function("substring_index", "_host", F.lit("."), -F.col("_n"))).drop("_n")
    salt = F.when(F.contains("_suffix", F.lit(".")), 0).otherwise(F.pmod(F.xxhash64("url"), F.lit(SALTS))).cast("int")
    return (
        spread.withColumn("_salt", salt)
        .join(rules, ["_suffix", "_salt"], "inner")
        .filter(F.col("_below") | (F.col("_suffix") == F.col("_host")))
        .drop("_host", "_suffix", "_below", "_salt")
    )


def date_range(index: DataFrame, date_start: str | None = None, date_end: str | None = None) -> DataFrame:
    """Optional bounds on capture time, each on its own, both included."""
    if date_start:
        index = index.filter(F.col("timestamp") >= stamp_bound(date_start))
    if date_end:
        index = index.filter(F.col("timestamp") <= stamp_bound(date_end, upper=True))
    return index


def filter_keywords(
    index: DataFrame,
    keywords: Sequence[str] = KEYWORDS,
    lower_terms: bool = True,
    word_boundary: bool = False,
) -> DataFrame:
    """Rows whose lower-cased url contains a keyword. No keywords, no rows."""
    return index.filter(lower_contains("url", keywords, lower_terms, word_boundary))


def filter_keywords_inline(
    index: DataFrame,
    keywords: Sequence[str] = (),
    limit: int | None = None,
    keys: Sequence[str] = PAIR,
) -> DataFrame:
    """As the index query does it: no keywords means no filter; with ``limit`` at most so many rows per pair."""
    rows = index.filter(lower_contains("url", keywords, lower_terms=False)) if keywords else index
    return rows if limit is None else urls_top_n(rows, limit, keys)


def filter_keywords_content(index: DataFrame, texts: DataFrame, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """Index rows whose page text (url, content) contains a keyword."""
    hits = texts.filter(lower_contains("content", keywords)).select("url")
    return index.join(hits, "url", "left_semi")


def nonempty_filename(index: DataFrame) -> DataFrame:
    return index.filter(F.length("filename") > 0)


def urls_top_n(index: DataFrame, limit: int, keys: Sequence[str] = PAIR) -> DataFrame:
    """At most ``limit`` rows per pair, in url and capture order."""
    return top_n_per_key(index, keys, ["url", "timestamp", "filename", "offset"], limit, salt=["url"])


def files_top_n(index: DataFrame, max_files: int | None, keys: Sequence[str] = PAIR) -> DataFrame:
    """Rows of the first ``max_files`` archive files of each pair.

    Files are made distinct before they are ranked, and each task ranks only its own first ones, so
    neither a pair's rows nor its files pile up in one task.
    """
    if not max_files:
        return index
    files = nonempty_filename(index).select(*keys, "filename").distinct()
    kept = top_n_per_key(files, keys, ["filename"], max_files, salt=["filename"])
    return index.join(kept, [*keys, "filename"], "left_semi")


def warc_groups(index: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per archive file: how many index rows and which byte span they cover."""
    return nonempty_filename(index).groupBy(*keys, "filename").agg(
        F.count(F.lit(1)).alias("n_urls"),
        F.min("offset").alias("first_offset"),
        F.max(F.col("offset") + F.col("length")).alias("end_offset"),
    )


def group_by_warc(index: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Index rows with the size of their file's group.

    The members stay flat rows: one file may hold a third of the index, and an array of them would
    have to fit into one task.
    """
    rows = nonempty_filename(index)
    sizes = rows.groupBy(*keys, "filename").agg(F.count(F.lit(1)).alias("urls_in_file"))
    return rows.join(sizes, [*keys, "filename"])


def first_index_row(index: DataFrame) -> DataFrame:
    """One row per (filename, url): the earliest capture."""
    return first_per_key(index, ["filename", "url"], ["timestamp", "offset"])


def attach_index_row(articles: DataFrame, index: DataFrame, fields: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Articles (with filename) with ``fields`` of their index row; '' where there is none."""
    columns = dict.fromkeys(["filename", "url", "timestamp", "offset", *fields])
    rows = first_index_row(index.select(*columns)).select("filename", "url", *fields)
    return articles.join(rows, ["filename", "url"], "left").na.fill("", list(fields))


def target_records(records: DataFrame, index: DataFrame) -> DataFrame:
    """Response records whose url is wanted."""
    targets = index.filter(F.length("url") > 0).select(F.col("url").alias("target_uri"))
    return records.filter(F.col("warc_type") == "response").join(targets, "target_uri", "left_semi")


def query_all_pairs(
    index: DataFrame,
    patterns: DataFrame,
    crawl_ids: Sequence[str] = CRAWL_IDS,
    keywords: Sequence[str] = (),
    limit_per_domain: int | None = None,
    date_start: str | None = None,
    date_end: str | None = None,
) -> DataFrame:
    """Answers of every (crawl, pattern) query in one job: flat rows with the pair's two columns."""
    rows = date_range(index.filter(F.col("crawl_id").isin(list(crawl_ids))), date_start, date_end)
    return filter_keywords_inline(domain_match(rows, patterns), keywords, limit_per_domain)
