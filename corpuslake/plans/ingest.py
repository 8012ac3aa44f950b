"""From crawl index and archives to stored articles."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import CRAWL_IDS, DOMAIN_PATTERNS, KEYWORDS, LANGUAGES, MIN_TEXT_CHARS
from ..functions import cdx_publish_date, lower_contains
from ..operators import cdx, extract, progress
from ..operators.dedup import with_content_hash
from ..schemas import FUNNEL
from ..session import scratch_path
from ..sinks.articles import BatchResult, compact_small_files, finish_compaction, insert_staged, next_batch_id
from ..sinks.ledgers import mark_files, mark_pairs, quarantine
from ..sources.tables import init_articles, scan_articles, scan_ledger_files, scan_ledger_pairs
from ..sources.warc import UNREADABLE, read_outlines, unreadable


@dataclass(frozen=True)
class Store:
    """Where the tables of one corpus live."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def articles(self) -> str:
        return self.path("articles")

    @property
    def pairs(self) -> str:
        return self.path("ledger_pairs")

    @property
    def files(self) -> str:
        return self.path("ledger_files")

    @property
    def funnel(self) -> str:
        return self.path("funnel")

    @property
    def errors(self) -> str:
        return self.path("quarantine")


def selection_key(keywords: Sequence[str], date_start: str | None, date_end: str | None) -> str:
    """Name of what a build looks for. Ledgers keep it, so a build with wider dates or other keywords is new work."""
    wanted = json.dumps([sorted(set(keywords)), date_start or "", date_end or ""])
    return hashlib.sha256(wanted.encode()).hexdigest()[:16]


def matched_index(
    index: DataFrame,
    patterns: DataFrame,
    crawl_ids: Sequence[str] = CRAWL_IDS,
    keywords: Sequence[str] = KEYWORDS,
    date_start: str | None = None,
    date_end: str | None = None,
) -> DataFrame:
    """Index rows of the crawls and dates with each (crawl_id, domain_pattern) and ``keyword_hit``."""
    rows = cdx.date_range(index.filter(F.col("crawl_id").isin(list(crawl_ids))), date_start, date_end)
    return cdx.domain_match(rows, patterns).withColumn("keyword_hit", lower_contains("url", keywords))


def select_targets(
    index: DataFrame,
    patterns: DataFrame,
    crawl_ids: Sequence[str] = CRAWL_IDS,
    keywords: Sequence[str] = KEYWORDS,
    date_start: str | None = None,
    date_end: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Index rows to fetch, with their (crawl_id, domain_pattern). Narrow steps only, up to the file limit."""
    rows = matched_index(index, patterns, crawl_ids, keywords, date_start, date_end)
    return cdx.files_top_n(cdx.nonempty_filename(rows.filter("keyword_hit").drop("keyword_hit")), max_files)


def stamped_targets(targets: DataFrame) -> DataFrame:
    """Targets where all captures of a url in a file carry crawl and stamp of the first one."""
    return cdx.attach_index_row(targets.drop("timestamp", "crawl_id"), targets, ["timestamp", "crawl_id"])


def not_found(targets: DataFrame, records: DataFrame) -> DataFrame:
    """Wanted (filename, url) for which no record came back, as rows of the error table."""
    key = ["filename", "url"]
    lost = targets.select(*key).distinct().join(
        records.select("filename", F.col("wanted_url").alias("url")).distinct(), key, "left_anti"
    )
    return lost.select(
        F.lit("record_not_found").alias("error_type"), F.lit("no record of this url at its place").alias("message"),
        F.create_map(F.lit("url"), F.col("url"), F.lit("filename"), F.col("filename")).alias("context"),
    )


def run_build(
    spark: SparkSession,
    index: DataFrame,
    warc_base: str,
    store: Store,
    batch_id: int | None = None,
    patterns: Sequence[str] = DOMAIN_PATTERNS,
    crawl_ids: Sequence[str] = CRAWL_IDS,
    keywords: Sequence[str] = KEYWORDS,
    date_start: str | None = None,
    date_end: str | None = None,
    max_files: int | None = None,
    min_chars: int = MIN_TEXT_CHARS,
    max_chars: int | None = None,
    languages: Sequence[str] = LANGUAGES,
    resume: bool = True,
    parity: bool = False,
    partitions: int | None = None,
    compact_every: int | None = None,
) -> BatchResult:
    """One resumable build over every (crawl, pattern) pair that is left.

    All pairs run as one job. Archives are read and pages parsed once, into shared storage, from where the
    new articles are taken; page text is not joined to the index, whose fields travel with it.

    A file is done for a pair and a selection (dates, keywords) when each of its targets was stored, was a copy, was
    rejected, or stands in the error table as not found; a file with a range that could not be read stays open.
    A pair is done when all its files are and ``max_files`` left none out, unless the index has no row of its crawl.
    Ledgers are written after the articles, so a run that dies is repeated, and content stored already is not stored
    again. Index rows without a crawl go to the error table. The numbers of each pair go to ``store.funnel``.
    With ``compact_every`` the small files of the article table are gathered after every so many batches.
    """
    init_articles(spark, store.articles)
    finish_compaction(spark, store.articles)
    batch_id = next_batch_id(scan_articles(spark, store.articles)) if batch_id is None else batch_id
    rules = cdx.pattern_table(spark, patterns)
    pairs = progress.pairs_cross(rules, crawl_ids)
    selection = selection_key(keywords, date_start, date_end)
    found = matched_index(index, rules, crawl_ids, keywords, date_start, date_end)
    if resume:
        ours = F.col("selection") == selection
        pairs = progress.remaining_work(pairs, scan_ledger_pairs(spark, store.pairs).filter(ours))
        found = found.join(pairs, cdx.PAIR, "left_semi")
        found = progress.remaining_files(found, scan_ledger_files(spark, store.files).filter(ours))
    found = _staged(found, "matched")
    open_targets = cdx.nonempty_filename(found.filter("keyword_hit").drop("keyword_hit"))
    targets = _staged(cdx.files_top_n(open_targets, max_files), "targets") if max_files else open_targets
    nameless = index.filter((F.length("url") > 0) & (F.coalesce("crawl_id", F.lit("")) == "")).select(
        F.lit("no_crawl_id").alias("error_type"), F.lit("index row names no crawl").alias("message"),
        F.create_map(F.lit("url"), F.col("url"), F.lit("filename"), F.col("filename")).alias("context"),
    )
    seen_crawls = index.select("crawl_id").distinct()

    if targets.isEmpty():
        quarantine(nameless, store.errors)
        idle = pairs.join(seen_crawls, "crawl_id", "left_semi")
        mark_pairs(idle.select("*", F.lit(0).alias("articles_inserted"), F.lit(selection).alias("selection")), store.pairs)
        return BatchResult(batch_id, 0, 0)

    tasks = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = stamped_targets(targets.drop("domain_pattern")).withColumn("wanted_url", F.col("url"))
    carry = ["wanted_url", "timestamp", "crawl_id"]
    records = read_outlines(wanted, warc_base, tasks, carry).filter(
        (F.col("warc_type") == UNREADABLE)
        | ((F.col("warc_type") == "response") & (F.col("target_uri") == F.col("wanted_url")))
    )
    extracted = extract.extract_pages(
        records, min_chars=min_chars, max_chars=max_chars, languages=languages,
        keep=["filename", "warc_type", "error", "timestamp", "crawl_id", "wanted_url"],
    )
    extracted = _staged(with_content_hash(extracted.withColumn("publish_date", cdx_publish_date("timestamp", parity))), "pages")

    damaged = extracted.filter(F.col("warc_type") == UNREADABLE)
    pages = extracted.filter(F.col("warc_type") == "response")
    result = insert_staged(pages.filter(F.col("reject_reason").isNull()), store.articles, batch_id)
    lost = not_found(targets, extracted)
    quarantine(
        unreadable(damaged).unionByName(extract.rejected(pages)).unionByName(lost).unionByName(nameless), store.errors
    )

    failed = damaged.select("filename").distinct()
    marked = F.lit(selection).alias("selection")
    done = targets.select(*cdx.PAIR, "filename").distinct().join(failed, "filename", "left_anti")
    mark_files(done.select("*", marked), store.files)
    stored = scan_articles(spark, store.articles).filter(F.col("batch_id") == batch_id).select("url", "crawl_id").distinct()
    accepted = pages.filter(F.col("reject_reason").isNull()).select("filename", F.col("wanted_url").alias("url"))
    of_pair = accepted.join(targets.select("filename", "url", *cdx.PAIR).distinct(), ["filename", "url"]).join(
        stored.withColumn("inserted", F.lit(True)), ["url", "crawl_id"], "left"
    ).na.fill(False, ["inserted"])
    funnel = progress.build_funnel(found, of_pair).withColumn("batch_id", F.lit(batch_id).cast("long"))
    funnel.select(*FUNNEL.names).write.mode("append").parquet(store.funnel)

    left = open_targets.select(*cdx.PAIR, "filename").distinct().join(done, [*cdx.PAIR, "filename"], "left_anti")
    by_pair = funnel.select(*cdx.PAIR, F.col("inserted").alias("articles_inserted"))
    finished = pairs.join(seen_crawls, "crawl_id", "left_semi").join(left.select(*cdx.PAIR).distinct(), cdx.PAIR, "left_anti")
    finished = finished.join(by_pair, cdx.PAIR, "left").na.fill(0, ["articles_inserted"])
    mark_pairs(finished.select("*", marked), store.pairs)
    if compact_every and (batch_id + 1) % compact_every == 0:
        compact_small_files(spark, store.articles)
    return result


def _staged(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
