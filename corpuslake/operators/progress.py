"""What is done, what is left: ledgers, gap reports and the build funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..defaults import CRAWL_IDS
from .cdx import PAIR
from .ranking import top_n_per_key


def pairs_cross(patterns: DataFrame, crawl_ids: Sequence[str] = CRAWL_IDS) -> DataFrame:
    """Every pattern with every crawl. The crawl list is configuration, so it is unfolded per row."""
    crawls = F.array(*[F.lit(c) for c in crawl_ids])
    return patterns.select(F.explode(crawls).alias("crawl_id"), "domain_pattern")


def remaining_work(pairs: DataFrame, ledger_pairs: DataFrame) -> DataFrame:
    return pairs.join(ledger_pairs.select(*PAIR).distinct(), PAIR, "left_anti")


def remaining_files(index: DataFrame, ledger_files: DataFrame) -> DataFrame:
    """Index rows of files not done for their pair. A file shared by two pairs counts for each."""
    key = [*PAIR, "filename"]
    return index.join(ledger_files.select(*key).distinct(), key, "left_anti")


def missing_by_crawl(pairs: DataFrame, ledger_pairs: DataFrame, show: int = 3) -> DataFrame:
    """Per crawl: missing pairs, the first ``show`` patterns, and how many more there are."""
    missing = remaining_work(pairs, ledger_pairs)
    counts = missing.groupBy("crawl_id").agg(F.count(F.lit(1)).alias("n_missing"))
    named = missing_top_n(pairs, ledger_pairs, show).groupBy("crawl_id").agg(
        F.array_join(F.array_sort(F.collect_list("domain_pattern")), ", ").alias("first_missing")
    )
    return counts.join(named, "crawl_id").withColumn("n_more", F.greatest(F.col("n_missing") - show, F.lit(0)))


def missing_top_n(pairs: DataFrame, ledger_pairs: DataFrame, n: int = 3) -> DataFrame:
    missing = remaining_work(pairs, ledger_pairs).select(*PAIR)
    return top_n_per_key(missing, ["crawl_id"], ["domain_pattern"], n)


def progress_summary(pairs: DataFrame, ledger_pairs: DataFrame) -> DataFrame:
    """Completed pairs, inserted articles, last update, all combinations and the missing ones."""
    done = ledger_pairs.groupBy(*PAIR).agg(
        F.sum("articles_inserted").alias("inserted"), F.max("completed_at").alias("last")
    )
    both = pairs.select(*PAIR, F.lit(True).alias("_wanted")).join(
        done.withColumn("_done", F.lit(True)), PAIR, "full_outer"
    )
    return both.agg(
        F.count("_done").alias("completed_pairs"),
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("total_articles_inserted"),
        F.max("last").alias("last_updated"),
        F.count("_wanted").alias("total_combinations"),
        F.count_if(F.col("_wanted").isNotNull() & F.col("_done").isNull()).alias("missing"),
    )


def build_funnel(index: DataFrame, extracted: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Per pair: urls found, urls kept by keyword, files, articles extracted, inserted, duplicates.

    ``index``: pair, filename, ``keyword_hit``. ``extracted``: pair, ``inserted``.
    """
    # Files are counted from the (pair, file) groups, so no task gathers a pair's file names.
    per_file = index.groupBy(*keys, "filename").agg(
        F.count(F.lit(1)).alias("found"), F.count_if("keyword_hit").alias("kept")
    )
    searched = per_file.groupBy(*keys).agg(
        F.sum("found").alias("urls_found"),
        F.sum("kept").alias("keyword_urls"),
        F.count_if((F.col("kept") > 0) & (F.length("filename") > 0)).alias("files"),
    )
    stored = extracted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("extracted"), F.count_if("inserted").alias("inserted")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (
        searched.join(stored, list(keys), "left")
        .select(*keys, "urls_found", "keyword_urls", "files", zero("extracted"), zero("inserted"))
        .withColumn("duplicates", F.col("extracted") - F.col("inserted"))
    )


def batch_counts(staged: DataFrame) -> DataFrame:
    """Inserted and skipped rows per batch; ``staged``: batch_id, ``inserted``."""
    return staged.groupBy("batch_id").agg(
        F.count_if("inserted").alias("inserted"), F.count_if(~F.col("inserted")).alias("skipped")
    )
