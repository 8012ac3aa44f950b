"""The headline report: what each source contributes once copies are removed."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import content_hash, day_text, text_length
from ..operators.dedup import dedup_first


def corpus_report(articles: DataFrame) -> DataFrame:
    """Per source: distinct articles, mean length, days covered.

    Rows are cut to a hash, a length and a few short fields before the shuffle of the deduplication.
    """
    narrow = articles.select(
        content_hash("content").alias("content_hash"), "timestamp", "url", "source_domain",
        day_text("publish_date").alias("publish_date"), text_length("content").alias("chars"),
    )
    by_day = dedup_first(narrow).groupBy("source_domain", "publish_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")
    )
    return (
        by_day.groupBy("source_domain")
        .agg(
            F.sum("n").alias("article_count"),
            F.round(F.sum("chars") / F.sum("n"), 6).alias("avg_content_length"),
            F.count_if(F.length("publish_date") > 0).alias("days_covered"),
        )
        .orderBy(F.desc("article_count"), "source_domain")
    )
