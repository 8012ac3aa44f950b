"""Label articles and write the result, resuming from earlier labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.articles import load_articles
from ..operators.classify import Scorer, articles_with_category, classify_articles
from ..operators.metrics import category_counts
from ..sinks.ledgers import write_classifications
from ..sources.tables import scan_classifications, table_or_empty
from ..schemas import CLASSIFICATIONS


def run_labelling(
    spark: SparkSession,
    articles: DataFrame,
    labels_in: str | None,
    labels_out: str,
    enriched_out: str,
    scorer: Scorer | None = None,
    input_filter: str | Column | None = None,
    limit: int | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """Returns counts per category.

    Labels and enriched articles go to new paths; the labels are written first and read back, so that
    a scorer outside Spark is asked once per article.
    """
    rows = load_articles(articles, input_filter, limit)
    old = (
        scan_classifications(spark, labels_in) if labels_in
        else spark.createDataFrame([], CLASSIFICATIONS)
    )
    write_classifications(classify_articles(rows, old, scorer, retry_errors), labels_out)
    labels = table_or_empty(spark, labels_out, CLASSIFICATIONS)
    articles_with_category(articles, labels).write.mode("errorifexists").parquet(enriched_out)
    return category_counts(spark.read.parquet(enriched_out))
