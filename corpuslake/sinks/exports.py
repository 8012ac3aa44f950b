"""Metric exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.metrics import articles_per_source_day, metric_frames, salience_sections
from ..session import scratch_path


def export_metrics(articles: DataFrame, out_dir: str, fmt: str = "csv") -> int:
    """Counts per day, per source, and per source and day, one folder each, as CSV or JSON lines.

    Returns the number of rows written. The articles are read once: all three come from the staged counts by source and day.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"unknown format: {fmt}")
    spark, path = articles.sparkSession, scratch_path(articles.sparkSession, "counts")
    articles_per_source_day(articles).write.parquet(path)
    counts = spark.read.parquet(path)
    total = 0
    for name, frame in metric_frames(counts).items():
        options = {"header": True} if fmt == "csv" else {"ignoreNullFields": False}
        written = Observation(name)
        frame.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt).options(**options).save(f"{out_dir.rstrip('/')}/{name}")
        total += written.get["n"]
    return total


def export_salience_sections(articles: DataFrame, target: str) -> None:
    """Source, language and temporal salience as CSV, one sub-folder per section."""
    salience_sections(articles).write.mode("overwrite").option("header", True).partitionBy("section").csv(target)
