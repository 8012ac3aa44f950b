"""Append-only ledgers: progress, errors, labels. Readers take distinct keys, so a retry does no harm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CLASSIFICATIONS, LEDGER_FILES, LEDGER_PAIRS, QUARANTINE, SELECTION


# Work is done for one selection of dates and keywords; a ledger without that column is about everything.
def _with_selection(rows: DataFrame) -> DataFrame:
    return rows if "selection" in rows.columns else rows.withColumn("selection", F.lit(""))


def _append(rows: DataFrame, path: str, columns: list[str], stamp: str | None = None) -> None:
    if stamp and stamp not in rows.columns:
        rows = rows.withColumn(stamp, F.current_timestamp())
    rows.select(*columns).write.mode("append").parquet(path)


def mark_pairs(pairs: DataFrame, path: str) -> None:
    """pairs: crawl_id, domain_pattern, articles_inserted."""
    _append(_with_selection(pairs), path, [*LEDGER_PAIRS.names, SELECTION.name], "completed_at")


def mark_files(files: DataFrame, path: str) -> None:
    """files: crawl_id, domain_pattern, filename."""
    _append(_with_selection(files), path, [*LEDGER_FILES.names, SELECTION.name], "completed_at")


def quarantine(errors: DataFrame, path: str) -> None:
    """errors: error_type, message, context."""
    _append(errors, path, QUARANTINE.names, "at")


def write_classifications(labels: DataFrame, target: str) -> None:
    """All labels as a new table. ``target`` is not the path they were read from."""
    labels.select(*CLASSIFICATIONS.names).write.mode("errorifexists").parquet(target)
