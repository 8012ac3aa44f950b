"""Content deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import content_hash
from .ranking import first_per_key

DEDUP_ORDER = ["timestamp", "url"]


def with_content_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("content_hash", content_hash("content"))


def dedup_first(rows: DataFrame) -> DataFrame:
    """One row per content hash: earliest timestamp, then smallest url. Project to the columns you
    need first, so that the shuffle stays narrow."""
    return first_per_key(rows, ["content_hash"], DEDUP_ORDER)


def anti_existing_hash(rows: DataFrame, stored: DataFrame, rows_are_cheap: bool = False) -> DataFrame:
    """Rows whose content is not stored yet.

    With ``rows_are_cheap`` (a batch that lies in a table) the stored hashes are first reduced to those
    the batch holds. Then a small batch is what gets broadcast, if its size allows, and the big
    table's hash column is read but not shuffled. Without it ``rows`` is evaluated only once.
    """
    known = stored.select("content_hash")
    if rows_are_cheap:
        known = known.join(rows.select("content_hash"), "content_hash", "left_semi")
    return rows.join(known, "content_hash", "left_anti")
