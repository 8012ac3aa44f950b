"""Reports over the quarantine table (error_type, message, context, at)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def errors_by_type(errors: DataFrame, error_type: str) -> DataFrame:
    return errors.filter(F.col("error_type") == error_type)


def error_total(errors: DataFrame) -> DataFrame:
    return errors.agg(F.count(F.lit(1)).alias("count"))


def error_counts(errors: DataFrame) -> DataFrame:
    return (
        errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "error_type")
    )


def error_samples(errors: DataFrame, types: int | None = None, order: Sequence[str] = ("at",)) -> DataFrame:
    """The first error of each type, of all types or of the ``types`` that appeared first.

    Errors written together share their time, so ties go by message, then by the url or file they name.
    ``min_by`` is a partial aggregate: a type with a third of all errors sends one row per map task.
    """
    ties = ["message"] if "message" in errors.columns else []
    if "context" in errors.columns:
        ties += [F.element_at("context", F.lit(k)).alias(k) for k in ("url", "filename")]
    key = F.struct(*order, *ties)
    rest = [c for c in errors.columns if c != "error_type"]
    first = errors.groupBy("error_type").agg(F.min_by(F.struct(*rest), key).alias("first"))
    rows = first.select("error_type", "first.*").orderBy(*order, "error_type")
    return rows if types is None else rows.limit(types)
