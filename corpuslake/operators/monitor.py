"""Status changes of polled services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def status_changes(
    checks: DataFrame,
    service: str = "service",
    order: tuple[str, ...] = ("ts", "check_id"),
    bucket: Column | None = None,
    heartbeat: int = 6,
) -> DataFrame:
    """Checks to report: a status other than the one before (``changed``; ``recovered`` for
    DOWN -> UP), or every ``heartbeat``-th check of a service when nothing changed.

    ``bucket`` (default: the hour) cuts a service's history into ranges. Only range summaries are
    read across ranges, so one busy service spreads over as many tasks as it has ranges.
    """
    rows = checks.withColumn("_b", F.date_trunc("hour", order[0]) if bucket is None else bucket)
    at = F.struct(*order)
    ranges = rows.groupBy(service, "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.max_by("status", at).alias("_end")
    )
    earlier = Window.partitionBy(service).orderBy("_b")
    ranges = ranges.select(
        F.col(service).alias("_s"),
        F.col("_b").alias("_sb"),
        F.lag("_end").over(earlier).alias("_before"),
        F.coalesce(F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(service, "_b").orderBy(*order)
    numbered = (
        rows.join(ranges, F.col(service).eqNullSafe(F.col("_s")) & F.col("_b").eqNullSafe(F.col("_sb")))
        .withColumn("_local", F.row_number().over(inside))
        .withColumn("previous", F.when(F.col("_local") == 1, F.col("_before")).otherwise(F.lag("status").over(inside)))
        .withColumn("check_number", F.col("_start") + F.col("_local"))
    )
    changed = ~F.col("status").eqNullSafe(F.col("previous"))
    return (
        numbered.withColumn("changed", changed)
        .withColumn("recovered", changed & (F.col("status") == "UP") & (F.coalesce("previous", F.lit("")) == "DOWN"))
        .filter(changed | (F.col("check_number") % heartbeat == 0))
        .drop("_b", "_s", "_sb", "_before", "_start", "_local")
    )
