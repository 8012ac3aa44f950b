"""First / top-n per key, running numbers and trailing means that do not put a hot key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 512


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key.

    ``row_number() = 1`` is planned as a window group limit: every map task forwards one row per key,
    so the shuffle carries at most (map tasks) rows of a hot key instead of all its copies.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def top_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    salt: Sequence[str] = (),
    buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """First ``n`` rows of each key, exactly.

    For ``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000) every map task forwards only
    its own first ``n`` rows. With ``salt`` columns the key is first cut into ``buckets`` parts that keep
    ``n`` rows each, so that no task sees a whole key for larger ``n`` either.
    """
    if n < 1:
        return df.limit(0)

    def keep(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")

    if salt:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt), F.lit(buckets)))
        df = keep(salted, [*keys, "_salt"]).drop("_salt")
    return keep(df, keys)


def with_running_number(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    name: str = "n",
) -> DataFrame:
    """Row number within ``keys``, counted block by block.

    ``bucket`` cuts the order into consecutive ranges (a month, an hour) and must not contradict
    ``order``. Only the small table of range sizes is summed across ranges; rows are numbered
    inside (keys, range) partitions.
    """
    df = df.withColumn("_bucket", bucket)
    by = [*keys, "_bucket"]
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    starts = starts.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_start")
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    local = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return (
        df.join(starts, same, "inner")
        .withColumn(name, F.col("_start") + local)
        .drop("_start", "_bucket", *[f"_k_{c}" for c in by])
    )


def rolling_mean(
    df: DataFrame,
    order: str,
    value: str,
    window: int = 7,
    keys: Sequence[str] = (),
    name: str = "rolling_mean",
    bucket: Column | None = None,
    block: int = 4096,
) -> DataFrame:
    """Mean of the last ``window`` rows in ``order``; NULL until that many rows exist.

    The series is numbered, cut into blocks of ``block`` rows and each block gets a copy of the
    ``window - 1`` rows before it, so that the frame never leaves a block.
    """
    block = max(block, window)
    bucket = F.left(F.coalesce(F.col(order).cast("string"), F.lit("")), F.lit(7)) if bucket is None else bucket
    numbered = with_running_number(df, keys, bucket, [F.col(order).asc_nulls_first()], "_n")
    home = F.floor((F.col("_n") - 1) / F.lit(block)).cast("long")
    tail = F.pmod(F.col("_n") - 1, F.lit(block)) >= block - (window - 1)
    spread = numbered.withColumn("_home", home).withColumn(
        "_block",
        F.explode(F.when(tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
    )
    frame = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-(window - 1), 0)
    full = F.count(F.lit(1)).over(frame) == window
    return (
        spread.withColumn(name, F.when(full, F.avg(value).over(frame)))
        .filter(F.col("_block") == F.col("_home"))
        .drop("_n", "_home", "_block")
    )
