"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import with_running_number
from .columns import without, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 7


def offset(seed: int = SEED) -> float:
    """The one random start of the sampling, in [0, 1)."""
    return random.Random(seed).random()


def targets(
    sizes: DataFrame, source: str, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """One row per source with ``target``: its share of ``share`` times all sizes.

    Sources take the weights in turn, by code point, NULL last. No target exceeds ``most`` times its source;
    what is above goes to the others by weight. With sources sorted by size per weight the capped ones come
    first, so the final level is found from running sums instead of by rounds. ``sizes`` has one row per
    source (``source``, ``source_size``); it is summed in one task.
    """
    order = Window.orderBy(F.col(source).asc_nulls_last())
    cap = F.lit(most) * F.col("source_size")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("__n") - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("__n", F.row_number().over(order)).withColumn("__w", weight)
    by_level = Window.orderBy((cap / F.col("__w")).asc(), F.col("__n").asc())
    every = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({
        "__k": F.row_number().over(by_level),
        "__left": F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
        "__rest": F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0)),
    })
    t = t.withColumn("__level", F.col("__left") / F.col("__rest"))
    fits = F.col("__level") * F.col("__w") <= cap
    t = t.withColumn("__first", F.min(F.when(fits, F.struct("__k", "__level"))).over(every))
    free = F.coalesce(F.col("__k") >= F.col("__first.__k"), F.lit(False))
    return t.select(
        source, "source_size",
        F.when(free, F.col("__first.__level") * F.col("__w")).otherwise(cap.cast("double")).alias("target"),
    )


def bucket(size: Column, key: Column) -> Column:
    """Consecutive ranges of the sampling order: five leading bits of the size, then 256 parts by a hash of the key."""
    bits = F.length(F.bin(size)).cast("long")
    lead = F.call_function("shiftright", size, F.greatest(bits - 5, F.lit(0)).cast("int"))
    part = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 2), 16, 10).cast("long")
    return (bits * 64 + lead) * 256 + part


def mix(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``copies``: how often the mix takes the document.

    Within a source every document is expected ``target / source_size`` times. Documents are put in an order of
    size, these expectations are summed along it from one random offset, and a document is taken once for
    each whole number its stretch crosses; so the words taken stay close to the target and reruns agree.
    The order is numbered in ranges (see ``bucket``), which splits a source of any size over many tasks.
    A NULL source is a source; a source without words has target 0 and is not taken.
    Rows equal in source, size and key take each other's places.
    """
    names = ["size", "source_size", "target", "copies"]
    src = F.col(f"`{source}`")
    rows = docs.withColumns({"__size": word_count(F.col(f"`{text}`")), "__source": src, "__key": F.col(f"`{key}`")})
    rows = without(rows, names).withColumnRenamed("__size", "size")
    level = targets(rows.groupBy("__source").agg(F.sum("size").alias("source_size")), "__source", weights, share, most)
    numbered = with_running_number(
        rows, ["__source"], bucket(F.col("size"), F.col("__key")), ["size", F.col("__key").asc_nulls_last()], "__rank"
    )
    level = level.withColumnRenamed("__source", "__of")
    out = numbered.join(level, F.col("__source").eqNullSafe(F.col("__of")), "inner")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = F.lit(offset(seed))
    copies = F.floor(F.col("__rank") * each + start) - F.floor((F.col("__rank") - 1) * each + start)
    return out.withColumn("copies", copies.cast("int")).drop("__source", "__of", "__key", "__rank")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    taken = mix(docs, **options).filter("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
