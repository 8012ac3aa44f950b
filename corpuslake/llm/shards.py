"""Sharding: weighted rendezvous hashing of a stable record key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import with_running_number
from .columns import without

#: Parts in which a shard's rows are counted and numbered, so that a shard never meets in one task.
PARTS = 4096


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose draw for this key is least: ``-ln(u) / weight`` with ``u`` hashed from (key, shard).

    A shard wins in proportion to its weight. Its draw depends on nothing but the key and its own number,
    so a further shard only takes keys, and a removed one only gives its own away.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    draws = []
    for i, weight in enumerate(weights):
        unit = (F.xxhash64(key, F.lit(i)).bitwiseAND(F.lit((1 << 53) - 1)) + F.lit(0.5)) / F.lit(float(1 << 53))
        draws.append(F.struct((-F.ln(unit) / F.lit(float(weight))).alias("d"), F.lit(i).alias("i")))
    return draws[0]["i"] if len(draws) == 1 else F.least(*draws)["i"]


def shard(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    next_weight: float | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text, 8 more for the row), ``shard``, ``slot`` and, if
    ``next_weight`` is given, ``grown_shard``: the place of the row with one more shard.

    Slots number a shard's rows without gaps. Rows of a shard are counted in ``parts`` parts by a hash of key
    and text, numbered inside a part, and shifted by the sizes of the parts before it: the only thing that
    crosses parts is a table of shards times parts. Rows with the same key share a shard; rows that are equal
    in key and text are numbered in any order. A NULL key is a key like any other.
    """
    names = ["size", "shard", "slot", "grown_shard"]
    rows = docs.withColumn("__id", F.col(f"`{key}`").cast("string"))
    text_col, id_col = F.col(f"`{text}`"), F.col("__id")
    rows = rows.withColumns({
        "__size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 8,
        "__shard": rendezvous(id_col, weights),
        "__grown": (rendezvous(id_col, [*weights, next_weight]) if next_weight else F.lit(None)).cast("int"),
        "__h": F.xxhash64(id_col, text_col),
    })
    rows = without(rows, names).withColumnsRenamed({"__size": "size", "__shard": "shard", "__grown": "grown_shard"})
    bucket = F.pmod(F.col("__h"), F.lit(parts))
    numbered = with_running_number(rows, ["shard"], bucket, [F.col("__id"), F.col("__h")], "slot")
    return numbered.withColumn("slot", (F.col("slot") - 1).cast("long")).drop("__id", "__h")
