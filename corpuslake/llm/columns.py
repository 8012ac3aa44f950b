"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space; everything else makes up words.
WORD = r"[^\x20\x09-\x0D]+"


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """True for rows whose crc32 of the id as text falls into the fold."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds == fold
