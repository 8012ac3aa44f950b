"""From documents to a sharded training mix: five stages, each a Spark job over what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.llm import decontam, langid, mix, shards, simhash
from corpuslake.llm.components import staged

#: Documents whose language is less certain than this go.
LEAST_SCORE = 0.5
SHARDS = 24


#: Columns that stages read; all others are carried along under names of their own, whatever they are called.
READ = ("doc_id", "text", "lang", "source")


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns no stage reads renamed, so that none of them meets a name that an operator gives out."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in READ else f"__column_{i}") for i, c in enumerate(docs.columns)])


def _back(rows: DataFrame, docs: DataFrame, names: dict[str, str] | None = None) -> list[Column]:
    names = names or {}
    return [rows[c if c in READ else f"__column_{i}"].alias(names.get(c.lower(), c)) for i, c in enumerate(docs.columns)]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language: those that are NULL, empty or without a letter, or with no clear answer, go.

    Equal texts get the same answer. Of an empty table nothing is left; columns of any name come out as they went in.
    """
    found = langid.identify(_aside(docs))
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    found = found.filter(sure)
    return found.select(*_back(found, docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id.

    Groups are those of the SimHash operator under its contract: three-word shingles, two bits at most. NULL, empty and blank
    texts are one group. Of several rows with the smallest id one stays. Columns of any name come out as they went in.
    """
    found = simhash.first_of_groups(_aside(docs), shingle=simhash.SHINGLE)
    return found.select(*_back(found, docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item. NULL and empty texts hold none and stay; without items all stay.

    Copies are judged alike. Columns of any name come out as they went in.
    """
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontam.find_leaks(_aside(docs), items).filter(F.size("leaks") == 0)
    return found.select(*_back(found, docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document comes as often as it is taken.

    NULL is a source like any other; texts without words have no size and are taken as their source's share says.
    Columns of any name come out as they went in.
    """
    found = mix.mixed(_aside(docs))
    return found.select(*_back(found, docs))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ``shard`` and its ``slot`` there; rows with equal ids, or without one, share a shard.

    Columns named so in the input, from an earlier placement, come out as ``input_shard`` and ``input_slot``.
    """
    placed = shards.shard(_aside(docs), [1.0] * SHARDS)
    earlier = {"shard": "input_shard", "slot": "input_slot"}
    return placed.select(*_back(placed, docs, earlier), "shard", "slot")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("sharding", sharding),
]

#: The language model and the fingerprints are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
