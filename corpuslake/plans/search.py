"""Search with a table of the letter triples of each file: files that cannot hold a hit are not read."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.articles import search_by_keyword
from ..schemas import BUCKETED_ARTICLES, STORED_ARTICLES
from ..sinks.articles import data_files
from ..sources.tables import scan_articles, table_or_empty

#: Slots that triples of bytes fall into: a file has a bit for each, 8 KB in all, however many texts it holds.
SLOT_BITS = 16
INDEX = "path string, word int, bits long"
_PIECE = 1 << 20


def triple_slots(text: bytes) -> np.ndarray:
    """The slots of the triples of bytes in a text."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    triple = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    return (triple * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, word, bits) of the files whose rows pass."""
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        for path, title, content in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            marks = seen.setdefault(path, np.zeros(1 << SLOT_BITS, bool))
            for text in (title, content):
                raw = (text or "").encode("utf-8", "replace")
                for at in range(0, len(raw), _PIECE):
                    marks[triple_slots(raw[at : at + _PIECE + 2])] = True
    for path, marks in seen.items():
        words = np.packbits(marks, bitorder="little").view("<i8")
        at = np.nonzero(words)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([path] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(words[at], pa.int64())], names=["path", "word", "bits"]
        )


def current_files(spark: SparkSession, articles_path: str) -> DataFrame:
    return data_files(spark, articles_path).select("path")


def extend_search_index(spark: SparkSession, articles_path: str, index_path: str) -> None:
    """Add the files of the article table that the index has not got; what it has is not read again.

    A file that a dead run left half indexed is not in the index: its rows come with one append.
    """
    known = table_or_empty(spark, index_path, INDEX).select("path").distinct()
    new = [r.path for r in current_files(spark, articles_path).join(known, "path", "left_anti").collect()]
    if not new:
        return
    rows = spark.read.schema(STORED_ARTICLES).parquet(*new).select(F.col("_metadata.file_path").alias("path"), "title", "content")
    marked = rows.mapInArrow(_marked, INDEX).groupBy("path", "word").agg(F.bit_or("bits").alias("bits"))
    marked.repartition("path").sortWithinPartitions("word").write.mode("append").parquet(index_path)


def _literals(parsed) -> list[list[bytes]] | None:
    """Alternatives, each a list of strings that every match of it has; None if some alternative has none."""
    runs, run, branches = [], [], []
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            run.append(chr(value))
            continue
        runs.append("".join(run))
        run = []
        if name == "SUBPATTERN" and not value[1] and not value[2]:
            branches.append(_literals(value[3]))
        elif name == "MAX_REPEAT" and value[0] >= 1:
            branches.append(_literals(value[2]))
        elif name == "BRANCH":
            found = [_literals(x) for x in value[1]]
            branches.append(None if any(f is None for f in found) else [a for f in found for a in f])
    runs.append("".join(run))
    own = [r.encode() for r in runs if len(r.encode()) >= 3]
    if own:
        return [own]
    return next((b for b in branches if b is not None), None)


def required(pattern: str) -> list[list[bytes]] | None:
    """Strings that a match must hold, by alternative; None if the pattern does not tell.

    Patterns with flags, or with what only Java's expressions have, do not tell.
    """
    if re.search(r"\(\?[a-zA-Z-]|\\[QEpPGXRhHvVzKk]|&&|[+*?}]\+", pattern):
        return None
    try:
        return _literals(re._parser.parse(pattern))
    except (re.error, RecursionError, OverflowError):
        return None


def candidate_files(spark: SparkSession, articles_path: str, index_path: str, pattern: str) -> list[str] | None:
    """The files that may hold a match: those with all triples of some alternative, and those not indexed. None for all files."""
    wanted = required(pattern)
    if wanted is None:
        return None
    index = table_or_empty(spark, index_path, INDEX)
    files = current_files(spark, articles_path)
    maybe = files.join(index.select("path").distinct(), "path", "left_anti")
    for strings in wanted:
        masks: dict[int, int] = {}
        for s in strings:
            for slot in triple_slots(s).tolist():
                masks[slot >> 6] = masks.get(slot >> 6, 0) | 1 << (slot & 63)
        signed = {w: m - (1 << 64) if m >> 63 else m for w, m in masks.items()}
        held = F.lit(False)
        for w, m in signed.items():
            held = held | ((F.col("word") == w) & (F.col("bits").bitwiseAND(F.lit(m)) == F.lit(m)))
        hits = index.filter(F.col("word").isin(list(signed)) & held).groupBy("path").agg(F.count_distinct("word").alias("n"))
        maybe = maybe.unionByName(hits.filter(F.col("n") == len(signed)).select("path").join(files, "path", "left_semi"))
    return [r.path for r in maybe.distinct().collect()]


def search_indexed(
    spark: SparkSession, articles_path: str, index_path: str, keyword: str, limit: int | None = None, order_by: str = "",
    columns: Sequence[str] = tuple(STORED_ARTICLES.names),
) -> DataFrame:
    """The rows of ``search_by_keyword`` over the stored articles, from the files that may hold them.

    Each letter triple of a string that the pattern requires must be in the file. Files that the index lacks are
    read, and all are where the pattern requires no string of three bytes.
    """
    paths = candidate_files(spark, articles_path, index_path, keyword)
    if paths is None:
        rows = scan_articles(spark, articles_path)
    elif paths:
        rows = spark.read.schema(BUCKETED_ARTICLES).option("basePath", articles_path).parquet(*paths)
    else:
        rows = spark.createDataFrame([], STORED_ARTICLES)
    return search_by_keyword(rows, keyword, limit, order_by).select(*columns)
