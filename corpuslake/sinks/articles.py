"""Writers of the article table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import default_empty
from ..operators.dedup import anti_existing_hash, with_content_hash
from ..schemas import ARTICLE_COLUMNS, ARTICLES, STORED_ARTICLES
from ..session import scratch_path, storage
from ..sources.tables import SOURCE_BUCKETS, init_articles, scan_articles, source_bucket


@dataclass(frozen=True)
class BatchResult:
    batch_id: int
    received: int
    inserted: int

    @property
    def skipped(self) -> int:
        return self.received - self.inserted


def conform(rows: DataFrame) -> DataFrame:
    """The article columns by name, as strings, missing ones ''; the hash is computed here."""
    def field(name: str) -> Column:
        return default_empty(F.col(name).cast("string")) if name in rows.columns else F.lit("")

    fields = [field(c).alias(c) for c in ARTICLE_COLUMNS if c != "content_hash"]
    return with_content_hash(rows.select(*fields)).select(*ARTICLE_COLUMNS)


def next_batch_id(stored: DataFrame) -> int:
    """One more than the largest batch id, 0 for an empty table."""
    last = stored.agg(F.max("batch_id")).first()[0]
    return 0 if last is None else last + 1


def laid_out(rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks by the folder of their source, each task's sorted by source and day.

    The rebalance hint gathers a folder's rows into few files, and lets adaptive execution cut a folder that holds a
    large share, because one source does, into several tasks.
    """
    bucketed = rows.withColumn("source_domain", default_empty("source_domain")).withColumn("source_bucket", source_bucket(F.col("source_domain")))
    return bucketed.hint("rebalance", F.col("source_bucket")).sortWithinPartitions(
        "source_bucket", "source_domain", "publish_date", "url"
    )


def append_articles(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append to the folders of the sources: at most SOURCE_BUCKETS of them, for any number of sources."""
    tagged = rows.select(*ARTICLE_COLUMNS, F.lit(batch_id).cast("long").alias("batch_id"))
    laid_out(tagged).write.mode("append").partitionBy("source_bucket").parquet(path)


def insert_batch(rows: DataFrame, path: str, batch_id: int | None = None) -> BatchResult:
    """Append the rows whose content is new, one per content hash (earliest timestamp, then url).

    The batch is first written to shared storage: what produced it runs once, and a lost executor costs
    a read instead. Inserting the same rows again inserts nothing. Without ``batch_id`` the next free one is
    taken. One writer at a time: plain Parquet has no locks.
    """
    stage = scratch_path(rows.sparkSession, "stage")
    conform(rows).write.parquet(stage)
    return insert_staged(rows.sparkSession.read.schema(ARTICLES).parquet(stage), path, batch_id)


def _places(staged: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged rows with their places, and the places of those that are the first of their hash and not stored."""
    spark = staged.sparkSession
    staged = staged.select(
        *ARTICLE_COLUMNS, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    place = F.struct("timestamp", "url", "_file", "_row")
    first, places = scratch_path(spark, "winners"), scratch_path(spark, "places")
    winners = staged.groupBy("content_hash").agg(F.min(place).alias("w")).select("content_hash", "w._file", "w._row")
    winners.write.parquet(first)
    winners = spark.read.schema("content_hash string, _file string, _row long").parquet(first)
    anti_existing_hash(winners, stored, rows_are_cheap=True).select("_file", "_row").write.parquet(places)
    return staged, spark.read.schema("_file string, _row long").parquet(places)


def fresh_rows(staged: DataFrame, stored: DataFrame) -> DataFrame:
    """Of rows that lie in Parquet files one per content hash (earliest timestamp, then url), if ``stored`` has not got it.

    1. The winners are found on narrow columns and written as (file, row) places. ``min`` of a struct is
       a partial aggregate, so a hash with a third of all rows leaves each map task as one row.
    2. The full rows are fetched by their place in the staged files, a key without duplicates.
    """
    rows, places = _places(staged, stored)
    return rows.join(places, ["_file", "_row"], "left_semi")


def insert_staged(staged: DataFrame, path: str, batch_id: int | None = None) -> BatchResult:
    """``insert_batch`` for rows that lie in Parquet files already; ``staged`` reads them, filtered or not."""
    spark = staged.sparkSession
    init_articles(spark, path)
    if batch_id is None:
        batch_id = next_batch_id(scan_articles(spark, path))
    rows, places = _places(staged, scan_articles(spark, path))
    received, inserted = staged.count(), places.count()
    if inserted:
        append_articles(rows.join(places, ["_file", "_row"], "left_semi"), path, batch_id)
    return BatchResult(batch_id, received, inserted)


def insert_article(spark: SparkSession, path: str, batch_id: int = 0, **fields: str) -> bool:
    """Insert one article; False if its content is stored already."""
    row = spark.createDataFrame([{k: str(v) for k, v in fields.items()}])
    return insert_batch(row, path, batch_id).inserted == 1


def compact_articles(spark: SparkSession, source: str, target: str, max_rows_per_file: int = 1_000_000) -> DataFrame:
    """Rewrite the table at ``source`` with fewer files as ``target``. The rows stay the same.

    ``target`` is a new path; readers move over when it is complete.
    """
    rows = laid_out(scan_articles(spark, source))
    rows.write.option("maxRecordsPerFile", max_rows_per_file).partitionBy("source_bucket").parquet(target)
    return scan_articles(spark, target)


#: Files of a table below this size are gathered, so many of about the same size at a time.
SMALL_BYTES, FAN_IN = 128 << 20, 4
#: Names of files from which on those gathered so far change over.
MOST_NAMES = 10_000
_LEAST_TIER = 64 << 10


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, source_bucket) of a table's files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if "source_bucket" not in files.columns:
        files = files.withColumn("source_bucket", F.lit(None).cast("int"))
    return files.select("path", "length", F.col("source_bucket").cast("int"))


def small_groups(files: DataFrame, small_bytes: int = SMALL_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """(path, source_bucket, tier) of the files worth gathering: ``fan_in`` or more of one folder and one tier of sizes.

    Tiers grow by ``fan_in``, so that a row is written again once per tier and not once per build. Files of
    ``small_bytes`` or more stay as they are. A folder keeps at most ``fan_in - 1`` small files per tier.
    """
    size = F.greatest(F.col("length"), F.lit(_LEAST_TIER)) / _LEAST_TIER
    tier = F.floor(F.log(size) / F.log(F.lit(float(fan_in))) + 1e-9).alias("tier")
    small = files.filter(F.col("length") < small_bytes).select("path", "length", "source_bucket", tier)
    many = small.groupBy("source_bucket", "tier").count().filter(F.col("count") >= fan_in).drop("count")
    return small.join(F.broadcast(many) if SOURCE_BUCKETS <= 1024 else many, ["source_bucket", "tier"])


def compact_small_files(spark: SparkSession, path: str, small_bytes: int = SMALL_BYTES, fan_in: int = FAN_IN) -> int:
    """Gather the small files of the table at ``path`` in place; returns how many were gathered. The rows stay the same.

    The gathered rows are first written to a hidden folder beside the table. Then the list of the files that they
    replace is put in place, in one step, and new and old files change over. A run that dies before that list is there
    has changed nothing; after it, ``finish_compaction`` (called here and by builds) completes the change. One writer at a time;
    readers of the table's files during the change-over itself may see rows twice.
    """
    finish_compaction(spark, path)
    found = small_groups(data_files(spark, path), small_bytes, fan_in).orderBy("source_bucket", "tier")
    gathered, names = 0, []
    # The files are listed once; names come to the driver a stretch at a time.
    for _, group in groupby(found.toLocalIterator(), key=lambda r: (r["source_bucket"], r["tier"])):
        names += [r["path"] for r in group]
        if len(names) >= MOST_NAMES:
            gathered += _gather(spark, path, names)
            names = []
    return gathered + (_gather(spark, path, names) if names else 0)


def _gather(spark: SparkSession, path: str, old: list[str]) -> int:
    hidden = f"{path.rstrip('/')}/_gathered-{uuid.uuid4().hex}"
    rows = spark.read.schema(STORED_ARTICLES).parquet(*old)
    laid_out(rows).write.partitionBy("source_bucket").parquet(hidden)
    _announce(spark, hidden, old)
    finish_compaction(spark, path)
    return len(old)


def _announce(spark: SparkSession, hidden: str, old: list[str]) -> None:
    """Put the list of replaced files in place; from here on the change is to be completed."""
    files, place = storage(spark, f"{hidden}/announced")
    out = files.create(place)
    out.write("\n".join(old).encode())
    out.close()
    files.rename(place, storage(spark, f"{hidden}/replaces")[1])


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Complete or drop what a compaction left behind; does nothing after one that came to its end."""
    files, root = storage(spark, path)
    if not files.exists(root):
        return
    for folder in files.listStatus(root):
        hidden = folder.getPath()
        if not hidden.getName().startswith("_gathered-"):
            continue
        name = hidden.toString()
        replaced = storage(spark, f"{name}/replaces")[1]
        if files.exists(replaced):
            old = [r[0] for r in spark.read.text(f"{name}/replaces").collect()]
            for bucket in files.listStatus(hidden):
                if not bucket.isDirectory():
                    continue
                target = storage(spark, f"{root.toString()}/{bucket.getPath().getName()}")[1]
                files.mkdirs(target)
                for part in files.listStatus(bucket.getPath()):
                    if part.getPath().getName().endswith(".parquet"):
                        files.rename(part.getPath(), storage(spark, f"{target.toString()}/{part.getPath().getName()}")[1])
            for one in old:
                files.delete(storage(spark, one)[1], False)
        files.delete(hidden, True)


def export_dataset(articles: DataFrame, target: str, max_rows_per_file: int = 1_000_000) -> int:
    """The whole table as Parquet shards that dataset libraries load as they are.

    Returns the row count; an empty table writes nothing.
    """
    if articles.isEmpty():
        return 0
    columns = [c for c in articles.columns if c in STORED_ARTICLES.names]
    articles.select(*columns).write.option("maxRecordsPerFile", max_rows_per_file).parquet(target)
    return articles.sparkSession.read.parquet(target).count()
