"""Incremental ingest and counts. Sources are files that keep arriving; checkpoints go to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators import rollup
from ..operators.metrics import by_day
from ..operators.monitor import status_changes
from ..schemas import ARTICLES
from ..session import scratch_path
from ..sinks.articles import conform, fresh_rows, insert_batch
from ..sinks.versions import advance, latest, version_before
from ..sources.tables import init_articles, table_or_empty


def stream_ingest(rows: DataFrame, articles_path: str, checkpoint: str) -> StreamingQuery:
    """Store the new content of each micro-batch and stop when the input is used up.

    Deduplication is against the stored table, so the stream keeps no state, however long it runs. A
    replayed micro-batch finds its content stored and adds nothing. Batches take the next free id of the table, which
    builds and other streams share.
    """
    init_articles(rows.sparkSession, articles_path)

    def store(batch: DataFrame, batch_id: int) -> None:
        insert_batch(batch, articles_path)

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_dedup(rows: DataFrame, path: str, checkpoint: str, remember: int | None = None) -> StreamingQuery:
    """First row per content hash into files, a folder per micro-batch.

    Within a micro-batch winners are picked on the hash and a few short columns, by partial minima: a text that makes
    up a third of all rows leaves each task as one row. What remains is held against the hashes of earlier folders, of
    which that column alone is read. ``remember`` bounds how many micro-batches back that goes; the default is all.
    A replayed micro-batch writes its folder again.
    """
    spark, root = rows.sparkSession, path.rstrip("/")

    def store(batch: DataFrame, batch_id: int) -> None:
        stage = scratch_path(spark, "stage")
        conform(batch).write.parquet(stage)
        staged = spark.read.schema(ARTICLES).parquet(stage)
        before = table_or_empty(spark, root, StructType([*ARTICLES.fields, StructField("batch", LongType())]))
        before = before.filter(F.col("batch") < batch_id)
        if remember is not None:
            before = before.filter(F.col("batch") >= batch_id - remember)
        fresh_rows(staged, before).select(*ARTICLES.names).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


DAILY = "publish_date string, article_count long"


def stream_daily_counts(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Articles per publish day, kept up to date: each micro-batch adds its own counts to the table's last version.

    The stream keeps no state of its own; the two newest versions of the small table stay.
    """
    spark = rows.sparkSession

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = by_day(batch).groupBy("publish_date").agg(F.count("url").alias("article_count"))
        advance(spark, path, batch_id, DAILY, lambda before: before.unionByName(counts).groupBy("publish_date").agg(
            F.sum("article_count").alias("article_count")
        ))

    return (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_rollup(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The rollup of all articles that have come, kept up to date: each text is measured once, when it comes.

    Read it with ``sinks.versions.latest(spark, path, rollup.SCHEMA)``; ``operators.rollup`` has the metrics over it.
    """
    spark = rows.sparkSession

    def add(batch: DataFrame, batch_id: int) -> None:
        part = rollup.rollup(batch)
        advance(spark, path, batch_id, rollup.SCHEMA, lambda before: rollup.added(before.unionByName(part)))

    return (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_daily_counts(versions: DataFrame) -> DataFrame:
    """Newest version of the table that ``stream_daily_counts`` keeps."""
    newest = versions.agg(F.max("version").alias("version"))
    return versions.join(newest, "version").drop("version")


STATUS = "service string, status string, checks long"


def stream_status_changes(checks: DataFrame, path: str, checkpoint: str, late_by: float = 0.0) -> StreamingQuery:
    """Append the reportable checks, in the order of their time.

    Checks wait until ``late_by`` seconds of event time have passed them, so that what comes in any order within that
    span is put in order first. A check that comes later than that, with a time already passed, is judged no more and
    goes to ``late``. Between micro-batches only the last status and number of checks per service, the waiting checks and the time
    passed are kept, two versions of each, so that a replayed micro-batch starts from the version before it.
    ``pending_changes`` has what the waiting checks would report.
    """
    spark, root = checks.sparkSession, path.rstrip("/")
    waiting_schema = checks.schema

    def report(batch: DataFrame, batch_id: int) -> None:
        stage = scratch_path(spark, "checks")
        batch.write.parquet(stage)
        batch = spark.read.schema(waiting_schema).parquet(stage)
        at = F.unix_micros(F.col("ts").cast("timestamp"))
        passed = version_before(spark, f"{root}/clock", batch_id, "passed long").agg(F.max("passed")).first()[0]
        newest = batch.agg(F.max(at)).first()[0]
        now = max([t for t in (passed, None if newest is None else newest - round(late_by * 1e6)) if t is not None], default=None)
        is_late = F.lit(False) if passed is None else F.coalesce(at <= passed, F.lit(False))
        batch.filter(is_late).write.mode("overwrite").parquet(f"{root}/late/version={batch_id}")
        there = version_before(spark, f"{root}/waiting", batch_id, waiting_schema).unionByName(batch.filter(~is_late))
        # Checks without a time have no place to wait for.
        waits = F.lit(False) if now is None else F.coalesce(at > now, F.lit(False))
        due = there.filter(~waits)
        changes, state = advance_status(due, version_before(spark, f"{root}/state", batch_id, STATUS))
        changes.write.mode("overwrite").parquet(f"{root}/changes/version={batch_id}")
        advance(spark, f"{root}/state", batch_id, STATUS, lambda _: state)
        advance(spark, f"{root}/waiting", batch_id, waiting_schema, lambda _: there.filter(waits))
        advance(spark, f"{root}/clock", batch_id, "passed long", lambda _: spark.createDataFrame([(now,)], "passed long"))

    return (
        checks.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def pending_changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What the checks that still wait (of the stream's ``schema``) would report if no other came before them."""
    root = path.rstrip("/")
    return advance_status(latest(spark, f"{root}/waiting", schema), latest(spark, f"{root}/state", STATUS))[0]


def advance_status(batch: DataFrame, before: DataFrame | None, heartbeat: int = 6) -> tuple[DataFrame, DataFrame]:
    """Changes in ``batch`` given each service's last status and count; and the state after it."""
    at = F.struct("ts", "check_id")
    seen = batch.groupBy("service").agg(F.max_by("status", at).alias("status"), F.count(F.lit(1)).alias("checks"))
    # With heartbeat 1 every row is numbered and kept, then judged with what came before.
    rows = status_changes(batch, heartbeat=1)
    if before is None:
        before = seen.select("service", F.lit(None).cast("string").alias("status"), F.lit(0).cast("long").alias("checks"))
        before = before.limit(0)
    old = before.select("service", F.col("status").alias("_last"), F.col("checks").alias("_done"))
    # A check without a service is of the service NULL; its state must be found again like any other.
    rows = rows.join(old.withColumnRenamed("service", "_service"), F.col("service").eqNullSafe(F.col("_service")), "left").drop("_service").withColumn(
        "previous", F.when(F.col("check_number") == 1, F.col("_last")).otherwise(F.col("previous"))
    ).withColumn("check_number", F.col("check_number") + F.coalesce("_done", F.lit(0)))
    changed = ~F.col("status").eqNullSafe(F.col("previous"))
    rows = (
        rows.withColumn("changed", changed)
        .withColumn("recovered", changed & (F.col("status") == "UP") & (F.coalesce("previous", F.lit("")) == "DOWN"))
        .filter(changed | (F.col("check_number") % heartbeat == 0)).drop("_last", "_done")
    )
    both = F.col("service").eqNullSafe(F.col("_service"))
    state = seen.withColumn("_seen", F.lit(True)).join(old.withColumnRenamed("service", "_service"), both, "full_outer").select(
        F.when(F.col("_seen"), F.col("service")).otherwise(F.col("_service")).alias("service"),
        F.coalesce("status", "_last").alias("status"),
        (F.coalesce("checks", F.lit(0)) + F.coalesce("_done", F.lit(0))).alias("checks"),
    )
    return rows, state


__all__ = [
    "advance_status", "latest_daily_counts", "pending_changes", "stream_daily_counts", "stream_dedup", "stream_ingest",
    "stream_rollup", "stream_status_changes",
]
