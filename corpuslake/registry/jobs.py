"""Queries that write a table, to shared scratch storage, and read it back."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ARTICLES, CDX
from ..session import scratch_path
from ..sinks.articles import (
    FAN_IN,
    append_articles,
    compact_articles,
    compact_small_files,
    data_files,
    export_dataset,
    insert_batch,
)
from ..sinks.exports import export_metrics, export_salience_sections
from ..sinks.ledgers import mark_files, mark_pairs, quarantine, write_classifications
from ..sources.cdx import scan_cdx
from ..sources.tables import (
    init_articles,
    scan_articles,
    scan_classifications,
    scan_ledger_files,
    scan_ledger_pairs,
    scan_quarantine,
)
from ..plans.labelling import run_labelling
from ..plans.search import extend_search_index, search_indexed
from ..operators import rollup
from ..operators.classify import keyword_scorer
from ..sinks.versions import latest
from ..plans.ingest import Store, run_build
from ..streaming import jobs
from . import Query, Views
from .extraction import _EXTRACTED, _TITLES
from .views import CRAWLS, PATTERNS
from .labelling import _MERGED, _SCORED, TERMS
from .metrics import _changes_sql

_A = "url, title, content, content_hash, source_domain, crawl_id, timestamp, language, status_code, publish_date"
_COLS = [c.strip() for c in _A.split(",")]


def _new(v: Views, name: str) -> str:
    return scratch_path(v.spark, name)


def _init(v: Views) -> DataFrame:
    return init_articles(v.spark, _new(v, "init")).unionByName(
        v.hashed.withColumn("batch_id", F.lit(0).cast("long")).drop("doc_id")
    ).select("url", "content_hash")


def _append(v: Views) -> DataFrame:
    path = _new(v, "append")
    append_articles(v.hashed, path, 3)
    return scan_articles(v.spark, path)


def _scan(v: Views) -> DataFrame:
    return _append(v).select(*_COLS)


def _insert(v: Views) -> DataFrame:
    path = _new(v, "insert")
    insert_batch(v.articles, path, 0)
    return scan_articles(v.spark, path).select(*_COLS)


def _insert_in_batches(v: Views) -> DataFrame:
    """Three batches, one per crawl; the last is sent twice and adds nothing the second time."""
    path = _new(v, "batches")
    results = [insert_batch(v.stored.filter(F.col("batch_id") == i), path, i) for i in range(3)]
    again = insert_batch(v.stored.filter(F.col("batch_id") == 2), path, 3)
    counts = v.spark.createDataFrame(
        [(r.batch_id, r.received, r.inserted, r.skipped) for r in [*results, again]],
        "batch_id long, received long, counted long, skipped long",
    )
    written = scan_articles(v.spark, path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("inserted"))
    return counts.join(written, "batch_id", "left").na.fill(0, ["inserted"])


def _compact(v: Views) -> DataFrame:
    path = _new(v, "loose")
    for batch, rows in enumerate(["language = 'en'", "language <> 'en'"]):
        append_articles(v.hashed.filter(rows), path, batch)
    return compact_articles(v.spark, path, _new(v, "compact")).select(*_COLS, "batch_id")


def _of_source(v: Views) -> DataFrame:
    path = _new(v, "sources")
    append_articles(v.hashed, path, 0)
    return scan_articles(v.spark, path, ["src1", "src3", "none"]).select(*_COLS)


def _compact_small(v: Views) -> DataFrame:
    """Eight batches, small files gathered after every third one."""
    path = _new(v, "growing")
    for i in range(8):
        append_articles(v.hashed.filter(F.col("doc_id") % 8 == i), path, i)
        if i % 3 == 2:
            compact_small_files(v.spark, path)
    files = data_files(v.spark, path).groupBy("source_bucket").count().agg(F.max("count").alias("most"))
    kept = F.col("most") <= 3 * FAN_IN  # of eight files a folder and batch alike
    return scan_articles(v.spark, path).join(files).select(*_COLS, "batch_id", kept.alias("few_files"))


def _search(v: Views) -> DataFrame:
    """Articles by day in files of their own, half of them indexed before the rest come."""
    path, index = _new(v, "searched"), _new(v, "triples")
    for batch, rows in enumerate(["doc_id % 2 = 0", "doc_id % 2 = 1"]):
        append_articles(v.hashed.filter(rows), path, batch)
        extend_search_index(v.spark, path, index)
    append_articles(v.hashed.filter("false"), path, 2)
    return search_indexed(v.spark, path, index, r"[Rr]eleased under|Thoring|xyz\d{40}zyx", columns=_COLS)


def _export(v: Views) -> DataFrame:
    out = _new(v, "metrics")
    export_metrics(v.articles, out, "csv")

    def read(name: str, schema: str) -> DataFrame:
        return v.spark.read.option("header", True).schema(schema).csv(f"{out}/{name}").withColumn("metric", F.lit(name))

    return (
        read("articles_per_day", "publish_date string, article_count long")
        .unionByName(read("articles_per_source", "source_domain string, article_count long"), True)
        .unionByName(
            read("articles_per_source_per_day", "source_domain string, publish_date string, article_count long"), True
        )
    ).select(
        "metric", "source_domain", F.coalesce("publish_date", F.lit("")).alias("publish_date"), "article_count"
    )


def _export_json(v: Views) -> DataFrame:
    out = _new(v, "metrics")
    export_metrics(v.articles, out, "json")
    return v.spark.read.schema("source_domain string, publish_date string, article_count long").json(
        f"{out}/articles_per_source_per_day"
    )


def _sections(v: Views) -> DataFrame:
    out = _new(v, "sections")
    export_salience_sections(v.articles, out)
    schema = (
        "source_domain string, article_count long, avg_content_length double, language string, "
        "publish_date string, total_content_length long, section string"
    )
    rows = v.spark.read.option("header", True).schema(schema).csv(out)
    return rows.groupBy("section").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("article_count").alias("articles"),
        F.sum("total_content_length").alias("chars"),
    )


def _dataset(v: Views) -> DataFrame:
    out = _new(v, "dataset")
    export_dataset(v.hashed, out, 300)
    return v.spark.read.schema(ARTICLES).parquet(out)


def _labels(v: Views) -> DataFrame:
    out = _new(v, "labels")
    write_classifications(v.labels.unionByName(v.labels), out)
    return scan_classifications(v.spark, out)


def _mixed_labels(v: Views) -> DataFrame:
    """Every url also with a failed call, every other one with an answer that was none."""
    out = _new(v, "labels")
    failed = v.articles.select("url", F.lit("error").alias("category"))
    none = v.articles.filter("doc_id % 2 = 0").select("url", F.lit("unknown").alias("category"))
    write_classifications(v.labels.unionByName(failed).unionByName(none), out)
    return scan_classifications(v.spark, out)


def _run_labelling(v: Views) -> DataFrame:
    old = _new(v, "labels")
    write_classifications(v.labels.filter(F.col("category").isNotNull()), old)
    return run_labelling(
        v.spark, v.articles, old, _new(v, "labels"), _new(v, "enriched"), keyword_scorer(TERMS)
    )


def _cdx(v: Views) -> DataFrame:
    out = _new(v, "index")
    lines = v.cdx.select(*CDX.names)
    lines.withColumns({c: F.col(c).cast("string") for c in ("offset", "length")}).write.json(out)
    return scan_cdx(v.spark, out)


def _cdx_unnamed(v: Views) -> DataFrame:
    """Lines as an index answers them: the crawl is named by the archive only."""
    out = _new(v, "index")
    lines = v.cdx.select("url", F.concat("crawl_id", F.lit("/"), "filename").alias("filename"), "timestamp", "offset", "length")
    lines.withColumns({c: F.col(c).cast("string") for c in ("offset", "length")}).write.json(out)
    return scan_cdx(v.spark, out)


def _progress(v: Views) -> DataFrame:
    """Marking everything twice changes nothing for readers of distinct keys."""
    pairs, files = _new(v, "pairs"), _new(v, "files")
    for _ in range(2):
        mark_pairs(v.ledger_pairs, pairs)
        mark_files(v.ledger_files, files)
    done = scan_ledger_pairs(v.spark, pairs).select("crawl_id", "domain_pattern", "articles_inserted").distinct()
    n = scan_ledger_files(v.spark, files).select("crawl_id", "domain_pattern", "filename").distinct()
    return done.join(
        n.groupBy("crawl_id", "domain_pattern").agg(F.count(F.lit(1)).alias("files")), ["crawl_id", "domain_pattern"]
    )


def _quarantine(v: Views) -> DataFrame:
    path = _new(v, "quarantine")
    quarantine(v.errors.select(
        "error_type", "message", F.create_map(F.lit("event"), F.col("event_id").cast("string")).alias("context"), "at"
    ), path)
    return scan_quarantine(v.spark, path).select("error_type", "message", F.col("context")["event"].alias("event"))


def _build(v: Views) -> DataFrame:
    """Archives written from the pages, then a whole build over them, run twice: the second finds nothing to do."""
    base = _new(v, "archives")
    index = v.written_archives(base)
    store = Store(_new(v, "store"))
    for batch in range(2):
        run_build(
            v.spark, index, base, store, batch, PATTERNS, CRAWLS, ["/en/", "/de/"], "2020-04-02", "2020-04-27",
            languages=["en", "de"],
        )
    return scan_articles(v.spark, store.articles).select(
        "url", "title", "content", "source_domain", "crawl_id", "timestamp", "language", "status_code", "publish_date",
        "batch_id",
    )


def _documents(v: Views) -> Iterator[DataFrame]:
    """Documents in three parts, by the month of their capture, so that earlier captures come first."""
    month = F.col("doc_id") % 4
    return v.arriving("documents", [month == 0, month == 1, month >= 2])


def _events(v: Views) -> Iterator[DataFrame]:
    """Events in three parts, one after the other in time."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = v.table("events").agg(F.min(at), F.max(at)).first()
    third = F.least(F.floor((at - first) * 3 / max(1, last - first)), F.lit(2))
    return v.arriving("events", [third == i for i in range(3)])


def _stream_ingest(v: Views) -> DataFrame:
    path, checkpoint = _new(v, "articles"), _new(v, "checkpoint")
    for arriving in _documents(v):
        jobs.stream_ingest(v.as_articles(arriving), path, checkpoint).awaitTermination()
    jobs.stream_ingest(v.as_articles(arriving), path, checkpoint).awaitTermination()  # finds its input done
    return scan_articles(v.spark, path).select(*_COLS)


def _stream_dedup(v: Views) -> DataFrame:
    path, checkpoint = _new(v, "unique"), _new(v, "checkpoint")
    for arriving in _documents(v):
        jobs.stream_dedup(v.as_articles(arriving), path, checkpoint).awaitTermination()
    return v.spark.read.schema(ARTICLES).parquet(path).select("content_hash")


def _stream_daily(v: Views) -> DataFrame:
    path, checkpoint = _new(v, "daily"), _new(v, "checkpoint")
    for arriving in _documents(v):
        jobs.stream_daily_counts(v.as_articles(arriving), path, checkpoint).awaitTermination()
    versions = v.spark.read.schema("publish_date string, article_count long, version int").parquet(path)
    return jobs.latest_daily_counts(versions)


def _rollup(v: Views) -> DataFrame:
    """The rollup that a stream of the documents leaves behind."""
    path, checkpoint = _new(v, "rollup"), _new(v, "checkpoint")
    for arriving in _documents(v):
        jobs.stream_rollup(v.as_articles(arriving), path, checkpoint).awaitTermination()
    return latest(v.spark, path, rollup.SCHEMA)


def _late_checks(v: Views) -> DataFrame:
    """Checks that arrive in any order within a day, in three parts."""
    path, checkpoint, late_by = _new(v, "status"), _new(v, "checkpoint"), 86_400
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = v.table("events").agg(F.min(at), F.max(at)).first()
    delayed = at + F.pmod(F.xxhash64("event_id"), F.lit(late_by)) * 1_000_000
    third = F.least(F.floor((delayed - first) * 3 / max(1, last - first)), F.lit(2))
    for arriving in v.arriving("events", [third == i for i in range(3)]):
        checks = arriving.select(
            F.lit("index").alias("service"), "ts", F.col("event_id").alias("check_id"),
            F.when(F.col("event_type") == "error", "DOWN").otherwise("UP").alias("status"),
        )
        jobs.stream_status_changes(checks, path, checkpoint, late_by).awaitTermination()
    waiting = jobs.pending_changes(v.spark, path, checks.schema)
    return v.spark.read.parquet(f"{path}/changes").drop("version").unionByName(waiting).drop("ts")


def _stream_status(v: Views) -> DataFrame:
    path, checkpoint = _new(v, "status"), _new(v, "checkpoint")
    for arriving in _events(v):
        checks = arriving.select(
            F.lit("index").alias("service"), "ts", F.col("event_id").alias("check_id"),
            F.when(F.col("event_type") == "error", "DOWN").otherwise("UP").alias("status"),
        )
        jobs.stream_status_changes(checks, path, checkpoint).awaitTermination()
    return v.spark.read.parquet(f"{path}/changes").drop("version", "ts")


QUERIES = {
    "scan_articles": Query(_scan, f"SELECT {_A} FROM hashed"),
    "init_articles": Query(_init, "SELECT url, content_hash FROM hashed"),
    "append_articles": Query(
        lambda v: _append(v).select("url", "source_domain", "batch_id"),
        "SELECT url, source_domain, cast(3 AS bigint) AS batch_id FROM articles",
    ),
    "insert_batch": Query(_insert, f"SELECT {_A} FROM ranked WHERE rn = 1"),
    "insert_batches": Query(
        _insert_in_batches,
        r"""WITH s AS (SELECT batch_id, md5(trim(regexp_replace(lower(content), '\s+', ' ', 'g'))) AS h FROM stored),
            f AS (SELECT h, min(batch_id) AS batch_id FROM s GROUP BY h),
            n AS (SELECT batch_id, count(*) AS inserted FROM f GROUP BY batch_id),
            r AS (SELECT batch_id, count(*) AS received FROM s GROUP BY batch_id)
            SELECT batch_id, received, inserted AS counted, received - inserted AS skipped, inserted
            FROM r JOIN n USING (batch_id)
            UNION ALL SELECT 3, received, 0, received, 0 FROM r WHERE batch_id = 2""",
    ),
    "compact_articles": Query(
        _compact,
        f"""SELECT {_A}, CASE language WHEN 'en' THEN 0 ELSE 1 END::bigint AS batch_id
            FROM hashed""",
    ),
    "search_indexed": Query(
        _search,
        rf"""SELECT {_A} FROM hashed WHERE regexp_matches(title, '[Rr]eleased under|Thoring|xyz\d{{40}}zyx')
              OR regexp_matches(content, '[Rr]eleased under|Thoring|xyz\d{{40}}zyx')""",
    ),
    "scan_articles_of_source": Query(_of_source, f"SELECT {_A} FROM hashed WHERE source_domain IN ('src1', 'src3')"),
    "compact_small_files": Query(_compact_small, f"SELECT {_A}, doc_id % 8 AS batch_id, true AS few_files FROM hashed"),
    "export_metrics": Query(
        _export,
        """SELECT 'articles_per_day' AS metric, NULL AS source_domain, publish_date, count(*) AS article_count
           FROM articles GROUP BY publish_date
           UNION ALL SELECT 'articles_per_source', source_domain, '', count(*) FROM articles GROUP BY source_domain
           UNION ALL SELECT 'articles_per_source_per_day', source_domain, publish_date, count(*)
           FROM articles GROUP BY source_domain, publish_date""",
    ),
    "export_metrics_json": Query(
        _export_json,
        "SELECT source_domain, publish_date, count(*) AS article_count FROM articles GROUP BY ALL",
    ),
    "export_salience_sections": Query(
        _sections,
        """SELECT 'source' AS section, count(DISTINCT source_domain) AS n_rows, count(*) AS articles,
                  cast(NULL AS bigint) AS chars FROM articles
           UNION ALL SELECT 'language', count(DISTINCT language), count(*), NULL FROM articles
           UNION ALL SELECT 'temporal', count(DISTINCT publish_date), count(*), cast(sum(length(content)) AS bigint) FROM articles""",
    ),
    "export_dataset": Query(_dataset, f"SELECT {_A} FROM hashed"),
    "scan_classifications": Query(_labels, "SELECT url, max(category) AS category FROM old_labels GROUP BY url"),
    "scan_classifications_mixed": Query(
        _mixed_labels,
        """SELECT url, coalesce(max(CASE WHEN category NOT IN ('error', 'unknown') THEN category END),
                                max(CASE WHEN doc_id % 2 = 0 THEN 'unknown' ELSE 'error' END)) AS category
           FROM articles LEFT JOIN old_labels USING (url) GROUP BY url""",
    ),
    "write_classifications": Query(
        _run_labelling,
        f"WITH {_SCORED}, {_MERGED} SELECT category, count(url) AS count FROM articles LEFT JOIN merged USING (url) GROUP BY category",
    ),
    "scan_cdx": Query(_cdx, 'SELECT crawl_id, url, filename, timestamp, "offset", length FROM cdx'),
    "scan_cdx_unnamed": Query(
        _cdx_unnamed, """SELECT crawl_id, url, concat(crawl_id, '/', filename) AS filename, timestamp, "offset", length FROM cdx"""
    ),
    "save_progress": Query(
        _progress,
        """SELECT crawl_id, domain_pattern, articles_inserted, files FROM ledger_pairs JOIN
             (SELECT crawl_id, domain_pattern, count(*) AS files FROM ledger_files GROUP BY ALL)
             USING (crawl_id, domain_pattern)""",
    ),
    "quarantine": Query(
        _quarantine, "SELECT error_type, message, cast(event_id AS varchar) AS event FROM errors"
    ),
    "run_build": Query(
        _build,
        rf"""WITH {_EXTRACTED},
            pages_in AS (SELECT * FROM matched WHERE (contains(lower(url), '/en/') OR contains(lower(url), '/de/'))
                          AND timestamp >= '20200402000000' AND timestamp <= '20200427999999'),
            good AS (SELECT url, title, content, guess AS language, crawl_id, timestamp, row_number() OVER (
                       PARTITION BY md5(trim(regexp_replace(lower(content), '\s+', ' ', 'g'))) ORDER BY timestamp, url) AS rn
                     FROM texts JOIN guessed USING (url) JOIN ({_TITLES}) USING (url) JOIN pages_in USING (url)
                     WHERE length(content) >= 100 AND guess IN ('en', 'de'))
            SELECT url, title, content,
                   regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\.', '') AS source_domain,
                   crawl_id, timestamp, language, '200' AS status_code,
                   strftime(strptime(timestamp, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS publish_date,
                   cast(0 AS bigint) AS batch_id
            FROM good WHERE rn = 1""",
    ),
    "stream_ingest": Query(_stream_ingest, f"SELECT {_A} FROM ranked WHERE rn = 1"),
    "stream_dedup": Query(_stream_dedup, "SELECT DISTINCT content_hash FROM hashed"),
    "stream_daily_counts": Query(
        _stream_daily, "SELECT publish_date, count(url) AS article_count FROM articles GROUP BY ALL"
    ),
    "stream_rollup": Query(
        _rollup,
        """SELECT source_domain, language, publish_date, crawl_id, count(*) AS n_rows, count(url) AS n_urls,
                  count(content) AS n_texts, cast(sum(length(content)) AS bigint) AS n_chars FROM articles GROUP BY ALL""",
    ),
    "rollup_source_salience": Query(
        lambda v: rollup.salience(_rollup(v), "source_domain").withColumn("avg_content_length", F.round("avg_content_length", 6)),
        """SELECT source_domain, count(url) AS article_count, round(avg(length(content)), 6) AS avg_content_length
           FROM articles GROUP BY ALL""",
    ),
    "rollup_temporal_salience": Query(
        lambda v: rollup.temporal_salience(_rollup(v)),
        """SELECT publish_date, count(url) AS article_count, cast(sum(length(content)) AS bigint) AS total_content_length
           FROM articles GROUP BY ALL""",
    ),
    "rollup_statistics": Query(
        lambda v: rollup.total_statistics(_rollup(v)),
        """SELECT count(*) AS total_articles, count(DISTINCT source_domain) AS unique_sources,
                  count(DISTINCT language) AS unique_languages FROM articles""",
    ),
    "stream_status_changes": Query(_stream_status, _changes_sql("checks")),
    "stream_status_late": Query(_late_checks, _changes_sql("checks")),
}
