"""What streams keep between micro-batches: bounded tables, rows in order, hot texts, replays."""

import random

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from corpuslake.operators import cdx, metrics, rollup
from corpuslake.operators.monitor import status_changes
from corpuslake.schemas import ARTICLES
from corpuslake.sinks.articles import fresh_rows
from corpuslake.sinks.versions import advance, drop_before, latest, version_before, versions
from corpuslake.streaming import jobs

CHECKS = "service string, ts timestamp, check_id long, status string"


def feed(spark, source, schema, parts, start):
    """Parts arrive one after the other; ``start`` runs on the stream each time."""
    for part in parts:
        part.write.mode("append").parquet(source)
        start(spark.readStream.schema(schema).parquet(source)).awaitTermination()


def checks_of(spark, rows):
    frame = spark.createDataFrame(rows, "service string, at long, check_id long, status string")
    return frame.select("service", F.timestamp_seconds("at").alias("ts"), "check_id", "status")


def reported(df):
    return sorted((r["service"] or "", r["check_id"], r["status"], r["previous"], r["check_number"], r["changed"], r["recovered"]) for r in dicts(df))


def test_shuffled_checks_give_the_batch_answer(spark, tmp_path):
    draw = random.Random(1)
    rows = [(draw.choice(["a", "b", None]), 1000 + i // 3, i, draw.choice(["UP", "UP", "DOWN"])) for i in range(300)]
    arrival = sorted(rows, key=lambda r: r[1] + draw.uniform(0, 30))
    path, at = str(tmp_path / "status"), str(tmp_path / "at")
    parts = [checks_of(spark, arrival[i : i + 75]) for i in range(0, 300, 75)]
    feed(spark, str(tmp_path / "in"), parts[0].schema, parts, lambda s: jobs.stream_status_changes(s, path, at, late_by=31))
    settled = spark.read.parquet(f"{path}/changes").drop("version")
    waiting = jobs.pending_changes(spark, path, parts[0].schema)
    assert reported(settled.unionByName(waiting)) == reported(status_changes(checks_of(spark, rows)))
    assert waiting.count() and spark.read.schema(CHECKS).parquet(f"{path}/late").count() == 0
    for table in ("state", "waiting", "clock"):
        assert versions(spark, f"{path}/{table}") == [2, 3]


def test_checks_that_come_too_late_are_set_aside(spark, tmp_path):
    path, at = str(tmp_path / "status"), str(tmp_path / "at")
    parts = [checks_of(spark, rows) for rows in (
        [("a", 10, 1, "UP"), ("a", 20, 2, "DOWN")], [("a", 15, 3, "UP"), ("a", 30, 4, "DOWN"), ("a", None, 6, "DOWN")], [("a", 40, 5, "UP")],
    )]
    feed(spark, str(tmp_path / "in"), parts[0].schema, parts, lambda s: jobs.stream_status_changes(s, path, at))
    got = reported(spark.read.parquet(f"{path}/changes"))
    assert [(r[1], r[2], r[3]) for r in got] == [(1, "UP", None), (2, "DOWN", "UP"), (5, "UP", "DOWN")]
    assert [r["check_id"] for r in dicts(spark.read.schema(CHECKS).parquet(f"{path}/late"))] == [3]


def test_a_replayed_batch_makes_the_same_version(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "n long")
    add = lambda before: before.unionByName(one).agg(F.sum("n").alias("n"))
    for version in (0, 1, 1, 2, 2, 2):
        advance(spark, path, version, "n long", add)
    assert latest(spark, path, "n long").first()[0] == 3 and versions(spark, path) == [1, 2]
    (tmp_path / "t" / "version=7").mkdir()  # a version that was never completed
    assert latest(spark, path, "n long").first()[0] == 3
    assert version_before(spark, path, 1, "n long").count() == 0
    drop_before(spark, path, 100)
    assert versions(spark, path) == [] and latest(spark, path, "n long").count() == 0


def test_metrics_from_the_rollup_are_those_of_the_articles(spark, make_articles):
    draw = random.Random(2)
    rows = make_articles(*[
        dict(url=draw.choice(["u", None]), content=draw.choice(["x" * draw.randrange(50), None]), source_domain=draw.choice(["a", "b", None]),
             language=draw.choice(["en", "de", None]), publish_date=draw.choice(["", "2020-04-01", "2020-04-01 10:00:00", "2020-04-02"]),
             crawl_id=draw.choice(["c", "d"])) for _ in range(300)
    ])
    parts = rows.withColumn("part", F.monotonically_increasing_id() % 5)
    kept = None
    for i in range(5):
        own = rollup.rollup(parts.filter(F.col("part") == i).drop("part"))
        kept = own if kept is None else rollup.added(kept.unionByName(own))
    kept = kept.cache()
    both = [
        (rollup.total_count(kept), metrics.total_count(rows)), (rollup.stats_by(kept, "source_domain"), metrics.stats_by_source(rows)),
        (rollup.stats_by(kept, "language"), metrics.stats_by_language(rows)),
        (rollup.salience(kept, "source_domain"), metrics.source_salience(rows)), (rollup.salience(kept, "language"), metrics.language_salience(rows)),
        (rollup.temporal_salience(kept), metrics.temporal_salience(rows)),
        (rollup.articles_per(kept, ["publish_date"]), metrics.articles_per_day(rows)),
        (rollup.articles_per(kept, ["source_domain", "publish_date"]), metrics.articles_per_source_day(rows)),
        (rollup.total_statistics(kept), metrics.total_statistics(rows)), (rollup.coverage_statistics(kept), metrics.coverage_statistics(rows)),
        (rollup.trend_daily(kept), metrics.trend_daily(rows)), (rollup.counts_by(kept, ["crawl_id"]), metrics.counts_by_crawl(rows)),
        (rollup.counts_by(kept, ["source_domain", "crawl_id"]), metrics.counts_by_domain_crawl(rows)),
        (rollup.counts_by(kept, ["source_domain"]), metrics.counts_by_domain(rows)),
    ]
    for mine, theirs in both:
        assert mine.columns == theirs.columns
        a, b = [tuple(r) for r in mine.collect()], [tuple(r) for r in theirs.collect()]
        assert sorted(map(repr, a)) == sorted(map(repr, b)) or [pytest.approx(x) for x in a] == b
    assert kept.count() <= 3 * 3 * 3 * 2
    empty = rollup.rollup(rows.limit(0))
    assert rollup.total_count(empty).first()[0] == 0 and rollup.total_statistics(empty).first()[0] == 0


def test_rollup_of_a_stream_keeps_two_versions(spark, tmp_path, make_articles):
    path, at = str(tmp_path / "rollup"), str(tmp_path / "at")
    parts = [make_articles(*[dict(url=f"{i}{k}", content="x" * k) for k in range(10)]) for i in range(4)]
    feed(spark, str(tmp_path / "in"), ARTICLES, parts, lambda s: jobs.stream_rollup(s, path, at))
    kept = latest(spark, path, rollup.SCHEMA)
    assert [(r["n_rows"], r["n_chars"]) for r in dicts(kept)] == [(40, 180)] and versions(spark, path) == [2, 3]


def test_a_hot_text_leaves_each_task_as_one_row(spark, tmp_path):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("content_hash"),
        *[F.col("id").cast("string").alias(c) for c in ARTICLES.names if c != "content_hash"],
    ).select(*ARTICLES.names)
    rows.repartition(8).write.parquet(str(tmp_path / "s"))
    staged = spark.read.schema(ARTICLES).parquet(str(tmp_path / "s"))
    plan = staged.groupBy("content_hash").agg(F.min(F.struct("timestamp", "url")))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    stored = spark.createDataFrame([("7",), ("none",)], "content_hash string")
    got = fresh_rows(staged, stored)
    assert got.count() == 4000 - 1334 + 1 - 1 and got.filter("content_hash = 'hot'").first()["url"] == "0"


def test_dedup_over_batches_remembers_as_told(spark, tmp_path, make_articles):
    part = lambda *texts: make_articles(*[dict(url=f"{i}", content=t, timestamp=str(i)) for i, t in enumerate(texts)])
    parts = [part("a", "A ", "b"), part("b", "c", "c"), part("a", "d"), part("c", "a")]
    for remember, want in ((None, ["a", "b", "c", "d"]), (1, ["a", "a", "b", "c", "c", "d"])):
        path, at = str(tmp_path / f"u{remember}"), str(tmp_path / f"at{remember}")
        feed(spark, str(tmp_path / f"in{remember}"), ARTICLES, parts, lambda s: jobs.stream_dedup(s, path, at, remember))
        got = dicts(spark.read.schema(ARTICLES).parquet(path))
        assert sorted(r["content"] for r in got) == want


def matches(index, patterns):
    return sorted((r["url"], r["domain_pattern"]) for r in dicts(index))


def test_hosts_unfold_to_the_lengths_that_rules_have(spark):
    urls = ["https://a.b.example.com/1", "https://example.com/2", "https://other.com/3", "http://x.org/4", "https://deep.er.a.b.nz/5", "nothing", ""]
    index = spark.createDataFrame([(u,) for u in urls], "url string")
    rules = lambda *p: spark.createDataFrame([(x,) for x in p], "domain_pattern string")
    got = lambda *p: matches(cdx.domain_match(index, rules(*p)), p)
    assert got("*.example.com/", "other.com", "*.b.nz") == sorted([(urls[0], "*.example.com/"), (urls[1], "*.example.com/"), (urls[2], "other.com"), (urls[4], "*.b.nz")])
    assert got("*.com") == [(u, "*.com") for u in urls[:3]] and got("com") == []
    assert got("*.com", "*.example.com", "example.com") == sorted(
        [(u, "*.com") for u in urls[:3]] + [(urls[0], "*.example.com"), (urls[1], "*.example.com"), (urls[1], "example.com")])
    assert cdx.domain_match(index, rules("x").limit(0)).count() == 0
    hosts = spark.range(3000).select(F.concat(F.lit("https://h"), "id", F.lit(".a.b.com/")).alias("url"))
    matched = cdx.domain_match(hosts, rules("*.b.com"))
    matched.collect()
    node = matched._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in node
    spread = hosts.select(F.explode(F.split("url", r"\.")))
    assert matched.count() == 3000 < spread.count()  # one row per host, not one per label


def test_a_bare_top_level_domain_is_cut_into_parts(spark):
    """A rule for ``com`` goes to every part; rows of ``com`` hash to them by url."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hosts = spark.range(4000).select(F.concat(F.lit("https://h"), "id", F.lit(".com/")).alias("url"))
        found = cdx.domain_match(hosts, spark.createDataFrame([("*.com",), ("h7.com",)], "domain_pattern string"))
        assert found.count() == 4001 and found.columns == ["url", "domain_pattern"]
        assert "_salt" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
