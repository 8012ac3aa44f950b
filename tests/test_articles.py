from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import dicts
from pyspark.sql import functions as F

from corpuslake.operators import articles as a
from corpuslake.operators import dedup, metrics
from corpuslake.schemas import STORED_ARTICLES
from corpuslake.sinks.articles import (
    append_articles,
    compact_articles,
    compact_small_files,
    export_dataset,
    insert_article,
    insert_batch,
    small_groups,
)
from corpuslake.sources.tables import SOURCE_BUCKETS, init_articles, scan_articles


def fresh(tmp_path):
    return str(tmp_path / "articles")


def test_init_creates_an_empty_table_once(spark, tmp_path):
    path = fresh(tmp_path)
    table = init_articles(spark, path)
    assert table.count() == 0 and table.columns == STORED_ARTICLES.names
    insert_article(spark, path, url="u", content="c", source_domain="example.com")
    assert init_articles(spark, path).count() == 1


def test_same_content_is_refused(spark, tmp_path):
    path = fresh(tmp_path)
    one = dict(content="Same content", source_domain="example.com", timestamp="2020-04-01", language="en")
    assert insert_article(spark, path, url="https://example.com/1", title="A", **one)
    assert not insert_article(spark, path, batch_id=1, url="https://example.com/2", title="B", **one)
    row = dicts(scan_articles(spark, path))[0]
    assert row["url"] == "https://example.com/1" and row["publish_date"] == "" and row["batch_id"] == 0


def test_batch_dedups_inside_and_against_table(spark, tmp_path, make_articles):
    path = fresh(tmp_path)
    rows = make_articles(
        dict(url="b", content="Hello  World", timestamp="2"),
        dict(url="a", content="hello world", timestamp="2"),
        dict(url="c", content=" HELLO\nworld", timestamp="3"),
        dict(url="d", content="other", timestamp="1", source_domain="other.com"),
    )
    first = insert_batch(rows, path, 0)
    assert (first.received, first.inserted, first.skipped) == (4, 2, 2)
    assert {r["url"] for r in dicts(scan_articles(spark, path))} == {"a", "d"}
    again = insert_batch(rows, path, 1)
    assert (again.inserted, again.skipped) == (0, 4)
    more = insert_batch(rows.unionByName(make_articles(dict(url="e", content="new"))), path, 2)
    assert (more.inserted, more.skipped) == (1, 4)
    assert scan_articles(spark, path).count() == 3


def test_full_duplicates_leave_one_row(spark, tmp_path, make_articles):
    path = fresh(tmp_path)
    rows = make_articles(*[dict(url="u", content="x")] * 50)
    assert insert_batch(rows.repartition(5), path, 0).inserted == 1
    assert scan_articles(spark, path).count() == 1


def test_empty_batch(spark, tmp_path, make_articles):
    assert insert_batch(make_articles().filter("false"), fresh(tmp_path), 0).received == 0


def test_empty_and_number_like_sources_survive_storage(spark, tmp_path, make_articles):
    path = fresh(tmp_path)
    insert_batch(make_articles(dict(source_domain="", content="1"), dict(source_domain="2020", content="2")), path, 0)
    got = scan_articles(spark, path)
    assert {r["source_domain"] for r in dicts(got)} == {"", "2020"}
    assert [r["content"] for r in dicts(got.filter("source_domain = ''"))] == ["1"]


def test_one_source_reads_one_folder(spark, tmp_path, make_articles):
    """Whatever the number of sources there is a bounded number of folders, and a source lies in one."""
    path = fresh(tmp_path)
    rows = spark.range(3000).select(F.concat(F.lit("host"), "id", F.lit(".com")).alias("source_domain"), F.col("id").cast("string").alias("content"))
    insert_batch(rows, path, 0)
    folders = {f.name for f in (tmp_path / "articles").iterdir() if f.is_dir()}
    assert folders == {f"source_bucket={i}" for i in range(SOURCE_BUCKETS)}
    some = scan_articles(spark, path, ["host7.com", "host7.com"]).select("url")
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_bucket" in text and "EqualTo(source_domain,host7.com)" in text
    assert "ReadSchema: struct<url:string,source_domain:string>" in text
    assert [r["content"] for r in dicts(scan_articles(spark, path, ["host7.com"]))] == ["7"]
    assert {f.rsplit("/", 2)[1] for f in some.inputFiles()} == folders  # inputFiles does not prune; the scan does
    some.collect()
    assert scan_articles(spark, path, ["host7.com", "host8.com", "none"]).count() == 2 and scan_articles(spark, path, []).count() == 0
    text = scan_articles(spark, path).filter("source_domain = 'other.com'").select("url")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(source_domain), EqualTo(source_domain,other.com)]" in text


def test_files_are_sorted_by_source_and_day(spark, tmp_path):
    path = fresh(tmp_path)
    rows = spark.range(500).select(
        F.concat(F.lit("h"), F.col("id") % 150).alias("source_domain"), F.col("id").cast("string").alias("content"),
        F.concat(F.lit("2020-04-"), F.lpad((1 + F.col("id") % 28).cast("string"), 2, "0")).alias("publish_date"),
    )
    insert_batch(rows, path, 0)
    for f in (tmp_path / "articles").rglob("*.parquet"):
        keys = [tuple(r.values()) for r in pq.read_table(f, columns=["source_domain", "publish_date"], partitioning=None).to_pylist()]
        assert keys == sorted(keys)


def test_hot_source_is_split_over_files(spark, tmp_path, make_articles):
    """The rebalance hint may cut one source into several files; rows stay whole."""
    path = fresh(tmp_path)
    rows = spark.range(40000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("content"), F.lit("hot.com").alias("source_domain"),
        *[F.col("id").cast("string").alias(c) for c in
          ["url", "title", "content_hash", "crawl_id", "timestamp", "language", "status_code", "publish_date"]],
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        append_articles(rows, path, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    stored = scan_articles(spark, path)
    assert stored.count() == 40000
    assert len(stored.inputFiles()) > 1


def test_stats_by_source_and_language(make_articles):
    rows = make_articles(dict(), dict(source_domain="other.com", language="fr"), dict(source_domain="other.com"))
    assert [tuple(r) for r in metrics.stats_by_source(rows).collect()] == [("other.com", 2), ("example.com", 1)]
    assert [tuple(r) for r in metrics.stats_by_language(rows).collect()] == [("en", 2), ("fr", 1)]


def test_recent_search_projection(make_articles):
    rows = make_articles(
        dict(url="1", title="COVID Article", timestamp="2020-04-01"), dict(url="2", title="Other", timestamp="2020-04-02")
    )
    assert [r["url"] for r in dicts(a.recent_articles(rows, 1))] == ["2"]
    assert [r["url"] for r in dicts(a.search_by_keyword(rows, "COVID"))] == ["1"]
    assert a.search_by_keyword(rows, "covid").count() == 0
    assert a.search_by_keyword(rows, "C.VID|Oth").count() == 2
    assert a.all_articles(rows, ["url"]).columns == ["url"]
    wanted = a.urls(rows.limit(0)).unionByName(rows.select(F.concat("url", F.lit("x")).alias("url"))).unionByName(a.urls(rows))
    assert a.known_urls(wanted, rows).count() == 2


def test_query_sorts_nulls_first_both_ways(make_articles):
    rows = make_articles(dict(url="1", timestamp=None), dict(url="2", timestamp="b"), dict(url="3", timestamp="a"))
    assert [r["url"] for r in dicts(a.query_articles(rows))] == ["1", "2", "3"]
    assert [r["url"] for r in dicts(a.query_articles(rows, order_by="timestamp ASC"))] == ["1", "3", "2"]
    assert [r["url"] for r in dicts(a.query_articles(rows, "timestamp = 'a'"))] == ["3"]


def test_date_range_as_strings_and_as_days(make_articles):
    rows = make_articles(
        dict(url="1", publish_date="2020-04-30"), dict(url="2", publish_date="2020-04-30 08:00:00"),
        dict(url="3", publish_date=""), dict(url="4", publish_date="2020-03-01"),
    )
    got = lambda **k: {r["url"] for r in dicts(a.articles_by_date_range(rows, "2020-03-01", "2020-04-30", **k))}
    assert got(inclusive_day=False) == {"1", "4"}
    assert got() == {"1", "2", "4"}


def test_hash_exists(make_articles):
    rows = make_articles(dict(content_hash="h"))
    assert a.hash_exists(rows, "h").first()["found"] and not a.hash_exists(rows, "x").first()["found"]


def test_load_articles(make_articles):
    rows = make_articles(dict(url="1"), dict(url="2", language="fr")).withColumn("ok", F.col("language") == "fr")
    assert [r["url"] for r in dicts(a.load_articles(rows, "ok"))] == ["2"]
    assert a.load_articles(rows, limit=1).count() == 1


def test_versions(spark, tmp_path, make_articles):
    path = fresh(tmp_path)
    for i in range(3):
        append_articles(make_articles(dict(url=str(i), content=str(i))), path, i)
    stored = scan_articles(spark, path)
    assert a.articles_as_of(stored, 1).count() == 2
    assert [r["batch_id"] for r in dicts(a.ingest_history(stored, 2))] == [2, 1]
    assert a.current_version(stored).first()["version"] == 2


def test_compaction_keeps_rows(spark, tmp_path, make_articles):
    path = fresh(tmp_path)
    for i in range(5):
        append_articles(make_articles(dict(url=str(i)), dict(url=f"o{i}", source_domain="other.com")), path, i)
    before = scan_articles(spark, path)
    after = compact_articles(spark, path, str(tmp_path / "compact"))
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    assert len(after.inputFiles()) < len(before.inputFiles())


def stored_rows(spark, path):
    return sorted(map(tuple, scan_articles(spark, path).collect()))


def table_files(tmp_path):
    return sorted(str(f.relative_to(tmp_path)) for f in (tmp_path / "articles").rglob("*.parquet"))


def filled(spark, tmp_path, batches, sources=6):
    path = fresh(tmp_path)
    for i in range(batches):
        rows = spark.range(40).select(
            F.concat(F.lit("s"), F.col("id") % sources, F.lit(".com")).alias("source_domain"), F.concat(F.lit(f"{i} "), "id").alias("content"),
        )
        insert_batch(rows, path, i)
    return path


def test_small_files_are_gathered_in_place(spark, tmp_path):
    path = filled(spark, tmp_path, 7)
    before, rows = table_files(tmp_path), stored_rows(spark, path)
    gathered = compact_small_files(spark, path)
    after = table_files(tmp_path)
    assert gathered == len(before) and len(after) <= len(before) / 6 and stored_rows(spark, path) == rows
    assert not [f for f in (tmp_path / "articles").iterdir() if f.name.startswith("_gathered")]
    assert compact_small_files(spark, path) == 0 and table_files(tmp_path) == after


def test_names_come_in_stretches(spark, tmp_path, monkeypatch):
    from corpuslake.sinks import articles as sink

    path = filled(spark, tmp_path, 4)
    rows = stored_rows(spark, path)
    monkeypatch.setattr(sink, "MOST_NAMES", 5)
    assert compact_small_files(spark, path) == 4 * 6 and stored_rows(spark, path) == rows and len(table_files(tmp_path)) == 6


def test_large_files_and_few_files_stay(spark, tmp_path):
    path = filled(spark, tmp_path, 3)
    before = table_files(tmp_path)
    assert compact_small_files(spark, path) == 0  # three files of a folder are fewer than four
    assert compact_small_files(spark, path, small_bytes=1, fan_in=2) == 0 and table_files(tmp_path) == before
    assert compact_small_files(spark, path, fan_in=2) == len(before)


def test_tiers_keep_rows_from_being_written_again_and_again(spark):
    sizes = [(f"p{i}", 1000 + i, 0) for i in range(5)] + [("m1", 1 << 20, 0), ("m2", 1 << 20, 0), ("l", 1 << 30, 0), ("o", 1000, 1)]
    files = spark.createDataFrame(sizes, "path string, length long, source_bucket int")
    got = lambda **k: {r["path"] for r in dicts(small_groups(files, **k))}
    assert got() == {f"p{i}" for i in range(5)}
    assert got(fan_in=2) == {f"p{i}" for i in range(5)} | {"m1", "m2"}
    assert got(fan_in=6) == set()


def test_a_change_over_that_died_is_completed_or_dropped(spark, tmp_path, monkeypatch):
    """At whatever step the run dies, the rows are the same after the next start."""
    from corpuslake.sinks import articles as sink

    path = filled(spark, tmp_path, 4)
    rows = stored_rows(spark, path)

    class Died(Exception):
        pass

    def dies(*args):
        raise Died

    monkeypatch.setattr(sink, "_announce", dies)  # written, but not announced
    with pytest.raises(Died):
        compact_small_files(spark, path)
    monkeypatch.undo()
    assert stored_rows(spark, path) == rows
    files = table_files(tmp_path)
    sink.finish_compaction(spark, path)
    assert len(table_files(tmp_path)) < len(files) and stored_rows(spark, path) == rows  # the hidden files are gone

    real = sink.finish_compaction
    calls = []

    def once(*args):
        calls.append(1)
        if len(calls) > 1:
            raise Died
        real(*args)

    monkeypatch.setattr(sink, "finish_compaction", once)  # announced, but not changed over
    with pytest.raises(Died):
        compact_small_files(spark, path)
    monkeypatch.undo()
    hidden = next(f for f in (tmp_path / "articles").iterdir() if f.name.startswith("_gathered"))
    old = [line.removeprefix("file:") for line in (hidden / "replaces").read_text().splitlines()]
    part = next(hidden.glob("source_bucket=*/*.parquet"))
    part.rename(tmp_path / "articles" / part.parent.name / part.name)  # one new file is in place already, one old one gone
    Path(old[0]).unlink()
    sink.finish_compaction(spark, path)
    assert stored_rows(spark, path) == rows and not set(old) & {str(tmp_path / f) for f in table_files(tmp_path)}
    sink.finish_compaction(spark, str(tmp_path / "nowhere"))


def test_export_dataset(spark, tmp_path, make_articles):
    assert export_dataset(make_articles().filter("false"), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()
    assert export_dataset(make_articles(dict(), dict(url="2")), str(tmp_path / "some")) == 2


def test_dedup_first_is_planned_with_a_map_side_limit(make_articles):
    rows = dedup.with_content_hash(make_articles(dict(url="2"), dict(url="1")))
    out = dedup.dedup_first(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [r["url"] for r in dicts(out)] == ["1"]


def test_filters_and_columns_reach_the_scan(spark, tmp_path, make_articles):
    path = fresh(tmp_path)
    append_articles(make_articles(dict()), path, 0)
    stored = scan_articles(spark, path)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    text = plan(a.articles_by_date_range(stored, "2020-03-01", "2020-04-30").select("url"))
    assert "PushedFilters: [IsNotNull(publish_date), GreaterThanOrEqual(publish_date,2020-03-01)" in text
    assert "ReadSchema: struct<url:string,publish_date:string>" in text
    assert "LessThanOrEqual(batch_id,3)" in plan(a.articles_as_of(stored, 3))
    assert "EqualTo(content_hash,h)" in plan(a.hash_exists(stored, "h"))
    assert "ReadSchema: struct<url:string,source_domain:string>" in plan(metrics.stats_by_source(stored))
    assert "TakeOrderedAndProject" in plan(a.recent_articles(stored))
