"""What a build meets on real input: unnamed crawls, narrow runs before wide ones, missing and broken records."""

import gzip
import zlib

from conftest import dicts
from pyspark.sql import functions as F
from test_extract_warc import LONG, corpus

from corpuslake.operators import classify, metrics
from corpuslake.plans.ingest import Store, run_build
from corpuslake.sinks.articles import insert_batch
from corpuslake.sources.cdx import bad_cdx_lines, scan_cdx
from corpuslake.sources.tables import scan_articles, scan_funnel, scan_ledger_pairs, scan_quarantine
from corpuslake.sources.warc import read_ranges
from corpuslake.sources.warc_format import read_records, split_http
from corpuslake.streaming.jobs import advance_status

ARGS = dict(patterns=["*.stuff.co.nz/"], crawl_ids=["CC-MAIN-2020-16"], partitions=2)


def test_crawl_is_named_by_parameter_file_or_path(spark, tmp_path):
    folder = tmp_path / "CC-MAIN-2020-24"
    folder.mkdir()
    (folder / "x.json").write_text('{"url": "u1", "filename": "crawl-data/CC-MAIN-2020-16/a.warc.gz"}\n{"url": "u2", "filename": "b"}\nbroken\n')
    got = {r["url"]: r["crawl_id"] for r in dicts(scan_cdx(spark, str(folder)))}
    assert got == {"u1": "CC-MAIN-2020-16", "u2": "CC-MAIN-2020-24"}
    assert {r["crawl_id"] for r in dicts(scan_cdx(spark, str(folder), crawl_id="given"))} == {"given"}
    assert [r["message"] for r in dicts(bad_cdx_lines(spark, str(folder)))] == ["broken"]


def test_unnamed_rows_are_reported_and_close_nothing(spark, tmp_path):
    index = corpus(spark, tmp_path).withColumn("crawl_id", F.lit(""))
    store = Store(str(tmp_path / "store"))
    assert run_build(spark, index, str(tmp_path / "warc"), store, **ARGS).received == 0
    assert {r["error_type"] for r in dicts(scan_quarantine(spark, store.errors))} == {"no_crawl_id"}
    assert scan_ledger_pairs(spark, store.pairs).count() == 0


def test_limited_run_leaves_the_rest_open(spark, tmp_path):
    index, store = corpus(spark, tmp_path), Store(str(tmp_path / "store"))
    first = run_build(spark, index, str(tmp_path / "warc"), store, max_files=1, **ARGS)
    assert (first.received, scan_ledger_pairs(spark, store.pairs).count()) == (2, 0)
    second = run_build(spark, index, str(tmp_path / "warc"), store, max_files=1, **ARGS)
    assert second.batch_id == 1 and {r["error_type"] for r in dicts(scan_quarantine(spark, store.errors))} == {"text_too_short"}
    assert scan_ledger_pairs(spark, store.pairs).count() == 1
    funnel = dicts(scan_funnel(spark, store.funnel).filter("batch_id = 0"))
    assert [(r["urls_found"], r["keyword_urls"], r["files"], r["extracted"], r["inserted"], r["duplicates"]) for r in funnel] == [(4, 3, 2, 2, 1, 1)]


def test_narrow_dates_do_not_hide_later_work(spark, tmp_path):
    index, store = corpus(spark, tmp_path), Store(str(tmp_path / "store"))
    args = {**ARGS, "patterns": ["*.stuff.co.nz/", "*.rnz.co.nz/"]}
    assert run_build(spark, index, str(tmp_path / "warc"), store, date_end="2020-04-01", **args).inserted == 1
    wider = run_build(spark, index, str(tmp_path / "warc"), store, **args)
    assert wider.inserted == 1 and scan_articles(spark, store.articles).count() == 2


def test_record_of_another_url_is_reported(spark, tmp_path):
    index = corpus(spark, tmp_path).withColumn("url", F.regexp_replace("url", "https://www.stuff.co.nz/covid-1$", "http://www.stuff.co.nz/covid-1"))
    store = Store(str(tmp_path / "store"))
    run_build(spark, index, str(tmp_path / "warc"), store, **ARGS)
    lost = [r for r in dicts(scan_quarantine(spark, store.errors)) if r["error_type"] == "record_not_found"]
    assert [r["context"] for r in lost] == [{"url": "http://www.stuff.co.nz/covid-1", "filename": "a.warc.gz"}]


def test_rows_without_ranges_do_not_stop_the_others(spark, tmp_path):
    rows = corpus(spark, tmp_path).filter("filename = 'a.warc.gz'")
    first = F.col("url").endswith("covid-1")
    rows = rows.withColumns({"offset": F.when(~first, F.col("offset")), "length": F.when(~F.col("url").endswith("weather"), F.col("length"))})
    got = dicts(read_ranges(rows, str(tmp_path / "warc"), 2))
    assert sorted(r["warc_type"] for r in got) == ["response"] * 3 + ["unreadable"]
    assert "https://www.stuff.co.nz/weather" in {r["target_uri"] for r in got}


def test_header_names_in_any_case():
    import io

    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    raw = b"WARC/1.0\r\nwarc-type: response\r\nWARC-target-uri: u\r\ncontent-length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    assert [(r[1], r[2], r[5], r[6]) for r in read_records("f", io.BytesIO(raw))] == [("response", "u", "200", b"body")]


def test_bodies_are_unpacked():
    head = b"HTTP/1.1 200 OK\r\n"
    page = b"<p>text</p>" * 50
    chunks = b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in (page[:100], page[100:])) + b"0\r\n\r\n"
    assert split_http(head + b"Transfer-Encoding: chunked\r\n\r\n" + chunks)[1] == page
    assert split_http(head + b"Transfer-Encoding: chunked\r\n\r\n" + page)[1] == page
    assert split_http(head + b"content-encoding: GZIP\r\n\r\n" + gzip.compress(page))[1] == page
    assert split_http(head + b"Content-Encoding: deflate\r\n\r\n" + zlib.compress(page))[1] == page
    assert split_http(head + b"Content-Encoding: gzip\r\n\r\n" + page)[1] == page


def test_days_of_built_articles(make_articles):
    rows = make_articles(
        dict(url="1", publish_date="2020-03-15 10:00:00"), dict(url="2", publish_date="2020-03-15 11:00:00"), dict(url="3", publish_date="")
    )
    assert {(r["publish_date"], r["article_count"]) for r in dicts(metrics.articles_per_day(rows))} == {("2020-03-15", 2), ("", 1)}
    assert metrics.articles_per_day(rows, parity=True).count() == 3
    plan = metrics.salience_sections(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_each_article_is_asked_once(spark, make_articles):
    calls = spark.sparkContext.accumulator(0)

    def answer(prompt):
        calls.add(1)
        return "vaccination"

    rows = make_articles(*[dict(url=str(i), content=LONG * 30) for i in range(20)])
    old = spark.createDataFrame([("1", "kept"), ("gone", "old")], "url string, category string")
    got = classify.classify_articles(rows, old, classify.callable_scorer(answer)).collect()
    assert len(got) == 21 and calls.value == 19


def test_a_real_label_wins(spark):
    rows = [("1", "error"), ("1", "border_policy"), ("2", "unknown"), ("2", "error"), ("3", "unknown"), ("3", "international")]
    df = spark.createDataFrame(rows, "url string, category string")
    assert {tuple(r) for r in classify.one_label_per_url(df).collect()} == {("1", "border_policy"), ("2", "unknown"), ("3", "international")}
    timed = df.withColumn("labelled_at", F.when(F.col("category") == "error", 2).otherwise(1))
    assert dict(classify.one_label_per_url(timed).collect())["1"] == "error"


def test_batches_number_themselves(spark, tmp_path, make_articles):
    path = str(tmp_path / "t")
    assert [insert_batch(make_articles(dict(content=c)), path).batch_id for c in ("a", "b")] == [0, 1]
    assert {r["batch_id"] for r in dicts(scan_articles(spark, path))} == {0, 1}


def test_checks_without_a_service_keep_one_state(spark):
    one = lambda i, s: spark.createDataFrame([(None, i, s)], "service string, check_id long, status string").withColumn(
        "ts", F.timestamp_seconds(F.lit(i)))
    _, state = advance_status(one(1, "UP"), None)
    changes, state = advance_status(one(2, "DOWN"), state)
    assert [(r["previous"], r["check_number"]) for r in dicts(changes)] == [("UP", 2)]
    assert [(r["status"], r["checks"]) for r in dicts(state)] == [("DOWN", 2)]


def test_builds_gather_small_files_as_they_go(spark, tmp_path, monkeypatch):
    from corpuslake.plans import ingest

    index, store = corpus(spark, tmp_path), Store(str(tmp_path / "store"))
    gathered, real = [], ingest.compact_small_files
    monkeypatch.setattr(ingest, "compact_small_files", lambda spark, path: gathered.append(real(spark, path, fan_in=2)))
    for i, end in enumerate(["2020-04-01", "2020-04-02", None]):
        args = {**ARGS, "patterns": ["*.stuff.co.nz/", "*.rnz.co.nz/", "*.other.com/"]}
        run_build(spark, index, str(tmp_path / "warc"), store, i, date_end=end, compact_every=2, **args)
    assert len(gathered) == 1
    urls = {r["url"] for r in dicts(scan_articles(spark, store.articles))}
    assert urls == {"https://www.stuff.co.nz/covid-1", "https://www.rnz.co.nz/covid-2", "https://other.com/covid"}
