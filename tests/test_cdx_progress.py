import json

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from corpuslake.operators import cdx, errors, progress
from corpuslake.schemas import CDX, LEDGER_PAIRS, QUARANTINE
from corpuslake.sinks.ledgers import mark_files, mark_pairs, quarantine
from corpuslake.sources.cdx import scan_cdx
from corpuslake.sources.tables import (
    progress_files, progress_pairs, scan_ledger_files, scan_ledger_pairs, scan_progress, scan_quarantine,
)


def index(spark, *rows):
    base = {"crawl_id": "c", "url": "https://example.com/1", "filename": "w1", "timestamp": "20200401000000",
            "offset": 0, "length": 1}
    return spark.createDataFrame([tuple({**base, **r}[c] for c in CDX.names) for r in rows], CDX)


def urls(df):
    return sorted(r["url"] for r in df.select("url").collect())


def test_keyword_filter(spark):
    rows = index(spark, *[dict(url=f"https://example.com/{p}") for p in ("covid-update", "weather", "coronavirus-cases")])
    assert cdx.filter_keywords(rows, ["covid", "coronavirus"]).count() == 2
    mixed = index(spark, dict(url="https://example.com/COVID-article"), dict(url="https://example.com/cOvId-news"))
    assert cdx.filter_keywords(mixed, ["covid"]).count() == 2
    assert cdx.filter_keywords(rows, []).count() == 0
    assert cdx.filter_keywords_inline(rows, [], 2, ["crawl_id"]).count() == 2
    assert cdx.filter_keywords_inline(rows, ["Covid"], 2, ["crawl_id"]).count() == 0


def test_grouping_by_file(spark):
    rows = index(spark, dict(url="1"), dict(url="2"), dict(url="3", filename="w2"), dict(url="4", filename=""))
    assert {(r["filename"], r["n_urls"]) for r in dicts(cdx.warc_groups(rows))} == {("w1", 2), ("w2", 1)}
    assert {(r["url"], r["urls_in_file"]) for r in dicts(cdx.group_by_warc(rows))} == {("1", 2), ("2", 2), ("3", 1)}
    assert cdx.warc_groups(rows.filter("false")).count() == 0


@pytest.mark.parametrize("bounds, want", [
    (dict(), ["1", "2", "3"]),
    (dict(date_start="2020-04-02"), ["2", "3"]),
    (dict(date_end="2020-04-02"), ["1", "2"]),
    (dict(date_start="2020-04-02", date_end="2020-04-02"), ["2"]),
])
def test_date_bounds_apply_alone(spark, bounds, want):
    rows = index(spark, *[dict(url=str(d), timestamp=f"2020040{d}120000") for d in (1, 2, 3)])
    assert urls(cdx.date_range(rows, **bounds)) == want


def test_domain_match(spark):
    hosts = ["stuff.co.nz", "www.Stuff.co.nz:443", "notstuff.co.nz", "a.b.stuff.co.nz", "stuff.co.nz.evil.com", "rnz.co.nz"]
    rows = index(spark, *[dict(url=f"https://{h}/x") for h in hosts])
    got = cdx.domain_match(rows, cdx.pattern_table(spark, ["*.stuff.co.nz/", "http://rnz.co.nz/", "*.b.stuff.co.nz/"]))
    pairs = sorted((r["url"].split("/")[2], r["domain_pattern"]) for r in dicts(got))
    assert pairs == sorted([
        ("stuff.co.nz", "*.stuff.co.nz/"), ("www.Stuff.co.nz:443", "*.stuff.co.nz/"),
        ("a.b.stuff.co.nz", "*.stuff.co.nz/"), ("a.b.stuff.co.nz", "*.b.stuff.co.nz/"), ("rnz.co.nz", "http://rnz.co.nz/"),
    ])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_exact_pattern_does_not_take_subdomains(spark):
    rows = index(spark, dict(url="https://www.rnz.co.nz/"))
    assert cdx.domain_match(rows, cdx.pattern_table(spark, ["rnz.co.nz/"])).count() == 0


def test_files_top_n(spark):
    rows = index(spark, *[dict(url=f"{i}", filename=f"w{i % 4}") for i in range(20)])
    assert {r["filename"] for r in dicts(cdx.files_top_n(rows, 2, ["crawl_id"]))} == {"w0", "w1"}
    assert cdx.files_top_n(rows, 2, ["crawl_id"]).count() == 10
    assert cdx.files_top_n(rows, None, ["crawl_id"]).count() == 20


def test_attach_index_row_takes_the_first(spark):
    pages = spark.createDataFrame([("w1", "u"), ("w1", "x")], "filename string, url string")
    rows = index(spark, dict(url="u", timestamp="2"), dict(url="u", timestamp="1"), dict(url="u", filename="w2", timestamp="0"))
    got = {r["url"]: r["timestamp"] for r in dicts(cdx.attach_index_row(pages, rows))}
    assert got == {"u": "1", "x": ""}


def test_scan_cdx(spark, tmp_path):
    lines = [json.dumps({"url": "u", "filename": "f", "timestamp": "t", "offset": "12", "length": "3", "mime": "x"}),
             "{broken", json.dumps({"filename": "no url"}), json.dumps({"url": "v"})]
    (tmp_path / "a.json").write_text("\n".join(lines))
    got = {r["url"]: r for r in dicts(scan_cdx(spark, str(tmp_path)))}
    assert set(got) == {"u", "v"}
    assert got["u"]["offset"] == 12 and got["v"]["filename"] == "" and got["v"]["offset"] is None
    with pytest.raises(Exception):
        scan_cdx(spark, str(tmp_path), strict=True).collect()


def ledger(spark, *pairs):
    rows = spark.createDataFrame([(*p, 5) for p in pairs], "crawl_id string, domain_pattern string, articles_inserted long")
    return rows.withColumn("completed_at", F.timestamp_seconds(F.lit(0))).select(*LEDGER_PAIRS.names)


def test_remaining_work(spark):
    pairs = progress.pairs_cross(cdx.pattern_table(spark, ["domain1", "domain2"]), ["crawl1", "crawl2"])
    assert pairs.count() == 4
    done = ledger(spark, ("crawl1", "domain1"))
    left = {tuple(r) for r in progress.remaining_work(pairs, done).collect()}
    assert left == {("crawl1", "domain2"), ("crawl2", "domain1"), ("crawl2", "domain2")}
    assert progress.remaining_work(pairs, done.filter("false")).count() == 4


def test_reports(spark):
    pairs = progress.pairs_cross(cdx.pattern_table(spark, [f"d{i}" for i in range(5)]), ["c1", "c2"])
    done = ledger(spark, ("c1", "d0"), ("c1", "d0"), *[("c2", f"d{i}") for i in range(5)], ("old", "gone"))
    assert dicts(progress.missing_by_crawl(pairs, done)) == [
        {"crawl_id": "c1", "n_missing": 4, "first_missing": "d1, d2, d3", "n_more": 1}]
    s = progress.progress_summary(pairs, done).first()
    assert (s["completed_pairs"], s["total_articles_inserted"], s["total_combinations"], s["missing"]) == (7, 40, 10, 4)


def test_ledgers_round_trip(spark, tmp_path):
    pairs, files = str(tmp_path / "p"), str(tmp_path / "f")
    assert scan_ledger_pairs(spark, pairs).count() == 0 and scan_ledger_files(spark, files).count() == 0
    mark_pairs(ledger(spark, ("c", "d")).drop("completed_at"), pairs)
    assert scan_ledger_pairs(spark, pairs).first()["completed_at"] is not None
    rows = index(spark, dict(filename="w1"), dict(filename="w2")).withColumn("domain_pattern", F.lit("d"))
    mark_files(rows.limit(1), files)
    left = progress.remaining_files(rows, scan_ledger_files(spark, files))
    assert {r["filename"] for r in dicts(left)} == {"w2"}
    other = rows.withColumn("domain_pattern", F.lit("e"))
    assert progress.remaining_files(other, scan_ledger_files(spark, files)).count() == 2


def test_checkpoint_import(spark, tmp_path):
    state = {"completed_crawl_domain_pairs": ["crawl1:*.a.nz/", "crawl1:http://b:80/"], "total_articles_inserted": 7,
             "last_updated": "2024-01-01"}
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps(state, indent=2))
    bad.write_text("{not json")
    rows = scan_progress(spark, str(good))
    assert {tuple(r) for r in progress_pairs(rows).collect()} == {("crawl1", "*.a.nz/"), ("crawl1", "http://b:80/")}
    assert progress_files(rows).count() == 0
    assert rows.first()["total_articles_inserted"] == 7
    assert scan_progress(spark, str(bad)).count() == 0
    assert scan_progress(spark, str(tmp_path / "none.json")).count() == 0


def test_error_reports(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = [(t, f"m{i}", {"url": str(i)}) for i, t in enumerate("bababcdefg")]
    for i, row in enumerate(rows):
        one = spark.createDataFrame([row], "error_type string, message string, context map<string,string>")
        quarantine(one.withColumn("at", F.timestamp_seconds(F.lit(i))), path)
    stored = scan_quarantine(spark, path)
    assert stored.columns == QUARANTINE.names
    assert errors.error_total(stored).first()["count"] == 10
    assert dicts(errors.error_counts(stored))[0] == {"error_type": "b", "count": 3}
    assert errors.errors_by_type(stored, "a").count() == 2
    assert errors.error_samples(stored).count() == 7
    samples = dicts(errors.error_samples(stored, 5))
    assert [r["error_type"] for r in samples] == ["b", "a", "c", "d", "e"]
    assert samples[0]["message"] == "m0" and samples[1]["context"] == {"url": "1"}
