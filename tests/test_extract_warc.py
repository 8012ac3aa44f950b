import gzip
import io

import pyarrow as pa
from conftest import dicts
from pyspark.sql import functions as F

from corpuslake.functions import html_outline
from corpuslake.functions.html_outline import outline
from corpuslake.operators import classify, extract, metrics
from corpuslake.operators.cdx import target_records
from corpuslake.plans.ingest import Store, run_build
from corpuslake.plans.labelling import run_labelling
from corpuslake.schemas import CLASSIFICATIONS
from corpuslake.sources.cdx import scan_cdx
from corpuslake.sources.tables import scan_articles, scan_classifications, scan_ledger_files, scan_ledger_pairs, scan_quarantine
from corpuslake.sources import warc
from corpuslake.sources.warc import read_ranges, scan_warc, unreadable
from corpuslake.sources.warc_format import read_records

W = ("The minister said the cases of the virus are rising and that the border is closed to travel in the "
     "coming weeks, as the hospital was full with patients.")
LONG = W + " " + W


def main_text(spark, html, m=100):
    df = extract.with_outline(spark.createDataFrame([(html,)], "html string"))
    return df.select(extract.extract_main_text(F.col("outline"), m).alias("t"), F.col("outline")["title"].alias("h")).first()


def test_main_comes_first(spark):
    row = main_text(spark, f"<title> A &amp; B </title><article>{LONG}</article><main><p>{W}</p> x <b>y</b></main>")
    assert row["t"] == f"{W} x y" and row["h"] == "A & B"


def test_short_main_falls_through_to_article(spark):
    assert main_text(spark, f"<main>short</main><article>{W}</article><article>{LONG}</article>")["t"] == W


def test_only_the_first_article_counts(spark):
    html = f"<article>short</article><article>{LONG}</article><div class='x content'><i>{W}</i></div>"
    assert main_text(spark, html)["t"] == W


def test_container_order_beats_page_order(spark):
    html = f"<div class='content'>{LONG}</div><div class='article'>no</div><div class='big article'>{W}</div>"
    assert main_text(spark, html)["t"] == W


def test_longest_block_first_on_ties(spark):
    a, b = "a" * 120, "b" * 120
    assert main_text(spark, f"<div id=1>{a}</div><div id=2>{b}</div><p>{'c' * 110}</p>")["t"] == a
    df = extract.with_outline(spark.createDataFrame([(f"<p>{a}<p>{b}",), ("<p>x",)], "html string"))
    assert [r[0] for r in df.select(extract.longest_block(F.col("outline"))).collect()] == [a, None]


def test_all_text_as_last_resort(spark):
    html = "<title>T</title><body>one <p>two</p><!-- no --><script>var x='</p>'</script><nav>menu</nav> three</body>"
    assert main_text(spark, html)["t"] == "T one two three"


def test_exact_minimum_passes_only_as_whole_text(spark):
    t = "x" * 100
    assert main_text(spark, f"<article>{t}</article><p>y</p>")["t"] == f"{t} y"
    assert main_text(spark, f"<article>{t}</article><p>y</p>", 99)["t"] == t


def test_removed_elements_and_broken_markup():
    title, texts, *_ = outline(
        "<header>h</header><article><style>s</style><p>a<b>b<p>c<aside>no<p>no</aside><footer>f</footer>d</article>e"
    )
    assert texts == ["a", "b", "c", "d", "e"]
    assert outline("<div>a<span>b</div>c")[1] == ["a", "b", "c"]
    assert outline("1 < 2 &lt; 3")[1] == ["1 < 2 < 3"]
    assert outline(None) == ("", [], [], [], [], [])
    assert outline(b"<title>caf\xc3\xa9\xff</title>")[0] == "café"


def test_p_is_closed_by_the_next_block():
    _, texts, kinds, starts, sizes, _ = outline("<p>a<i>b<p>c<div>d</div>")
    assert list(zip(kinds, starts, sizes)) == [(6, 0, 2), (6, 2, 1), (6, 3, 1)]


def test_pages_are_gated_with_a_reason(spark):
    rows = [("https://www.a.nz/1", f"<article>{W}</article>"), ("https://a.nz/2", "<p>short</p>"),
            ("https://a.nz/3", f"<article>{'le chat et la souris dans la maison ' * 5}</article>")]
    pages = extract.extract_pages(spark.createDataFrame(rows, "url string, html string"), "url", "html", F.lit("200"))
    good = dicts(extract.accepted(pages))
    assert [(r["url"], r["source_domain"], r["language"]) for r in good] == [("https://www.a.nz/1", "a.nz", "en")]
    assert sorted(r["error_type"] for r in dicts(extract.rejected(pages))) == ["language_not_allowed", "text_too_short"]


def test_content_is_cut_after_the_gate(spark):
    pages = spark.createDataFrame([("u", f"<article>{LONG}</article>")], "url string, html string")
    got = extract.extract_articles(pages, url="url", html="html", status=F.lit(""), max_chars=10).first()
    assert got["content"] == LONG[:10] and got["language"] == "en"


def record(url, body, kind="response", status="200 OK"):
    block = f"HTTP/1.1 {status}\r\nContent-Type: text/html\r\n\r\n".encode() + body.encode() if kind == "response" else b"x"
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2020-04-01T00:00:00Z\r\n"
    return head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def write_warc(path, records):
    """Gzip members back to back; returns (offset, length) of each."""
    spans, data = [], b""
    for r in records:
        member = gzip.compress(r)
        spans.append((len(data), len(member)))
        data += member
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return spans


def test_read_records_keeps_what_came_before_the_damage():
    good = gzip.compress(record("u1", "<p>1")) + gzip.compress(record("u2", "<p>2"))
    rows = list(read_records("f", io.BytesIO(good[:-15])))
    assert [(r[1], r[2]) for r in rows] == [("response", "u1"), ("unreadable", "")] and rows[0][6] == b"<p>1"
    assert [r[1] for r in read_records("f", io.BytesIO(b"\x1f\x8bjunk"))] == ["unreadable"]
    assert [r[1] for r in read_records("f", io.BytesIO(b"not an archive\n"))] == ["unreadable"]
    assert list(read_records("f", io.BytesIO(b""))) == []
    plain = list(read_records("f", io.BytesIO(record("u", "b", status="404 Not Found"))))
    assert plain[0][5] == "404"


def test_scan_warc_reads_every_file(spark, tmp_path):
    write_warc(tmp_path / "w" / "a.warc.gz", [record("u0", "", "warcinfo"), record("u1", "<p>1"), record("u2", "<p>2")])
    (tmp_path / "w" / "b.warc.gz").write_bytes(b"\x1f\x8bjunk")
    rows = scan_warc(spark, str(tmp_path / "w"))
    assert rows.rdd.getNumPartitions() == 2
    targets = spark.createDataFrame([("u1",), ("u0",), ("",)], "url string")
    got = dicts(target_records(rows, targets))
    assert [(r["target_uri"], r["filename"], bytes(r["payload"])) for r in got] == [("u1", "a.warc.gz", b"<p>1")]
    assert [r["context"] for r in dicts(unreadable(rows))] == [{"filename": "b.warc.gz"}]
    assert scan_warc(spark, str(tmp_path / "w" / "a.warc.gz")).count() == 3


def test_read_ranges_fetches_single_records(spark, tmp_path):
    spans = write_warc(tmp_path / "x" / "a.warc.gz", [record(f"u{i}", f"<p>{i}") for i in range(20)])
    rows = [("x/a.warc.gz", o, n) for o, n in spans[5:9]] + [("gone.warc.gz", 0, 10)]
    got = read_ranges(spark.createDataFrame(rows, "filename string, offset long, length long"), str(tmp_path), 4)
    assert sorted(r["target_uri"] for r in dicts(got.filter("warc_type = 'response'"))) == ["u5", "u6", "u7", "u8"]
    assert [r["context"] for r in dicts(unreadable(got))] == [{"filename": "gone.warc.gz"}]


def corpus(spark, tmp_path):
    """Two archives, an index over them, one page of each kind of outcome."""
    page = lambda body: f"<html><title>T</title><body><article>{body}</article></body></html>"
    pages = {
        "a.warc.gz": [("https://www.stuff.co.nz/covid-1", page(LONG)), ("https://www.stuff.co.nz/covid-copy", page(LONG.upper())),
                      ("https://www.stuff.co.nz/weather", page(W)), ("https://www.rnz.co.nz/covid-2", page(W + " More of it."))],
        "b.warc.gz": [("https://i.stuff.co.nz/covid-short", page("too short")), ("https://other.com/covid", page(W))],
    }
    lines = []
    for name, content in pages.items():
        spans = write_warc(tmp_path / "warc" / name, [record(u, b) for u, b in content])
        for i, ((u, _), (o, n)) in enumerate(zip(content, spans)):
            lines.append((("CC-MAIN-2020-16"), u, name, f"2020040{i + 1}123045", str(o), str(n)))
    schema = "crawl_id string, url string, filename string, timestamp string, offset string, length string"
    spark.createDataFrame(lines, schema).write.json(str(tmp_path / "cdx"))
    return scan_cdx(spark, str(tmp_path / "cdx"))


def test_build_end_to_end_and_resume(spark, tmp_path):
    index = corpus(spark, tmp_path)
    store = Store(str(tmp_path / "store"))
    patterns = ["*.stuff.co.nz/", "*.rnz.co.nz/"]
    args = dict(patterns=patterns, crawl_ids=["CC-MAIN-2020-16"], partitions=4)
    first = run_build(spark, index, str(tmp_path / "warc"), store, 0, **args)
    assert (first.received, first.inserted) == (3, 2)
    rows = {r["url"]: r for r in dicts(scan_articles(spark, store.articles))}
    assert set(rows) == {"https://www.stuff.co.nz/covid-1", "https://www.rnz.co.nz/covid-2"}
    one = rows["https://www.stuff.co.nz/covid-1"]
    assert (one["source_domain"], one["crawl_id"], one["timestamp"], one["publish_date"], one["status_code"], one["title"]) == (
        "stuff.co.nz", "CC-MAIN-2020-16", "20200401123045", "2020-04-01 12:30:45", "200", "T")
    assert [r["error_type"] for r in dicts(scan_quarantine(spark, store.errors))] == ["text_too_short"]
    done = {(r["domain_pattern"], r["articles_inserted"]) for r in dicts(scan_ledger_pairs(spark, store.pairs))}
    assert done == {("*.stuff.co.nz/", 1), ("*.rnz.co.nz/", 1)}
    assert scan_ledger_files(spark, store.files).count() == 3

    again = run_build(spark, index, str(tmp_path / "warc"), store, 1, **args)
    assert again.received == 0
    wider = run_build(spark, index, str(tmp_path / "warc"), store, 2, **{**args, "patterns": patterns + ["*.other.com/"]})
    assert wider.inserted == 1 and scan_articles(spark, store.articles).count() == 3
    forced = run_build(spark, index, str(tmp_path / "warc"), store, 3, resume=False, **args)
    assert (forced.received, forced.inserted) == (3, 0)


def test_build_reports_damaged_ranges(spark, tmp_path):
    index = corpus(spark, tmp_path)
    (tmp_path / "warc" / "b.warc.gz").write_bytes(b"\x1f\x8bjunk" * 100)
    store = Store(str(tmp_path / "store"))
    run_build(spark, index, str(tmp_path / "warc"), store, 0, patterns=["*.stuff.co.nz/"],
              crawl_ids=["CC-MAIN-2020-16"], partitions=2)
    assert [r["error_type"] for r in dicts(scan_quarantine(spark, store.errors))] == ["download_failed"]
    # A file that could not be read is not marked, so a later run tries it again.
    assert {r["filename"] for r in dicts(scan_ledger_files(spark, store.files))} == {"a.warc.gz"}
    assert scan_ledger_pairs(spark, store.pairs).count() == 0


def test_file_limit(spark, tmp_path):
    index = corpus(spark, tmp_path)
    got = run_build(spark, index, str(tmp_path / "warc"), Store(str(tmp_path / "s")), 0, patterns=["*.stuff.co.nz/"],
                    crawl_ids=["CC-MAIN-2020-16"], partitions=2, max_files=1)
    assert got.received == 2


def test_labelling_resumes(spark, tmp_path, make_articles):
    rows = make_articles(dict(url="1", title="Vaccine", content="dose"), dict(url="2", title="Border", content="border"),
                         dict(url="3", title="x", content="y"))
    old = spark.createDataFrame([("1", "kept"), ("3", None), ("gone", "old")], CLASSIFICATIONS)
    got = {r["url"]: r["category"] for r in dicts(classify.classify_articles(rows, old))}
    assert got == {"1": "kept", "2": "border_policy", "3": "miscellaneous", "gone": "old"}

    calls = classify.callable_scorer(lambda prompt: 1 / 0 if "Border" in prompt else " vaccination\n")
    out = [str(tmp_path / n) for n in ("l1", "e1", "l2", "e2")]
    first = run_labelling(spark, rows, None, out[0], out[1], calls)
    assert {(r["category"], r["count"]) for r in dicts(first)} == {("vaccination", 2), ("error", 1)}
    assert {(r["category"], r["count"]) for r in dicts(
        run_labelling(spark, rows, out[0], out[2], out[3], retry_errors=True)
    )} == {("vaccination", 2), ("border_policy", 1)}
    assert scan_classifications(spark, out[2]).count() == 3
    assert scan_classifications(spark, str(tmp_path / "none")).count() == 0
    strict = classify.callable_scorer(lambda prompt: "nonsense", strict=True)
    assert {r["category"] for r in dicts(strict(rows.select("url", "title", "content")))} == {"unknown"}


def test_limited_labelling_keeps_other_articles(spark, tmp_path, make_articles):
    rows = make_articles(dict(url="1", title="Vaccine"), dict(url="2", language="fr"))
    counts = run_labelling(spark, rows, None, str(tmp_path / "l"), str(tmp_path / "e"), input_filter="language = 'en'")
    assert {(r["category"], r["count"]) for r in dicts(counts)} == {("vaccination", 1), (None, 1)}
    assert metrics.category_counts(spark.read.parquet(str(tmp_path / "e"))).count() == 2


def test_a_filter_does_not_parse_pages_twice(spark):
    pages = spark.createDataFrame([("u", "<p>x")], "url string, html string")
    out = extract.accepted(extract.extract_pages(pages, "url", "html", F.lit(""))).filter("language = 'en'")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_outlines_are_handed_on_in_slices(monkeypatch):
    monkeypatch.setattr(html_outline, "SLICE", 10_000)
    pages = [f"<title>{i}</title><p>{'x' * (i % 7)}</p>" for i in range(100)] + [None, ""]
    for given in (pa.array(pages), pa.array([p if p is None else p.encode() for p in pages])):
        parts = list(html_outline.outlines(iter([given, given[:0]])))
        assert [tuple(r.values()) for p in parts for r in p.to_pylist()] == [tuple(outline(p)) for p in pages]
        assert len(parts) > 5 and max(map(len, parts)) <= 10


def test_records_are_handed_on_in_slices():
    """Records without a payload weigh something as well, and a large one goes alone."""
    sizes = [0] * 20_000 + [9 << 20] + [100]
    parts = list(warc._packs(("f", "response", "u", "", {}, "200", b"x" * n) for n in sizes))
    assert [len(r[-1]) for p in parts for r in p] == sizes and max(map(len, parts)) <= 8192
    assert all(sum(len(r[-1]) for r in p[:-1]) < 8 << 20 for p in parts)
