import hashlib
import re
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuslake import defaults
from corpuslake import functions as f
from corpuslake.functions.text import minimal_terms


def column(spark, values, expr, **more):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", expr(F.col("v")).alias("r"))
    return [r["r"] for r in df.orderBy("i").collect()]


def python_hash(text):
    return hashlib.md5(re.sub(r"\s+", " ", text.lower()).strip().encode()).hexdigest()


def test_content_hash_agrees_with_python(spark):
    texts = ["", " ", "A  b\n\tC ", "a b", "a b", "a\x1cb", "\x1fx\x85", "ÀÉ ß", "x" * 60000, "　a　 b"]
    assert column(spark, texts, f.content_hash) == [python_hash(t) for t in texts]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("aB \n\t  \x1c\x0b.", max_size=20), min_size=1, max_size=30))
def test_content_hash_property(spark, texts):
    assert column(spark, texts, f.content_hash) == [python_hash(t) for t in texts]


def test_missing_content_hashes_as_empty(spark):
    assert column(spark, [None], f.content_hash) == [python_hash("")]


def test_source_domain_agrees_with_urlparse(spark):
    urls = [
        "https://www.example.co.nz/path", "http://News.example.com:8080/x", "https://user:pw@www.example.com/",
        "https://sub.www.example.com", "example.com/x", "//www.example.com/x", "", "https://", "ftp://a?b", "mailto:x@y",
        "https://www.www.example.com#f", "http://example.com?u=http://other.com/", "http://[::1]:80/x",
    ]
    want = []
    for u in urls:
        netloc = urlparse(u).netloc
        want.append(netloc[4:] if netloc.startswith("www.") else netloc)
    assert column(spark, urls, f.source_domain) == want


def test_source_domain_of_unparsable_url_is_empty(spark):
    with pytest.raises(ValueError):
        urlparse("http://[bad/x")
    assert column(spark, ["http://[bad/x", None], f.source_domain) == ["", ""]


def test_host_and_suffixes(spark):
    assert column(spark, ["https://u@A.B.nz:81/x"], f.host) == ["a.b.nz"]
    assert column(spark, ["a.b.nz"], f.host_suffixes) == [["a.b.nz", "b.nz", "nz"]]


def test_publish_date_guard(spark):
    stamps = ["20200401123045", "2020040112304", "", None, "202004011230451"]
    text = "2020-04-01 12:30:45"
    assert column(spark, stamps, f.cdx_publish_date) == [text, "", "", "", text]
    assert column(spark, stamps, lambda c: f.cdx_publish_date(c, parity=True)) == ["", "", "", "", text]


def test_stamp_bound():
    assert f.stamp_bound("2020-04-01") == "20200401000000"
    assert f.stamp_bound("2020-06-30", upper=True) == "20200630999999"


def test_publish_day(spark):
    got = column(spark, ["2020-04-01", "2020-04-01 10:00:00", "", "junk", None], lambda c: f.publish_day(c).cast("string"))
    assert got == ["2020-04-01", "2020-04-01", None, None, None]


def test_lower_contains(spark):
    texts = ["COVID-19", "weather", "particular", None]
    assert column(spark, texts, lambda c: f.lower_contains(c, ["Covid", "icu"])) == [True, False, True, None]
    assert column(spark, texts, lambda c: f.lower_contains(c, ["Covid"], lower_terms=False))[0] is False
    assert column(spark, texts, lambda c: f.lower_contains(c, [])) == [False] * 4
    whole = column(spark, texts, lambda c: f.lower_contains(c, ["covid", "icu"], word_boundary=True))
    assert whole == [True, False, False, None]


def test_minimal_terms_keep_the_answer():
    terms = minimal_terms(defaults.KEYWORDS)
    assert len(terms) < len(defaults.KEYWORDS)
    for k in defaults.KEYWORDS:
        assert any(t in k for t in terms)


def test_truncate(spark):
    assert column(spark, ["abcdef", "abc", None], lambda c: f.truncate_text(c, 3, "...")) == ["abc...", "abc", None]


def test_language(spark):
    texts = ["the cat and the dog of that house", "le chat et la souris dans une maison", "zzz", "", None]
    assert column(spark, texts, f.detect_language) == ["en", "fr", "unknown", "unknown", "unknown"]
    one = {"en": ["the"]}
    assert column(spark, ["the end", "fin"], lambda c: f.detect_language(c, one)) == ["en", "unknown"]


def test_prompt(spark):
    long = "x" * 5000
    row = spark.createDataFrame([("T", long), (None, None)], "t string, c string").select(
        f.build_prompt("t", "c", ["a", "b"], 4000).alias("p"), f.build_prompt("t", "c", ["a", "b"]).alias("whole")
    ).collect()
    assert "Content:\n" + long + "\n\nRespond" in row[0]["whole"]
    assert "- a\n- b\n\nArticle Title: T\n\nArticle Content:\n" + "x" * 4000 + "...\n\nRespond" in row[0]["p"]
    assert "Article Title: \n" in row[1]["p"]


def test_normalize_category(spark):
    assert column(spark, [" border_policy\n", "", "  ", None, "other"], f.normalize_category) == [
        "border_policy", "unknown", "unknown", "error", "other",
    ]
    assert column(spark, ["other"], lambda c: f.normalize_category(c, ["border_policy"])) == ["unknown"]


def test_keyword_category(spark):
    rows = [("Vaccine doses arrive", ""), ("Border opens", "quarantine ends; vaccine"), ("Weather", "sun")]
    got = spark.createDataFrame(rows, "t string, c string").select(f.keyword_category("t", "c").alias("k")).collect()
    assert [r["k"] for r in got] == ["vaccination", "border_policy", "miscellaneous"]


def test_defaults_are_sane(spark):
    assert column(spark, defaults.CRAWL_IDS + ["CC-MAIN-20-1", "x"], f.valid_crawl_id) == [True] * 3 + [False] * 2
    assert len(set(defaults.CRAWL_IDS)) == len(defaults.CRAWL_IDS)
    assert all(p.startswith("*.") and p.endswith("/") for p in defaults.DOMAIN_PATTERNS)
    assert all(defaults.KEYWORDS) and len(defaults.CATEGORIES) == 10
    assert 0 < defaults.MIN_TEXT_CHARS < defaults.MAX_CONTENT_CHARS and defaults.LANGUAGES
    assert set(defaults.CATEGORY_TERMS) == set(defaults.CATEGORIES[:-1])
