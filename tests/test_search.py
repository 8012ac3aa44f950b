"""Indexed search against a search of everything."""

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from corpuslake.operators.articles import search_by_keyword
from corpuslake.plans import search
from corpuslake.sinks.articles import append_articles, compact_small_files, insert_batch
from corpuslake.sources.tables import scan_articles

PATTERNS = [
    "licence", "zebra", "Zebra|quagga", "(?:zebra|quagga) s", "[Zz]ebra", "z.*a", "ze+bra sighting", "(?i)ZEBRA", "zebra{2,}", "été", r"zebra\b", "no such string",
    "", "ab", r"zeb\p{L}+", "x?zebra", "(a|b)", r"\d{3}-zebra", "zebra s(ighting)?", "titular",
]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("search")
    path, index = str(folder / "articles"), str(folder / "index")
    rows = spark.range(400).select(
        F.concat(F.lit("https://s"), "id").alias("url"), F.concat(F.lit("s"), F.col("id") % 40, F.lit(".com")).alias("source_domain"),
        F.when(F.col("id") == 77, "a titular page").otherwise("page").alias("title"),
        F.concat(F.lit("plain words, a licence and number "), "id", F.when(F.col("id") == 5, " zebra sighting").when(F.col("id") == 9, " quagga s")
                 .when(F.col("id") == 11, " un été 123-zebrabra").otherwise("")).alias("content"),
    )
    insert_batch(rows, path, 0)
    search.extend_search_index(spark, path, index)
    return path, index


@pytest.mark.parametrize("pattern", PATTERNS)
def test_rows_are_those_of_a_full_search(spark, table, pattern):
    path, index = table
    want = search_by_keyword(scan_articles(spark, path), pattern)
    got = search.search_indexed(spark, path, index, pattern)
    assert got.columns == want.columns
    assert sorted(r["url"] for r in dicts(got)) == sorted(r["url"] for r in dicts(want))


def test_few_files_are_read(spark, table):
    path, index = table
    files = len(scan_articles(spark, path).inputFiles())
    read = lambda p: search.candidate_files(spark, path, index, p)
    assert files > 20 and len(read("zebra sighting")) == 1 and len(read("Zebra|quagga")) <= 2 and read("no such string at all") == []
    assert len(read("licence")) == files and read("(?i)zebra") is None and read("ab") is None and len(read("titular")) == 1


def test_new_and_compacted_files_are_found(spark, tmp_path, make_articles):
    path, index = str(tmp_path / "a"), str(tmp_path / "i")
    assert search.candidate_files(spark, str(tmp_path), index, "zebra") == []
    for i in range(5):
        append_articles(make_articles(dict(url=str(i), content=f"zebra {i}" if i % 2 else "other")), path, i)
        if i < 3:
            search.extend_search_index(spark, path, index)
    found = lambda: sorted(r["url"] for r in dicts(search.search_indexed(spark, path, index, "zebra")))
    assert found() == ["1", "3"]  # the files of batches 3 and 4 are not indexed and read
    compact_small_files(spark, path)
    assert found() == ["1", "3"]
    search.extend_search_index(spark, path, index)
    search.extend_search_index(spark, path, index)
    assert found() == ["1", "3"] and spark.read.parquet(index).groupBy("path", "word").count().filter("count > 1").count() == 0


@pytest.mark.parametrize(("pattern", "want"), [
    ("abc", [[b"abc"]]), ("abc.*defg", [[b"abc", b"defg"]]), ("abc|de", None), ("abc|def", [[b"abc"], [b"def"]]), ("(abc)+", [[b"abc"]]), ("(abc)*", None),
    ("ab", None), ("[abc]def", [[b"def"]]), ("(?i)abc", None), ("a++bcd", None), (r"\Qabc\E", None), ("(?:x(?:abc|bcd))y", [[b"abc"], [b"bcd"]]), ("(", None), ("abc{0,2}", None), ("ét", [[b"\xc3\xa9t"]]),
])
def test_what_patterns_require(pattern, want):
    assert search.required(pattern) == want
