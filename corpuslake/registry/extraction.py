"""Pages and archive records."""

from pyspark.sql import functions as F

from ..functions import detect_language
from ..functions.language import FUNCTION_WORDS
from ..operators import cdx as c
from ..operators import extract as x
from ..session import scratch_path
from ..sources.warc import RecordFilter, read_ranges, scan_targets, scan_warc
from . import Query

def _outline():
    return F.col("outline")



def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_VOTES = ", ".join(f"len(list_intersect(t, {_list(w)})) AS {lang}" for lang, w in FUNCTION_WORDS.items())
_BEST = f"greatest({', '.join(FUNCTION_WORDS)})"
_LEADERS = " + ".join(f"cast({lang} = {_BEST} AS int)" for lang in FUNCTION_WORDS)
_LANG_CASE = " ".join(f"WHEN {lang} = {_BEST} THEN '{lang}'" for lang in FUNCTION_WORDS)


def _language(table: str) -> str:
    tokens = r"string_split_regex(lower(content), '[^\p{L}]+')"
    return f"""SELECT url, CASE WHEN {_BEST} = 0 OR {_LEADERS} > 1 THEN 'unknown' {_LANG_CASE} END AS guess
               FROM (SELECT url, {_VOTES} FROM (SELECT url, {tokens} AS t FROM {table}))"""


_LANGUAGE = _language("articles")

# Text of the first <article>: hidden elements and comments out, split at tags, pieces stripped and joined.
# The closing semicolon of these names may be missing in HTML.
_ENTITIES = "{0}"
for _name, _char in (("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)"), ("nbsp", "chr(160)"), ("amp", "'&'")):
    _ENTITIES = f"regexp_replace({_ENTITIES}, '&{_name};?', {_char}, 'g')"
_ARTICLE = r"regexp_extract(html, '<article[^>]*>(.*?)</article>', 1, 's')"
_VISIBLE = (
    r"regexp_replace(regexp_replace({0}, '<!--.*?-->', '<i>', 'gs'), "
    r"'<(script|style|nav|footer|header|aside)\b.*?</(script|style|nav|footer|header|aside)>', '<i>', 'gs')"
)


def _text(html: str) -> str:
    """SQL for the visible text of some HTML."""
    pieces = f"string_split_regex({html}, '<[^>]*>')"
    clean = f"regexp_replace({_ENTITIES.format('s')}, '^\\s+|\\s+$', '', 'g')"
    return f"array_to_string(list_filter(list_transform({pieces}, lambda s: {clean}), lambda s: s <> ''), ' ')"


_TITLE = "regexp_extract(html, '<title>([^<]*)', 1)"
_TITLES = f"SELECT url, trim({_ENTITIES.format(_TITLE)}) AS title FROM pages"
_PAGES = f"SELECT url, {_text(_VISIBLE.format(_ARTICLE))} AS content FROM pages"

# Blocks: what follows an opening p or div up to the tag that ends it. In the given pages no div holds a block.
_BLOCKS = f"""
  visible AS (SELECT url, {_VISIBLE.format('html')} AS html FROM pages),
  pieces AS (SELECT url, unnest(p) AS html, generate_subscripts(p, 1) AS pos FROM
               (SELECT url, string_split_regex(html, '<(?:p|div)(?: [^>]*)?>') AS p FROM visible)),
  blocks AS (SELECT url, pos, {_text("regexp_replace(html, '(</p>|</div>|</article>).*$', '', 's')")} AS block
             FROM pieces WHERE pos > 1),
  longest AS (SELECT url, block FROM
               (SELECT *, row_number() OVER (PARTITION BY url ORDER BY length(block) DESC, pos) AS rn
                FROM blocks WHERE length(block) > 100) WHERE rn = 1)"""
_EXTRACTED = f"""{_BLOCKS},
  texts AS (SELECT url, CASE WHEN length(a) > 100 THEN a WHEN block IS NOT NULL THEN block ELSE w END AS content
            FROM ({_PAGES.replace(' AS content', ' AS a')}) LEFT JOIN longest USING (url)
            JOIN (SELECT url, {_text('html')} AS w FROM visible) USING (url)),
  guessed AS ({_language('texts')})"""

_READ_BACK = """SELECT 'response' AS warc_type, url AS target_uri, '200' AS status_code,
                       strftime(strptime(timestamp, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%SZ') AS warc_date, html
                FROM cdx JOIN (SELECT page_id, html FROM pages) USING (page_id)"""


#: Small enough to cut the archives of any size into many stretches.
_SPLIT = 100_000


def _archives(v):
    """Folder of archives with a request before each page, and their index."""
    base = scratch_path(v.spark, "archives")
    return base, v.written_archives(base, requests=True)


def _read_back(v, read):
    """Pages written as gzip archives and read again."""
    base = scratch_path(v.spark, "archives")
    return read(v.written_archives(base), base).select(
        "warc_type", "target_uri", "status_code", "warc_date", F.decode("payload", "utf-8").alias("html")
    )


_ARTICLES_SQL = rf"""WITH {_EXTRACTED}
            SELECT url, title, content AS content, guess AS language, '200' AS status_code,
                   regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\.', '')
                     AS source_domain
            FROM texts JOIN guessed USING (url) JOIN ({_TITLES}) USING (url)
            WHERE length(content) >= 100 AND guess IN ('en', 'fr', 'de', 'es')"""

QUERIES = {
    "decode_utf8": Query(
        lambda v: x.with_outline(v.pages.select(
            "url", F.concat(F.unhex(F.lit("FFC3")), F.col("html").cast("binary"), F.unhex(F.lit("E282"))).alias("html")
        )).select(
            "url", x.extract_title(_outline()).alias("title")
        ),
        _TITLES,
    ),
    "extract_title": Query(
        lambda v: x.with_outline(v.pages).select("url", x.extract_title(_outline()).alias("title")),
        _TITLES,
    ),
    "extract_main_text": Query(
        lambda v: x.with_outline(v.pages).select("url", x.extract_main_text(_outline(), 0).alias("content")), _PAGES
    ),
    "extract_main_text_100": Query(
        lambda v: x.with_outline(v.pages).select("url", x.extract_main_text(_outline()).alias("content")),
        f"WITH {_EXTRACTED} SELECT url, content FROM texts",
    ),
    "longest_block": Query(
        lambda v: x.with_outline(v.pages).select("url", x.longest_block(_outline()).alias("block")),
        f"WITH {_BLOCKS} SELECT url, block FROM pages LEFT JOIN longest USING (url)",
    ),
    "detect_language": Query(
        lambda v: v.articles.select("url", detect_language("content").alias("guess")), _LANGUAGE
    ),
    "detect_language_quality": Query(
        lambda v: v.articles.groupBy("language", detect_language("content").alias("guess")).agg(
            F.count(F.lit(1)).alias("n")
        ),
        f"SELECT language, guess, count(*) AS n FROM articles JOIN ({_LANGUAGE}) USING (url) GROUP BY ALL",
    ),
    "quality_gate": Query(
        lambda v: x.quality_gate(v.articles).select("url"),
        "SELECT url FROM articles WHERE length(content) >= 100 AND language IN ('en')",
    ),
    "reject_reason": Query(
        lambda v: v.articles.select("url", x.reject_reason("content", "language").alias("reason")),
        """SELECT url, CASE WHEN length(content) < 100 THEN 'text_too_short'
                            WHEN language NOT IN ('en') THEN 'language_not_allowed' END AS reason FROM articles""",
    ),
    "scan_warc": Query(
        lambda v: v.warc_records.select(
            "filename", "warc_type", "target_uri", "warc_date", "status_code",
            F.decode("payload", "utf-8").alias("html"),
        ),
        """SELECT filename, 'response' AS warc_type, url AS target_uri,
                  strftime(strptime(timestamp, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%SZ') AS warc_date,
                  '200' AS status_code, html FROM cdx JOIN (SELECT page_id, html FROM pages) USING (page_id)""",
    ),
    "scan_warc_files": Query(
        lambda v: _read_back(v, lambda index, base: scan_warc(v.spark, base)), _READ_BACK
    ),
    "scan_warc_split": Query(
        lambda v: _read_back(v, lambda index, base: scan_warc(v.spark, base, split_bytes=_SPLIT)), _READ_BACK
    ),
    "read_ranges_files": Query(
        lambda v: _read_back(v, lambda index, base: read_ranges(index, base, 8)), _READ_BACK
    ),
    "record_filter": Query(
        lambda v: v.warc_records.filter(F.col("warc_type") == "response").select("target_uri"),
        "SELECT url AS target_uri FROM pages",
    ),
    "record_filter_files": Query(
        lambda v: scan_warc(v.spark, _archives(v)[0], _SPLIT, RecordFilter(types=["response"])).select(
            "warc_type", "target_uri", F.decode("payload", "utf-8").alias("html")
        ),
        "SELECT 'response' AS warc_type, url AS target_uri, html FROM pages",
    ),
    "target_records_files": Query(
        lambda v: scan_targets(v.spark, _archives(v)[0], c.filter_keywords(v.cdx, ["/en/"]), _SPLIT).select(
            "target_uri", "status_code", F.decode("payload", "utf-8").alias("html")
        ),
        "SELECT url AS target_uri, '200' AS status_code, html FROM pages WHERE contains(lower(url), '/en/')",
    ),
    "target_records": Query(
        lambda v: c.target_records(v.warc_records, c.filter_keywords(v.cdx, ["/en/"])).select("target_uri", "filename"),
        "SELECT url AS target_uri, filename FROM cdx WHERE contains(lower(url), '/en/')",
    ),
    "extract_articles": Query(
        lambda v: x.extract_articles(
            v.warc_records, languages=["en", "fr", "de", "es"], min_chars=100
        ).select("url", "title", "content", "source_domain", "language", "status_code"),
        _ARTICLES_SQL,
    ),
    "extract_articles_files": Query(
        lambda v: x.extract_articles(
            scan_warc(v.spark, _archives(v)[0], _SPLIT, RecordFilter(types=["response"])),
            languages=["en", "fr", "de", "es"], min_chars=100,
        ).select("url", "title", "content", "source_domain", "language", "status_code"),
        _ARTICLES_SQL,
    ),
    "extract_rejects": Query(
        lambda v: x.rejected(x.extract_pages(v.pages, "url", "html", F.lit(""))).select(
            F.col("context")["url"].alias("url"), "error_type", "message"
        ),
        f"""WITH {_EXTRACTED}
            SELECT url, error_type, concat('page rejected: ', error_type) AS message FROM
              (SELECT url, CASE WHEN length(content) < 100 THEN 'text_too_short' ELSE 'language_not_allowed' END AS error_type
               FROM texts JOIN guessed USING (url) WHERE length(content) < 100 OR guess <> 'en')""",
    ),
}
