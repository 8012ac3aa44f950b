"""URL column functions, written with regular expressions because parse_url throws on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, default_empty

# Leading control characters and a scheme, then the network location; its brackets come in pairs or not at all.
_AUTHORITY = (
    r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    r"([^/?#\[\]]*(?:\[[^/?#]*\][^/?#\[\]]*)?)(?:[/?#]|$)"
)
CRAWL_ID = r"^CC-MAIN-\d{4}-\d+$"


def authority(url: Column | str) -> Column:
    """Network location of a URL as written; '' where there is none or its brackets do not pair."""
    return F.regexp_extract(F.translate(default_empty(url), "\t\r\n", ""), _AUTHORITY, 1)


def source_domain(url: Column | str) -> Column:
    """Network location without a leading 'www.'; case, port, user info and other labels stay."""
    return F.regexp_replace(authority(url), r"^www\.", "")


def host(url: Column | str) -> Column:
    """Lower-cased host without user info and port."""
    return F.regexp_replace(F.regexp_replace(F.lower(authority(url)), r"^.*@", ""), r":\d*$", "")


def host_suffixes(name: Column | str) -> Column:
    """a.b.c -> [a.b.c, b.c, c]: turns a suffix match into an equality."""
    parts = F.split(col(name), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )


def valid_crawl_id(crawl_id: Column | str) -> Column:
    return col(crawl_id).rlike(CRAWL_ID)
