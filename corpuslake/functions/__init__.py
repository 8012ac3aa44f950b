from .dates import capture_time, cdx_publish_date, day_text, publish_day, stamp_bound
from .labels import build_prompt, keyword_category, normalize_category
from .language import detect_language, language_votes
from .text import (
    collapse_whitespace,
    content_hash,
    default_empty,
    lower_contains,
    regex_contains,
    text_length,
    truncate_text,
)
from .urls import authority, host, host_suffixes, source_domain, valid_crawl_id

__all__ = [
    "authority", "build_prompt", "capture_time", "cdx_publish_date", "collapse_whitespace", "content_hash",
    "day_text", "default_empty", "detect_language", "host", "host_suffixes", "keyword_category", "language_votes",
    "lower_contains", "normalize_category", "publish_day", "regex_contains", "source_domain", "stamp_bound",
    "text_length", "truncate_text", "valid_crawl_id",
]
