"""Date column functions over 14-digit capture stamps and publish-date strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def cdx_publish_date(stamp: Column | str, parity: bool = False) -> Column:
    """yyyyMMddHHmmss -> 'yyyy-MM-dd HH:mm:ss', else ''.

    ``parity=True`` keeps the historic guard of 15 characters, which no 14-digit stamp passes.
    """
    s = col(stamp)
    part = lambda start, n: F.substring(s, start, n)
    text = F.concat(
        part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "),
        part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2),
    )
    return F.when(F.length(s) >= (15 if parity else 14), text).otherwise("")


def stamp_bound(iso: str, upper: bool = False) -> str:
    """An ISO date or date-time as a 14-digit bound: padded with 0 below, 9 above."""
    return "".join(ch for ch in iso if ch.isdigit())[:14].ljust(14, "9" if upper else "0")


def capture_time(stamp: Column | str) -> Column:
    return F.try_to_timestamp(col(stamp), F.lit("yyyyMMddHHmmss"))


def day_text(publish_date: Column | str) -> Column:
    """Calendar day of a publish date as text; dates that are none, '' too, stay as they are."""
    c = col(publish_date)
    return F.coalesce(F.date_format(publish_day(c), "yyyy-MM-dd"), c)


def publish_day(publish_date: Column | str) -> Column:
    """Calendar day of a publish date, NULL where it is empty or unreadable."""
    return F.try_to_timestamp(F.left(col(publish_date), F.lit(10)), F.lit("yyyy-MM-dd")).cast("date")
