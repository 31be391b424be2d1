"""Labels of URLs for the query of the URL filter: a fixture in place of a labelled list, not part of the filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

#: Words of host names that a list of unwanted hosts would hold.
UNWANTED = ("ads", "adult", "bets", "casino", "loans", "lottery", "pills", "poker", "porn", "spam", "viagra", "xxx")
#: Hosts whose crc32 leaves 0 on division by this have no label, so that the filter can be held against hosts it never saw.
UNSEEN = 4


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def unwanted(url: Column) -> Column:
    """Whether a word of the host, between dots and hyphens, is in ``UNWANTED``."""
    return F.arrays_overlap(F.split(_host(url), r"[.-]"), F.array(*map(F.lit, UNWANTED)))


def unseen(url: Column) -> Column:
    return F.crc32(_host(url)) % UNSEEN == 0


def labelled(pages: DataFrame, url_col: str = "url", key_col: str = "page_id") -> DataFrame:
    """(key, url, label): 1 for unwanted URLs, 0 for others; URLs of unseen hosts, and
    rows without URL or key, are left out. Rows that repeat stay."""
    d = pick(pages, url=url_col, key=key_col).dropna().filter(~unseen(F.col("url")))
    return d.select(F.col("key").alias(key_col), F.col("url").alias(url_col), unwanted(F.col("url")).cast("int").alias("label"))
