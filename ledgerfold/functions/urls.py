"""URL safety as column expressions: what may be rendered as a link."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerfold.functions.jsonval import let

# The schemes a catalogued link may use.
ALLOWED_SCHEMES = ("ftp", "ftps", "http", "https", "mailto")


def clean_url(value: Column) -> Column:
    text = F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00\t\r\n]", "")
    return F.regexp_replace(text, r"^[\x00-\x20\x7f]+|[\x00-\x20\x7f]+$", "")


def safe_url(value: Column, schemes: tuple[str, ...] = ALLOWED_SCHEMES,
             allow_relative: bool = False) -> Column:
    """The cleaned URL when its scheme is allowed, else NULL."""

    def judge(cleaned: Column) -> Column:
        probe = F.regexp_replace(cleaned, r"[\x00-\x20\x7f]+", "")
        scheme = F.lower(F.regexp_extract(probe, r"(?i)^([a-z][a-z0-9+.\-]*):", 1))
        relative = (scheme == "") & ~probe.startswith("//") & F.lit(allow_relative)
        return F.when((cleaned != "") & (scheme.isin(*schemes) | relative), cleaned)

    return let(clean_url(value), judge)


def safe_urls(values: Column) -> Column:
    """Safe URLs of an array, first occurrence kept."""
    return F.array_distinct(F.array_compact(F.transform(values, lambda u: safe_url(u))))


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))
