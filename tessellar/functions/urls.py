"""URL columns: host, top-level domain, extension, tidy spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_host(c: Column) -> Column:
    """Host of a URL, '' where there is none or the URL is malformed."""
    return F.coalesce(F.try_parse_url(c, F.lit("HOST")), F.lit(""))


def host_tld(host: Column, lower: bool = True) -> Column:
    """What follows the last dot of a host; '' without a dot, for numbers and for null."""
    part = F.regexp_extract(F.coalesce(host, F.lit("")), r"\.([^.]+)$", 1)
    part = F.when(part.rlike(r"^\d+$"), "").otherwise(part)
    return F.lower(part) if lower else part


def url_extension(c: Column) -> Column:
    """Extension of at most five characters at the end of a URL, in lower case, without a last slash; null for none and numbers."""
    ext = F.lower(F.regexp_replace(F.trim(F.regexp_extract(c, r"\.([^.]{1,5})$", 1)), r"/$", ""))
    return F.when((ext != "") & ~ext.rlike(r"^\d+$"), ext)


def tidy_url(c: Column) -> Column:
    """Outer blanks off, scheme and host in lower case; the rest as it is."""
    head = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
    u = F.trim(c)
    return F.concat(F.lower(F.regexp_extract(u, head, 1)), F.regexp_replace(u, head, ""))
