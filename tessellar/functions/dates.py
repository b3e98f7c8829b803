"""Dates as document tools print them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def report_date(c: Column) -> Column:
    """``Fri Aug  7 03:04:05 2026 CET`` as a timestamp without zone, null where it doesn't parse.

    Weekday and zone are taken off first: the wall time is read as UTC whatever zone is printed, as the tools' consumers do.
    """
    plain = F.regexp_replace(F.trim(c), r"\s+", " ")
    core = F.regexp_extract(plain, r"^[A-Za-z]{3} ([A-Za-z]{3} \d{1,2} \d{2}:\d{2}:\d{2} \d{4})(?: \S+)?$", 1)
    return F.try_to_timestamp(core, F.lit("MMM d HH:mm:ss yyyy")).cast("timestamp_ntz")


def iso_instant(c: Column) -> Column:
    """A timestamp without zone as an ISO instant in UTC, '' for null."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def content_length(c: Column) -> Column:
    """An HTTP length; anything but a whole number, and -1, is null."""
    n = c.try_cast("bigint")
    return F.when(n >= 0, n)
