"""String columns: tidy keys, mime names, truncation, control characters, leading numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_mime(c: Column) -> Column:
    """Lower case, one leading and one trailing quote off, runs of white space to one blank, trimmed; null stays null."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r'^"|"$', ""), r"\s+", " "))


def mime_essence(c: Column) -> Column:
    """The part of a mime before its parameters."""
    return F.trim(F.substring_index(c, ";", 1))


def clean_key(c: Column) -> Column:
    """Null as '', trimmed, line ends and tabs as blanks."""
    return F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"[\r\n\t]", " ")


def store_text(c: Column, most: int) -> Column:
    """Text as a bounded column holds it: null as '', NUL as a blank, cut to ``most`` characters."""
    return F.substring(F.replace(F.coalesce(c, F.lit("")), F.lit("\x00"), F.lit(" ")), 1, most)


def escape_controls(c: Column) -> Column:
    """The three control characters that an index rejects, spelled out."""
    for ch, name in (("\x00", "u0000"), ("\x1f", "u001f"), ("\x1e", "u001e")):
        c = F.replace(c, F.lit(ch), F.lit(name))
    return c


def leading_int(c: Column) -> Column:
    """``7 or so`` -> 7; null where none."""
    return F.regexp_extract(c, r"^\s*(\d+)", 1).try_cast("int")


def primary_language(c: Column) -> Column:
    """First of a comma list; null as ''."""
    return F.coalesce(F.split(c, ",")[0], F.lit(""))


def non_blank(c: Column) -> Column:
    """Blank values as null, as a document that leaves them out."""
    return F.when(F.trim(c) != "", c)
