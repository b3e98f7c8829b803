"""Digests, content-addressed paths, and base64 payloads."""

from __future__ import annotations

import base64
import gzip

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fan_out(digest: Column) -> Column:
    """``aa/bb/<digest>``."""
    return F.concat_ws("/", F.substring(digest, 1, 2), F.substring(digest, 3, 2), digest)


def base32_sha1(content: Column) -> Column:
    """SHA-1 in base32, the digest of crawl indexes, from the 160 bits by arithmetic: eight characters of every five bytes."""
    hexa = F.sha1(content)
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for block in range(4):
        n = F.conv(F.substring(hexa, block * 10 + 1, 10), 16, 10).cast("bigint")
        out += [F.substring(alphabet, (F.shiftright(n, 35 - 5 * k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for k in range(8)]
    return F.concat(*out)


def same_digest(content: Column, expected: Column) -> Column:
    """Whether content has the index's digest, whatever the letter case and prefix of the latter; null without one."""
    return base32_sha1(content) == F.upper(F.regexp_replace(F.trim(expected), r"^[A-Za-z0-9\-]+:", ""))


def misnamed(path: Column, content: Column) -> Column:
    """Whether the last part of a path is not the SHA-256 of its content."""
    return F.element_at(F.split(path, "/"), -1) != F.sha2(content, 256)


def normal_file_path(path: Column) -> Column:
    """The ``xx/yy/hash`` at the end of a path, '' where it has none."""
    return F.regexp_extract(path, r"([0-9a-fA-F]{2}/[0-9a-fA-F]{2}/[0-9a-fA-F]{10,})$", 1)


def file_hash(name: Column) -> Column:
    """First run of ten or more hex digits in a file name; '' for none."""
    return F.regexp_extract(name, r"([0-9a-f]{10,})", 1)


def base64_ascii(c: Column) -> Column:
    """Base64 text as ASCII, with ? for other bytes; bad base64 is null."""
    return F.regexp_replace(F.decode(F.try_to_binary(c, F.lit("base64")), "ISO-8859-1"), r"[\x80-\xff]", "?")


@F.pandas_udf(T.StringType())
def pack(content: pd.Series) -> pd.Series:
    """Bytes, gzipped and in base64; null stays null."""
    return content.map(lambda b: None if b is None else base64.b64encode(gzip.compress(bytes(b), mtime=0)).decode())


@F.pandas_udf(T.BinaryType())
def unpack(packed: pd.Series) -> pd.Series:
    """The bytes of pack(); null where the text is not such a payload."""

    def one(s: str | None) -> bytes | None:
        try:
            return None if s is None else gzip.decompress(base64.b64decode(s, validate=True))
        except (ValueError, OSError, EOFError):
            return None

    return packed.map(one)
