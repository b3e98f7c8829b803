"""Facts of raw bytes: pattern offsets, header offset, versions of incrementally saved files, magic numbers."""

from __future__ import annotations

import base64
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EOF, HEADER = b"%%EOF", b"%PDF-"
#: Bytes before the header that are kept.
PREHEADER = 10_000
# Magic numbers (offset, bytes, mime); an offset may be a range.
MAGIC = (
    (0, b"%PDF-", "application/pdf"), (0, b"\x89PNG\r\n\x1a\n", "image/png"), (0, b"\xff\xd8\xff", "image/jpeg"), (0, b"PK\x03\x04", "application/zip"), (36, b"acsp", "application/vnd.iccprofile"),
    (0, b"\x01\x00\x04", "application/x-pdf-internal-fontfile3"), (0, b"true\x00", "application/x-font-ttf-unk"), (0, b"%!FontType1", "application/x-font-postscript-type1"),
    *((k, b"<?xpacket begin", "application/x-xmp-packet") for k in range(5)),
)


def pattern_ends(content: bytes, pattern: bytes) -> list[int]:
    """Offsets just after each occurrence, which may not overlap."""
    out, at = [], content.find(pattern)
    while at >= 0:
        at += len(pattern)
        out.append(at)
        at = content.find(pattern, at)
    return out


def byte_facts(content: Column, eof: bytes = EOF, header: bytes = HEADER) -> Column:
    """struct<eofs, header_offset, preheader>: ends of all EOF marks, offset of the header (-1: none), and the bytes before it."""

    @F.pandas_udf(T.StructType([T.StructField("eofs", T.ArrayType(T.LongType())), T.StructField("header_offset", T.LongType()), T.StructField("preheader", T.BinaryType())]))
    def run(contents: pd.Series) -> pd.DataFrame:
        rows = []
        for b in contents:
            b = b"" if b is None else bytes(b)
            at = b.find(header)
            rows.append((pattern_ends(b, eof), at, b[: min(at, PREHEADER)] if at > 0 else b""))
        return pd.DataFrame(rows, columns=["eofs", "header_offset", "preheader"])

    return run(content)


def byte_facts_json(facts: Column) -> Column:
    """The facts as JSON, the preheader in base64."""
    return F.to_json(F.struct(F.base64(facts["preheader"]).alias("preheader"), facts["eofs"].alias("eofs"), facts["header_offset"].alias("header-offset")))


def versions(files: DataFrame, content: str, eofs: Column) -> DataFrame:
    """Earlier versions of incrementally saved files: one row per EOF mark but the last, with the bytes up to it."""
    earlier = files.select("*", F.posexplode(F.slice(eofs, F.lit(1), F.greatest(F.size(eofs) - 1, F.lit(0)))).alias("version", "end"))
    return earlier.withColumn("version_content", F.substring(F.col(content), F.lit(1), F.col("end").cast("int")))


def magic_mime(content: Column, rules: Sequence[tuple[int, bytes, str]] = MAGIC) -> Column:
    """Mime of the first rule whose bytes stand at its offset; null for none."""
    out = F.lit(None).cast("string")
    for at, magic, mime in reversed(rules):
        out = F.when(F.substring(content, at + 1, len(magic)) == F.unbase64(F.lit(base64.b64encode(magic).decode())), mime).otherwise(out)
    return out
