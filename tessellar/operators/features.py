"""Feature mappers: functions from wide rows to wide rows, by name, and the feature documents that they make together.

A mapper reads columns of the wide tool view and adds feature columns; one whose columns a row set lacks adds nothing. Mappers
are applied in the order given; a feature that an earlier one set is kept. Blank features are null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.functions.strings import escape_controls, non_blank
from tessellar.operators import object_graph as OG
from tessellar.operators import reports as RP
from tessellar.operators.status import fill_absent, roll_up

Mapper = Callable[[DataFrame], DataFrame]
MAPPERS: dict[str, Mapper] = {}

# Features that are columns as they stand.
PASSED_ON = {
    "cpu": ("cpu_warn",), "caradoc": ("cd", "cd_warn"), "clamav": ("clamav",), "mutool": ("mc_warn", "mt_warn"), "pdfminer": ("pmd_warn", "pmt_warn"), "universe": ("universe", "universe_validity"),
    "profile": ("fname", "shasum_256", "size", "collection", "host_location", "country", "tld", "detected_mime", "url"),
}
# Columns of the text comparison and the features that they fill.
COMPARED = {
    "num_tokens_0": "tk_num_tokens", "oov_0": "tk_oov", "detected_lang_0": "tk_lang_detected", "num_tokens_1": "mt_num_tokens", "oov_1": "mt_oov", "detected_lang_1": "mt_lang_detected",
    "num_tokens_2": "ptt_num_tokens", "oov_2": "ptt_oov", "detected_lang_2": "ptt_lang_detected", "overlap_tool_0_v_1": "overlap_tk_v_mt", "overlap_tool_0_v_2": "overlap_tk_v_ptt", "overlap_tool_1_v_2": "overlap_mt_v_ptt",
}
# Pattern packs of further tools, and the types that their table has.
INFO_PACK = {
    "creator": "Creator", "producer": "Producer", "created": "CreationDate", "modified": "ModDate", "custom_metadata": "Custom Metadata", "metadata_stream": "Metadata Stream", "tagged": "Tagged", "user_properties": "UserProperties",
    "form": "Form", "javascript": "JavaScript", "pages": "Pages", "encrypted": "Encrypted", "page_size": "Page size", "page_rotation": "Page rot", "optimized": "Optimized", "pdf_version": "PDF version",
}
INFO_TYPES = {"pages": "int", "page_rotation": "int"}
EXIF_PACK = {"exif_title": "Title", "dc:creator": "Author", "producer": "Producer", "creator_tool": "Creator Tool", "tagged": "Tagged PDF"}
GRAMMAR_PACK = (
    {"latest_version": r"Latest Arlington feature was PDF (\d\.\d)", "header_version": r"Header is version PDF (\d\.\d)", "warnings": r"Warning: ([^:\r\n\x1b]{0,256})", "errors": r"Error: ([^:\r\n\x1b]{0,256})"},
    {"has_warning": "Warning: ", "has_error": "Error: "},
)


def register(name: str):
    def add(f: Mapper) -> Mapper:
        MAPPERS[name] = f
        return f

    return add


def apply(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with the features of the named mappers, in order."""
    for n in names:
        rows = MAPPERS[n](rows)
    return rows


def info_pack(text: Column) -> Column:
    """Sixteen typed fields of a document information report with ISO dates."""
    v = lambda key: RP.key_value(text, key)
    return F.struct(*(v(key).try_cast(INFO_TYPES[n]).alias(n) if n in INFO_TYPES else F.substring(v(key), 1, 512).alias(n) for n, key in INFO_PACK.items()))


def exif_pack(text: Column) -> Column:
    """Fields of a ``Name      : value`` report."""
    return F.struct(*(RP.capture_first(text, rf"(?m)^{key}\s+: ([^\r\n]+)").alias(n) for n, key in EXIF_PACK.items()))


def _added(rows: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """New features; those that are set already stay."""
    return rows.withColumns({n: F.coalesce(F.col(n), c) if n in rows.columns else c for n, c in new.items()})


def _pass_on(columns: Sequence[str]) -> Mapper:
    def run(rows: DataFrame) -> DataFrame:
        out = rows.withColumns({c: non_blank(F.col(c).cast("string")) for c in columns if c in rows.columns})
        return out.withColumn("original_fname", F.col("fname")) if "fname" in columns and "fname" in rows.columns else out

    return run


for _name, _columns in PASSED_ON.items():
    MAPPERS[_name] = _pass_on(_columns)


@register("status")
def status(rows: DataFrame) -> DataFrame:
    return roll_up(rows)


@register("comparison")
def comparison(rows: DataFrame) -> DataFrame:
    return fill_absent(rows, {to: src for src, to in COMPARED.items() if src in rows.columns})


def _struct(rows: DataFrame, column: str, make: Callable[[Column], Column], names: Mapping[str, str]) -> DataFrame:
    """Features from the fields of a struct made of a column: field -> feature."""
    if column not in rows.columns:
        return rows
    s = rows.withColumn("__s", make(F.col(column)))
    return _added(s, {to: F.col("__s").getField(f) for f, to in names.items()}).drop("__s")


@register("pdfinfo")
def pdfinfo(rows: DataFrame) -> DataFrame:
    out = _struct(rows, "pinfo_stdout", RP.info_report, {n: n for n, _ in RP.INFO_FIELDS.values()})
    return _added(out, {"pinfo": non_blank(F.col("pinfo_stdout"))}) if "pinfo_stdout" in rows.columns else out


@register("pdfresurrect")
def pdfresurrect(rows: DataFrame) -> DataFrame:
    return _added(rows, {"pr_updates": RP.update_count(F.col("pr"))}) if "pr" in rows.columns else rows


@register("pdffonts")
def pdffonts(rows: DataFrame) -> DataFrame:
    names = {"names": "pf_font_names", "types": "pf_font_types", "encodings": "pf_font_encodings", "embedded": "pf_fonts_embedded", "unicode": "pf_fonts_uni"}
    return _struct(rows, "pdffonts_stdout", RP.font_table, names)


@register("xpdffonts")
def xpdffonts(rows: DataFrame) -> DataFrame:
    names = {"names": "xpf_font_names", "types": "xpf_font_types", "embedded": "xpf_fonts_embedded", "unicode": "xpf_fonts_uni"}
    return _struct(rows, "xpdffonts_stdout", lambda c: RP.font_table(c, RP.XPDF_FONT_COLUMNS), names)


@register("pdfbytes")
def pdfbytes(rows: DataFrame) -> DataFrame:
    return _struct(rows, "pdfbytes_stdout", RP.byte_report, {n: n for n in ("b_eofs", "b_num_eofs", "b_preheader", "b_header_offset")})


@register("pdfchecker")
def pdfchecker(rows: DataFrame) -> DataFrame:
    return _struct(rows, "pdfchecker_json", RP.checker_report, {n: n for n in ("pc_summary_info", "pc_summary_errors", "pc_font_errors")})


@register("tika")
def tika(rows: DataFrame) -> DataFrame:
    """Metadata features; without a readable metadata list the tool's own status is 'missing'."""
    if "tika_json" not in rows.columns:
        return rows
    fields = [f.name for f in RP._METADATA.fields]
    out = _struct(rows, "tika_json", RP.metadata_report, {n: n for n in fields})
    return _added(out, {"tk_extract": F.when(F.col("tika_json").isNull(), "missing")})


@register("arlington")
def arlington(rows: DataFrame) -> DataFrame:
    if "arlington_txt" not in rows.columns:
        return rows
    s = rows.withColumn("__s", RP.grammar_status(F.col("arlington_txt"), F.col("arlington_timeout"), F.col("arlington_exit_value")))
    return _added(s, {"a_status": F.col("__s.a_status"), "a_warn": F.col("__s.a_warn")}).drop("__s")


@register("qpdf")
def qpdf(rows: DataFrame) -> DataFrame:
    if "qpdf_json" not in rows.columns:
        return rows
    return OG.graph_features(rows.withColumn("__g", OG.object_graph(F.col("qpdf_json"))), "__g").drop("__g")


def with_extracts(rows: DataFrame, extracts: Mapping[str, DataFrame]) -> DataFrame:
    """``rows`` (column path) joined with stores of extracts: name -> (path, text), as column ``name``; the join that mappers would else do one by one."""
    for name, df in extracts.items():
        rows = rows.join(df.select("path", F.col("text").alias(name)).groupBy("path").agg(F.max(name).alias(name)), "path", "left")
    return rows


def tidy(rows: DataFrame) -> DataFrame:
    """Feature documents as an index takes them: control characters spelled out, blanks as null."""
    new = {}
    for f in rows.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "string":
            new[f.name] = non_blank(escape_controls(F.col(f.name)))
        elif kind == "array<string>":
            new[f.name] = F.transform(F.col(f.name), escape_controls)
    return rows.withColumns(new)


def collapse(c: Column) -> Column:
    """A list of one as its element, longer ones as JSON: the shape of exported documents only; inside, lists stay lists."""
    return F.when(F.size(c) == 1, F.get(c, F.lit(0))).when(F.size(c) > 1, F.to_json(c))


def map_files(files: DataFrame, process: Callable[[str, bytes], Sequence], schema: str) -> DataFrame:
    """A Python function over files (path, content), one row each."""
    columns = [x.strip().split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([process(p, b"" if c is None else bytes(c)) for p, c in zip(b["path"], b["content"])], columns=columns)

    return files.select("path", "content").mapInPandas(run, schema)


def parse_files(files: DataFrame, parse: Callable[[str, bytes], list[Mapping[str, Sequence[str]]]]) -> DataFrame:
    """(path, part, metadata): what a parser finds in each file, the container first, as maps of lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, k, {n: list(v) for n, v in m.items()}) for p, c in zip(b["path"], b["content"]) for k, m in enumerate(parse(p, b"" if c is None else bytes(c)))]
            yield pd.DataFrame(rows, columns=["path", "part", "metadata"])

    return files.select("path", "content").mapInPandas(run, "path string, part int, metadata map<string,array<string>>")


def of_mime(files: DataFrame, mime: Column, part: str) -> DataFrame:
    """Files whose mime contains ``part``."""
    return files.where(mime.contains(part))
