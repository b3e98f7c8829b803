"""Features from the reports that analysers print: table-driven patterns, key/value reports, font tables, sectioned dumps, JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessellar.functions.dates import report_date
from tessellar.functions.digests import base64_ascii
from tessellar.functions.strings import escape_controls, leading_int, mime_essence, non_blank


def lines(text: Column) -> Column:
    return F.split(text, r"\r\n|\r|\n")


def capture_lines(text: Column, pattern: str, group: int = 1) -> Column:
    """Distinct captures of a pattern, the first match of each line, in order of appearance."""
    got = F.transform(lines(text), lambda x: F.when(x.rlike(pattern), F.regexp_extract(x, pattern, group)))
    return F.array_distinct(F.array_compact(got))


def any_line(text: Column, pattern: str) -> Column:
    """Whether any line matches."""
    return F.exists(lines(text), lambda x: x.rlike(pattern))


def capture_pack(text: Column, captures: Mapping[str, str], matches: Mapping[str, str]) -> Column:
    """Struct of a table of patterns: ``captures`` give lists of captures, ``matches`` booleans."""
    return F.struct(*(capture_lines(text, p).alias(n) for n, p in captures.items()), *(any_line(text, p).alias(n) for n, p in matches.items()))


def capture_first(text: Column, pattern: str) -> Column:
    """First match in the whole text, null for none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


# Phrases of grammar reports.
GRAMMAR_CAPTURES = {"latest_version": r"Latest Arlington feature was PDF (\d\.\d)", "header_version": r"Header is version PDF (\d\.\d)", "doc_catalog_version": r"Document Catalog/Version is PDF (\d\.\d)"}
GRAMMAR_COUNTS = {"warnings": "Warning: ", "errors": "Error: "}
GRAMMAR_XREF = {"trad": "Traditional trailer dictionary detected", "stream": r"XRefStream detected\."}
GRAMMAR_FAILED, GRAMMAR_PHRASES = "Failed to open document", ("Can't select any link", "object validated in two different contexts")


def grammar_facts(text: Column) -> Column:
    """Struct of versions, counts of warnings and errors, and the kind of cross-reference table: trad, stream or undef."""
    xref = F.lit("undef")
    for kind, p in reversed(GRAMMAR_XREF.items()):
        xref = F.when(text.rlike(p), kind).otherwise(xref)
    return F.struct(*(capture_first(text, p).alias(n) for n, p in GRAMMAR_CAPTURES.items()), *(F.regexp_count(text, F.lit(p)).alias(n) for n, p in GRAMMAR_COUNTS.items()), xref.alias("xref"))


def grammar_status(text: Column, timeout: Column, exit_value: Column) -> Column:
    """Struct<a_status, a_warn> of a grammar report.

    A timed out run is 'timeout', one with another exit value than 0 (or none) 'crash', a null text 'missing_extract'. A report whose
    second line says that the document couldn't be opened is 'fail'; one with error lines 'warn' with their distinct texts, sorted.
    """
    ls = lines(text)

    def kind(x: Column) -> Column:
        out = F.when(F.regexp_extract(x, r"Error: ([^(]+)", 1) != "", escape_controls(F.trim(F.regexp_extract(x, r"Error: ([^(]+)", 1)))).otherwise(escape_controls(F.trim(x)))
        for p in reversed(GRAMMAR_PHRASES):
            out = F.when(x.contains(p), p).otherwise(out)
        return out

    errors = F.array_sort(F.array_distinct(F.transform(F.filter(F.slice(ls, 2, 2_000_000_000), lambda x: x.startswith("Error: ")), kind)))
    failed = F.coalesce(F.get(ls, F.lit(1)).contains(GRAMMAR_FAILED), F.lit(False))
    ran = ~F.coalesce(timeout, F.lit(False)) & (F.coalesce(exit_value, F.lit(-1)) == 0)
    warn = F.when(ran & ~failed & (F.size(errors) > 0), errors)
    status = F.when(F.coalesce(timeout, F.lit(False)), "timeout").when(~ran, "crash").when(text.isNull(), "missing_extract").when(failed, "fail").when(warn.isNotNull(), "warn")
    return F.struct(status.alias("a_status"), warn.alias("a_warn"))


# Keys of document information reports, target fields and types.
INFO_FIELDS = {
    "Producer": ("pinfo_producer", "text"), "Creator": ("pinfo_creator", "text"), "PDF version": ("pinfo_version", "text"), "Pages": ("pinfo_pages", "int"), "Tagged": ("pinfo_tagged", "yes"),
    "Optimized": ("pinfo_optimized", "yes"), "JavaScript": ("pinfo_javascript", "yes"), "Encrypted": ("pinfo_encrypted", "yes"), "CreationDate": ("pinfo_created", "date"), "ModDate": ("pinfo_modified", "date"),
}


def key_value(text: Column, key: str) -> Column:
    """Value of a ``Key:   value`` line, the first of that key; null where there is none or it is blank."""
    v = F.regexp_extract(text, rf"(?m)^{re.escape(key)}:[ \t]+(.*?)[ \t\r]*$", 1)
    return non_blank(v)


def info_report(text: Column, fields: Mapping[str, tuple[str, str]] = INFO_FIELDS) -> Column:
    """Typed struct of a key/value report: texts, leading integers, booleans that begin with yes, and dates."""
    kinds = {"text": lambda v: v, "int": leading_int, "yes": lambda v: v.startswith("yes"), "date": report_date}
    return F.struct(*(kinds[kind](key_value(text, key)).alias(name) for key, (name, kind) in fields.items()))


def update_count(text: Column) -> Column:
    """First number after a colon and a blank."""
    return F.regexp_extract(text, r": (\d+)", 1).try_cast("int")


#: Columns of the two font tables; the other columns of a table are skipped.
FONT_COLUMNS = ("name", "type", "encoding", "emb", "sub", "uni", "object")
XPDF_FONT_COLUMNS = ("name", "type", "emb", "sub", "uni", "prob", "object")


def font_table(text: Column, columns: tuple[str, ...] = FONT_COLUMNS) -> Column:
    """Struct of font names, types, encodings (sorted, distinct) and the embedded and unicode flags (no, yes, no-yes or '').

    Column widths are those of the dashes in the second line; lines shorter than all columns together are skipped.
    """
    ls = F.filter(F.split(text, r"[\r\n]+"), lambda x: F.lit(True))
    widths = F.transform(F.split(F.rtrim(F.coalesce(F.get(ls, F.lit(1)), F.lit(""))), " "), lambda d: F.length(d))
    total = F.aggregate(widths, F.lit(0), lambda a, w: a + w)
    rows = F.filter(F.slice(ls, 3, 2_000_000_000), lambda x: F.length(x) >= total)

    def values(name: str) -> Column:
        i = columns.index(name)
        start = F.aggregate(F.slice(widths, 1, i) if i else F.array().cast("array<int>"), F.lit(1), lambda a, w: a + w + 1)
        return F.array_sort(F.array_distinct(F.transform(rows, lambda x: escape_controls(F.trim(x.substr(start, F.coalesce(F.get(widths, F.lit(i)), F.lit(0))))))))

    def flag(name: str) -> Column:
        v = values(name)
        return F.concat_ws("-", F.when(F.array_contains(v, "no"), "no"), F.when(F.array_contains(v, "yes"), "yes"))

    enc = [values("encoding").alias("encodings")] if "encoding" in columns else []
    return F.when(F.size(ls) >= 2, F.struct(values("name").alias("names"), values("type").alias("types"), *enc, flag("emb").alias("embedded"), flag("uni").alias("unicode")))


def byte_report(text: Column) -> Column:
    """Struct<b_eofs, b_num_eofs, b_preheader, b_header_offset> of a byte-facts JSON; null where it doesn't parse."""
    j = F.from_json(text, "preheader string, eofs array<bigint>, `header-offset` bigint")
    return F.when(j["eofs"].isNotNull(), F.struct(j["eofs"].alias("b_eofs"), F.size(j["eofs"]).alias("b_num_eofs"), escape_controls(F.coalesce(base64_ascii(j["preheader"]), F.lit(""))).alias("b_preheader"), j["header-offset"].alias("b_header_offset")))


def checker_report(text: Column) -> Column:
    """Struct<pc_summary_info, pc_summary_errors, pc_font_errors> of a checker's JSON; blanks and empty lists are null."""
    j = F.from_json(text, "`analysis-summary` struct<`can-be-optimized`:boolean,information:array<string>,errors:array<string>>, `fonts-results` struct<errors:map<string,string>>")
    s = j["analysis-summary"]
    info = F.concat_ws(" ", F.when(s["can-be-optimized"], "can-be-optimized"), s["information"])
    keys = F.map_keys(j["fonts-results"]["errors"])
    return F.struct(
        F.when(s["information"].isNotNull(), non_blank(info)).alias("pc_summary_info"),
        F.when(F.size(s["errors"]) > 0, s["errors"]).alias("pc_summary_errors"),
        F.when(F.size(keys) > 0, F.array_sort(keys)).alias("pc_font_errors"),
    )


def metadata_report(text: Column) -> Column:
    """Features of a metadata list in JSON (first the container, then what it embeds; values are strings or lists of strings).

    Attachments are all but inline ones and macros; the unmapped share is a ratio of sums, null without characters.
    """
    @F.pandas_udf(_METADATA)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_metadata(t) for t in texts], columns=[f.name for f in _METADATA.fields])

    return run(text)


# Metadata keys and target fields.
METADATA_FIELDS = {
    "tk_creator_tool": "xmp:CreatorTool", "tk_producer": "pdf:docinfo:producer", "tk_oov": "tika-eval:oov", "tk_num_tokens": "tika-eval:numTokens", "tk_lang_detected": "tika-eval:lang",
    "tk_created": "dcterms:created", "tk_modified": "dcterms:modified", "tk_mime_detailed": "Content-Type", "tk_format": "dc:format", "tk_title": "dc:title", "tk_subject": "dc:subject",
    "tk_pdf_version": "pdf:PDFVersion", "tk_pdfa_version": "pdfa:PDFVersion", "tk_pdf_extension_version": "pdf:PDFExtensionVersion", "tk_action_trigger": "pdf:actionTrigger",
}
_METADATA = T.StructType([T.StructField("tk_num_attachments", T.IntegerType()), T.StructField("tk_num_macros", T.IntegerType()), T.StructField("tk_percent_unmapped_unicode", T.DoubleType()), T.StructField("tk_mime", T.StringType()), *(T.StructField(n, T.StringType()) for n in METADATA_FIELDS)])


def _metadata(text: str | None) -> tuple:
    none = (None,) * len(_METADATA.fields)
    try:
        items = json.loads(text) if text else None
    except ValueError:
        return none
    if not isinstance(items, list) or not items or not all(isinstance(m, dict) for m in items):
        return none

    def every(m: dict, k: str) -> list[str]:
        v = m.get(k)
        return [] if v is None else [str(x) for x in v] if isinstance(v, list) else [str(v)]

    def first(m: dict, k: str) -> str | None:
        v = every(m, k)
        return v[0] if v and v[0].strip() else None

    root, kinds = items[0], [first(m, "embeddedResourceType") for m in items]
    inline, macros = kinds.count("INLINE"), kinds.count("MACRO")
    number = lambda k: sum(int(x) for x in every(root, k) if re.fullmatch(r"-?\d+", x))
    chars = number("pdf:charsPerPage")
    mime = first(root, "Content-Type")
    return (len(items) - 1 - inline - macros, macros, number("pdf:unmappedUnicodeCharsPerPage") / chars if chars > 0 else None, mime.split(";")[0] if mime else None, *(first(root, k) for k in METADATA_FIELDS.values()))


# ---- sectioned dump with a random key


_DUMP = T.StructType([T.StructField("parseable", T.BooleanType()), T.StructField("n_pages", T.IntegerType()), T.StructField("info", T.MapType(T.StringType(), T.StringType())), T.StructField("pages", T.ArrayType(T.StringType())), T.StructField("warnings", T.ArrayType(T.StringType())), T.StructField("infos", T.ArrayType(T.StringType()))])


def dump_report(text: Column) -> Column:
    """Struct<parseable, n_pages, info, pages, warnings, infos> of a dump whose section lines end in a random key.

    Only lines that end in `` key=<the key>`` open sections, so that text from a document can't. Warnings and infos inside pages are
    distinct in order of appearance; timing lines are no infos.
    """

    @F.pandas_udf(_DUMP)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_dump(t) for t in texts], columns=[f.name for f in _DUMP.fields])

    return run(text)


def _dump(text: str | None) -> tuple:
    m = re.search(r"# Random Key: (\d+)", text or "")
    if not m:
        return False, None, {}, [], [], []
    suffix = f" key={m[1]}"
    sections: list[tuple[str, list[str]]] = []
    for line in re.split(r"\r\n|\r|\n", text[m.end() :]):
        if line.startswith("#") and line.rstrip().endswith(suffix):
            sections.append((line.rstrip()[: -len(suffix)].rstrip(), []))
            if sections[-1][0].startswith("# End of Document"):
                break
        elif sections:
            sections[-1][1].append(line)
    n_pages, info, pages, warnings, infos, page = None, {}, [], {}, {}, False
    for head, body in sections:
        if head.startswith(("## Info", "## Metadata")):
            at = next((k for k, x in enumerate(body) if x.strip() == "{"), None)
            try:
                found = json.loads("\n".join(body[at:])) if at is not None else {}
            except ValueError:
                found = {}
            info |= {k: v if isinstance(v, str) else json.dumps(v) for k, v in found.items()}
        elif n := re.match(r"# Number of Pages: (\d+)", head):
            n_pages = int(n[1])
        elif re.match(r"# Page \d+", head):
            pages.append("")
            page = True
            for x in body:
                if x.startswith("Warning: "):
                    warnings[x[9:]] = None
                elif x.startswith("Info: ") and "getTextContent: time=" not in x:
                    infos[x[6:]] = None
        elif head.startswith("## Text Content") and page:
            pages[-1] = "".join(x + "\n" for x in body)
    return True, n_pages, info, pages, list(warnings), list(infos)


# ---- colour profile validation


_VERDICTS = (("valid", "Profile is valid"), ("noncompliant", "Profile violates ICC specification"), ("warnings", r"Profile has warning\(s\)"), ("errors", r"Profile has Critical Error\(s\)"))


def profile_report(text: Column) -> Column:
    """Struct<parseable, validity, header, errors, noncompliances, warnings> of a colour profile validator's report.

    The last verdict line counts, and validity is null without one. Findings are distinct, sorted and joined by two pipes, null for none.
    """
    report = F.regexp_extract(text, r"(?s)(?:^|\n)[ \t]*Validation Report[ \t\r]*\n(.*)", 1)
    ls = lines(report)

    def verdict(x: Column) -> Column:
        out = F.lit(None).cast("string")
        for kind, p in reversed(_VERDICTS):
            out = F.when(x.rlike(p), kind).otherwise(out)
        return out

    found = F.array_compact(F.transform(ls, verdict))

    def joined(pattern: str) -> Column:
        v = F.array_sort(F.array_distinct(F.array_compact(F.transform(ls, lambda x: F.when(x.rlike(pattern), F.trim(F.regexp_extract(x, pattern, 1)))))))
        return F.when(F.size(v) > 0, F.array_join(v, "||"))

    head = F.regexp_extract(text, r"(?s)(?:^|\n)[ \t]*Header[ \t\r]*\n(.*?)(?:\n[ \t\r]*\n|$)", 1)
    pattern = r"^\s*(Flags\s|[^:]+):?\s+(.*)$"
    entries = F.transform(F.filter(lines(head), lambda x: x.rlike(pattern)), lambda x: F.struct(F.regexp_replace(F.regexp_extract(x, pattern, 1), " ", "").alias("k"), F.regexp_extract(x, pattern, 2).alias("v")))
    # a later line of the same key wins
    last = F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda a, e: F.map_concat(F.map_filter(a, lambda k, v: k != e["k"]), F.create_map(e["k"], e["v"])))
    return F.struct(
        F.coalesce(text.rlike(r"Profile:\s+'[^']+"), F.lit(False)).alias("parseable"),
        F.get(found, F.size(found) - 1).alias("validity"),
        last.alias("header"),
        joined(r"^Error! [ -]*(.*)").alias("errors"),
        joined(r"^NonCompliant! - (.*)").alias("noncompliances"),
        joined(r"^Warning! - (.*)").alias("warnings"),
    )


def mime_of(detailed: Column) -> Column:
    return mime_essence(detailed)
