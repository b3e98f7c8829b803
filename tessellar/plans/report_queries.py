"""Queries over tool reports: each takes its report's text from the rows of a table, whole, and SQL says what must come back.

Where the test tables hold no report of a kind, one is printed for each document, in the tool's layout, with values of its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.common import table
from tessellar.functions import bytes as B
from tessellar.functions.dates import iso_instant, report_date
from tessellar.operators import features as FE
from tessellar.operators import object_graph as OG
from tessellar.operators import reports as RP
from tessellar.operators import status as ST

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def _lines(*parts: Column) -> Column:
    """Lines of a report; null ones are left out."""
    return F.concat(F.concat_ws("\n", *parts), F.lit("\n"))


def _pair(key: str, value: Column, width: int = 16) -> Column:
    return F.concat(F.rpad(F.lit(f"{key}:"), width, " "), value.cast("string"))


def _yes(c: Column) -> Column:
    return F.when(c, "yes").otherwise("no")


# ---- key/value reports and dates


@query(r"SELECT run_id, nullif(regexp_extract(stdout, '(?m)^Title:[ \t]+(.*?)[ \t\r]*$', 1), '') AS title, try_cast(regexp_extract(stdout, '(?m)^Pages:[ \t]+(\d+)', 1) AS int) AS pages FROM tool_runs WHERE stdout IS NOT NULL")
def key_value_report(spark: SparkSession, d: str) -> DataFrame:
    """Title and pages of what every run printed."""
    out = F.col("stdout")
    runs = table(spark, d, "tool_runs").where("stdout IS NOT NULL")
    return runs.select("run_id", RP.key_value(out, "Title").alias("title"), RP.leading_int(RP.key_value(out, "Pages")).alias("pages"))


def _info_text() -> Column:
    printed = F.date_format("extracted_at", "EEE MMM d HH:mm:ss yyyy")
    return _lines(
        _pair("Creator", F.col("extractor")), _pair("Producer", F.col("source")), _pair("CreationDate", F.concat(printed, F.lit(" UTC"))), _pair("ModDate", F.lit("not known")),
        _pair("Tagged", _yes(F.col("pages") > 1)), _pair("Encrypted", F.concat(_yes(F.col("n_chars") > 2000), F.lit(" (print:yes copy:no)"))), _pair("JavaScript", F.lit("no")),
        _pair("Pages", F.concat(F.col("pages").cast("string"), F.lit(" or so"))), _pair("Page rot", F.col("pages") * 90), _pair("PDF version", F.concat(F.lit("1."), F.col("doc_id") % 8)),
    )


@query(
    "SELECT doc_id, source AS producer, nullif(trim(extractor), '') AS creator, pages, '1.' || (doc_id % 8) AS version, coalesce(pages > 1, false) AS tagged, coalesce(n_chars > 2000, false) AS encrypted, NULL::boolean AS optimized, false AS javascript, "
    "coalesce(strftime(extracted_at, '%Y-%m-%dT%H:%M:%SZ'), '') AS created, '' AS modified FROM documents"
)
def info_reports(spark: SparkSession, d: str) -> DataFrame:
    """Typed fields of information reports."""
    r = _documents(spark, d).select("doc_id", RP.info_report(_info_text()).alias("r")).select("doc_id", "r.*")
    plain = (F.col(f"pinfo_{c}").alias(c) for c in ("producer", "creator", "pages", "version", "tagged", "encrypted", "optimized", "javascript"))
    return r.select("doc_id", *plain, iso_instant(F.col("pinfo_created")).alias("created"), iso_instant(F.col("pinfo_modified")).alias("modified"))


_PACKED = {
    "creator": "nullif(trim(extractor), '')", "producer": "source", "created": "strftime(extracted_at, '%a %b %-d %H:%M:%S %Y') || ' UTC'", "modified": "'not known'", "custom_metadata": "NULL::varchar", "metadata_stream": "NULL::varchar",
    "tagged": "CASE WHEN pages > 1 THEN 'yes' ELSE 'no' END", "user_properties": "NULL::varchar", "form": "NULL::varchar", "javascript": "'no'", "pages": "NULL::int",
    "encrypted": "CASE WHEN n_chars > 2000 THEN 'yes' ELSE 'no' END || ' (print:yes copy:no)'", "page_size": "NULL::varchar", "page_rotation": "pages * 90", "optimized": "NULL::varchar", "pdf_version": "'1.' || (doc_id % 8)",
}


@query("SELECT doc_id, " + ", ".join(f"{sql} AS {name}" for name, sql in _PACKED.items()) + " FROM documents")
def info_packs(spark: SparkSession, d: str) -> DataFrame:
    """All sixteen fields of information reports as a table has them; a count of pages that is no number is null."""
    return _documents(spark, d).select("doc_id", FE.info_pack(_info_text()).alias("p")).select("doc_id", "p.*")


@query("SELECT doc_id, CASE WHEN lang IS NOT NULL THEN date_trunc('second', extracted_at) END AS printed_at FROM documents")
def report_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates as tools print them, with blanks or not and in several zones, as timestamps; what is no date is null."""
    zone = F.element_at(F.array(F.lit(""), F.lit(" UTC"), F.lit(" CEST"), F.lit(" PST")), (F.col("doc_id") % 4 + 1).cast("int"))
    day = F.when(F.col("pages") > 1, F.lpad(F.dayofmonth("extracted_at").cast("string"), 2, " ")).otherwise(F.dayofmonth("extracted_at").cast("string"))
    printed = F.concat(F.date_format("extracted_at", "EEE MMM "), day, F.date_format("extracted_at", " HH:mm:ss yyyy"), zone)
    return _documents(spark, d).select("doc_id", report_date(F.when(F.col("lang").isNull(), F.concat(printed, F.lit(" or so"))).otherwise(printed)).alias("printed_at"))


@query("SELECT doc_id, source AS title, nullif(extractor, '') AS author, nullif(lang, '') AS producer, '9 (' || pages || ')' AS creator_tool, NULL::varchar AS tagged FROM documents")
def exif_report(spark: SparkSession, d: str) -> DataFrame:
    """Fields of reports with aligned colons and either line end."""
    line = lambda k, v: F.concat(F.rpad(F.lit(k), 32, " "), F.lit(": "), v)
    text = F.concat_ws("\r\n", F.lit("ExifTool Version Number         : 1"), line("Title", F.col("source")), line("Author", F.when(F.length("extractor") > 0, F.col("extractor"))), line("Producer", F.when(F.length("lang") > 0, F.col("lang"))), line("Creator Tool", F.concat(F.lit("9 ("), F.col("pages"), F.lit(")"))))
    e = _documents(spark, d).select("doc_id", FE.exif_pack(text).alias("e"))
    return e.select("doc_id", F.col("e.exif_title").alias("title"), F.col("e.`dc:creator`").alias("author"), "e.producer", "e.creator_tool", "e.tagged")


# ---- font tables, grammar reports, updates


def _font_text(xpdf: bool) -> Column:
    widths = (30, 12, 3, 3, 3, 4, 9) if xpdf else (30, 12, 14, 3, 3, 3, 9)
    heads = ("name", "type", "emb", "sub", "uni", "prob", "object") if xpdf else ("name", "type", "encoding", "emb", "sub", "uni", "object ID")

    def row(name: Column, kind: Column, encoding: Column, emb: Column, uni: Column) -> Column:
        sub, last = F.lit("no"), F.lit("    12  0")
        cells = (name, kind, emb, sub, uni, F.lit(""), last) if xpdf else (name, kind, encoding, emb, sub, uni, last)
        return F.concat_ws(" ", *(F.rpad(F.coalesce(c, F.lit("")), w, " ") for c, w in zip(cells, widths)))

    first = row(F.concat(F.lit("ABCDEF+"), F.col("source")), F.lit("Type 1C"), F.lit("WinAnsi"), _yes(F.col("pages") > 1), F.lit("no"))
    second = row(F.col("source"), F.lit("TrueType"), F.concat(F.lit("Custom "), F.col("doc_id") % 3), F.lit("yes"), _yes(F.col("n_chars") > 1000))
    ruler = " ".join("-" * w for w in widths)
    return _lines(F.lit(" ".join(h.ljust(w) for h, w in zip(heads, widths))), F.lit(ruler), first, second, F.lit("short"))


_EMB, _UNI = "CASE WHEN pages > 1 THEN 'yes' ELSE 'no-yes' END", "CASE WHEN n_chars > 1000 THEN 'no-yes' ELSE 'no' END"


@query(
    f"SELECT doc_id, ['ABCDEF+' || source, source] AS pf_font_names, ['TrueType', 'Type 1C'] AS pf_font_types, ['Custom ' || (doc_id % 3), 'WinAnsi'] AS pf_font_encodings, {_EMB} AS pf_fonts_embedded, {_UNI} AS pf_fonts_uni, "
    f"['ABCDEF+' || source, source] AS xpf_font_names, ['TrueType', 'Type 1C'] AS xpf_font_types, {_EMB} AS xpf_fonts_embedded, {_UNI} AS xpf_fonts_uni FROM documents WHERE source IS NOT NULL AND pages IS NOT NULL"
)
def font_table(spark: SparkSession, d: str) -> DataFrame:
    """Features of both tools' font tables, columns found by the ruler."""
    rows = _documents(spark, d).where("source IS NOT NULL AND pages IS NOT NULL").select("doc_id", _font_text(False).alias("pdffonts_stdout"), _font_text(True).alias("xpdffonts_stdout"))
    return FE.apply(rows, ["pdffonts", "xpdffonts"]).drop("pdffonts_stdout", "xpdffonts_stdout")


def _grammar_text() -> Column:
    error = lambda c, t: F.when(c, t)
    failed = F.col("doc_id") % 11 == 0
    return _lines(
        F.concat(F.lit("BEGIN "), F.coalesce("source", F.lit("x"))),
        F.when(failed, "Failed to open document"),
        F.concat(F.lit("Header is version PDF 1."), F.col("doc_id") % 8),
        error(F.col("pages") > 1, F.lit("Error: Can't select any link for this")),
        error(F.col("n_chars") > 1000, F.concat(F.lit("Error: bad "), F.coalesce("source", F.lit("x")), F.lit(" (at 12)"))),
        error(F.col("n_chars") > 1500, F.concat(F.lit("Error: bad "), F.coalesce("source", F.lit("x")), F.lit(" (at 99)"))),
        F.when(F.col("pages") > 2, "Warning: odd value"),
        F.when(F.col("doc_id") % 3 == 0, "Traditional trailer dictionary detected").when(F.col("doc_id") % 3 == 1, "XRefStream detected."),
        F.lit("END"),
    )


_GRAMMAR_ROWS = "g AS (SELECT *, coalesce(pages > 1, false) AS link, coalesce(n_chars > 1000, false) AS bad, doc_id % 11 = 0 AS failed, doc_id % 17 = 0 AS late, doc_id % 13 = 0 AS broken FROM documents)"


@query(
    f"WITH {_GRAMMAR_ROWS} SELECT doc_id, CASE WHEN late THEN 'timeout' WHEN broken THEN 'crash' WHEN failed THEN 'fail' WHEN link OR bad THEN 'warn' END AS a_status, "
    "CASE WHEN NOT (late OR broken OR failed) AND (link OR bad) THEN list_filter([CASE WHEN link THEN 'Can''t select any link' END, CASE WHEN bad THEN 'bad ' || coalesce(source, 'x') END], lambda x: x IS NOT NULL) END AS a_warn, "
    "'1.' || (doc_id % 8) AS header_version, (CASE WHEN pages > 2 THEN 1 ELSE 0 END)::int AS warnings, (link::int + bad::int + coalesce(n_chars > 1500, false)::int)::int AS errors, "
    "CASE doc_id % 3 WHEN 0 THEN 'trad' WHEN 1 THEN 'stream' ELSE 'undef' END AS xref FROM g"
)
def grammar_report(spark: SparkSession, d: str) -> DataFrame:
    """Status, findings and facts of grammar reports, of runs that ended well or not."""
    rows = _documents(spark, d).select("doc_id", _grammar_text().alias("arlington_txt"), (F.col("doc_id") % 17 == 0).alias("arlington_timeout"), F.when(F.col("doc_id") % 13 == 0, 1).otherwise(0).alias("arlington_exit_value"))
    made = FE.apply(rows, ["arlington"]).withColumn("f", RP.grammar_facts(F.col("arlington_txt")))
    return made.select("doc_id", "a_status", "a_warn", "f.header_version", "f.warnings", "f.errors", "f.xref")


@query("SELECT doc_id, list_filter(['1.' || (doc_id % 8)], lambda x: true) AS header_version, list_sort(list_distinct(list_filter([CASE WHEN n_chars > 1000 THEN 'bad ' || coalesce(source, 'x') || ' (at 12)' END, CASE WHEN n_chars > 1500 THEN 'bad ' || coalesce(source, 'x') || ' (at 99)' END, CASE WHEN pages > 1 THEN 'Can''t select any link for this' END], lambda x: x IS NOT NULL))) AS errors, coalesce(pages > 2, false) AS has_warning FROM documents")
def grammar_pack(spark: SparkSession, d: str) -> DataFrame:
    """The pattern pack over grammar reports: versions, error texts, any warning."""
    captures, matches = FE.GRAMMAR_PACK
    p = _documents(spark, d).select("doc_id", RP.capture_pack(_grammar_text(), captures, matches).alias("p"))
    return p.select("doc_id", "p.header_version", F.array_sort("p.errors").alias("errors"), "p.has_warning")


@query("SELECT doc_id, CASE WHEN source IS NOT NULL THEN pages END AS pr_updates, nullif(trim(source), '') AS universe, nullif(trim(lang), '') AS universe_validity FROM documents")
def update_counts(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of updates and universes as features."""
    rows = _documents(spark, d).select("doc_id", F.concat(F.col("source"), F.lit(": "), F.col("pages"), F.lit(" of 77")).alias("pr"), F.col("source").alias("universe"), F.col("lang").alias("universe_validity"))
    return FE.apply(rows, ["pdfresurrect", "universe"]).drop("pr")


# ---- JSON reports


@query(
    "SELECT doc_id, CASE WHEN pages > 1 THEN 'can-be-optimized ' ELSE '' END || 'from ' || source AS pc_summary_info, CASE WHEN lang IS NOT NULL THEN [lang] END AS pc_summary_errors, "
    "CASE WHEN n_chars > 1000 THEN ['bad-cmap', 'missing-width'] ELSE ['missing-width'] END AS pc_font_errors FROM documents WHERE source IS NOT NULL AND pages IS NOT NULL"
)
def checker_report(spark: SparkSession, d: str) -> DataFrame:
    """Features of a checker's JSON."""
    summary = F.struct((F.col("pages") > 1).alias("can-be-optimized"), F.array(F.lit("from"), F.col("source")).alias("information"), F.array_compact(F.array("lang")).alias("errors"))
    fonts = F.struct(F.struct(F.array(F.lit("a")).alias("missing-width"), F.when(F.col("n_chars") > 1000, F.array(F.lit("b"))).alias("bad-cmap")).alias("errors"))
    rows = _documents(spark, d).where("source IS NOT NULL AND pages IS NOT NULL").select("doc_id", F.to_json(F.struct(summary.alias("analysis-summary"), fonts.alias("fonts-results"))).alias("pdfchecker_json"))
    return FE.apply(rows, ["pdfchecker"]).drop("pdfchecker_json")


@query(
    "SELECT doc_id, (doc_id % 3)::int AS tk_num_attachments, 1 AS tk_num_macros, CASE WHEN n_chars > 0 THEN (n_chars // 2) / n_chars END::double AS tk_percent_unmapped_unicode, 'application/pdf' AS tk_mime, "
    "'application/pdf; version=1.' || (doc_id % 8) AS tk_mime_detailed, nullif(trim(lang), '') AS tk_lang_detected, nullif(trim(source), '') AS tk_title, NULL::varchar AS tk_extract FROM documents"
)
def metadata_report(spark: SparkSession, d: str) -> DataFrame:
    """Features of metadata lists: the container, what is embedded, inline or attached, and unmapped characters."""
    item = lambda **x: F.struct(*(x.get(k, F.lit(None).cast(t)).alias(n) for k, n, t in (("mime", "Content-Type", "string"), ("title", "dc:title", "string"), ("lang", "tika-eval:lang", "string"), ("chars", "pdf:charsPerPage", "array<string>"), ("odd", "pdf:unmappedUnicodeCharsPerPage", "array<string>"), ("kind", "embeddedResourceType", "string"))))
    root = item(mime=F.concat(F.lit("application/pdf; version=1."), F.col("doc_id") % 8), title=F.col("source"), lang=F.col("lang"), chars=F.array(F.col("n_chars").cast("string"), F.lit("0")), odd=F.array(F.expr("CAST(n_chars DIV 2 AS STRING)")))
    attached = F.transform(F.sequence(F.lit(0), (F.col("doc_id") % 3).cast("int")), lambda i: item(kind=F.when(i == 0, "INLINE").otherwise("ATTACHMENT")))
    rows = _documents(spark, d).select("doc_id", F.to_json(F.concat(F.array(root, item(kind=F.lit("MACRO"))), attached)).alias("tika_json"))
    return FE.apply(rows, ["tika"]).select("doc_id", "tk_num_attachments", "tk_num_macros", "tk_percent_unmapped_unicode", "tk_mime", "tk_mime_detailed", "tk_lang_detected", "tk_title", "tk_extract")


def _graph_text() -> Column:
    lit = F.lit
    catalog = F.struct(lit("/Catalog").alias("/Type"), lit("3 0 R").alias("/Pages"), F.concat(lit("u:"), F.col("source")).alias("/Lang"), F.col("pages").alias("/Count"), F.col("n_chars").alias("/Size"), lit("u:D:20250405222318").alias("/CreationDate"))
    names = F.struct(lit(1).alias("/F1"), lit(2).alias("/TT1_2"), lit(3).alias("/CustomTT1_2"), lit(4).alias("/F1NotASpecKey"), F.rpad(lit("u:x"), 200, "y").alias("/Odd"), F.array(F.struct(lit(90).alias("/Rotate"))).alias("/Kids"))
    stream = F.struct(F.array(lit("/FlateDecode"), lit("4 0 R")).alias("/Filter"), lit("u:secret").alias("/Title"))
    objects = F.struct(
        F.struct(catalog.alias("value")).alias("obj:1 0 R"), F.struct(names.alias("value")).alias("obj:2 0 R"), F.struct(F.struct(stream.alias("dict")).alias("stream")).alias("obj:3 0 R"),
        F.struct(F.when(F.col("doc_id") % 2 == 0, "/DCTDecode").otherwise("/JPXDecode").alias("value")).alias("obj:4 0 R"),
    )
    return F.concat(lit('{"version": 2, "qpdf": [{"jsonversion": 2}, '), F.to_json(objects), lit("]}"))


_LONG = "'/Odd->x' || repeat('y', 93) || '...'"
_FILTER = "'/FlateDecode->' || CASE WHEN doc_id % 2 = 0 THEN '/DCTDecode' ELSE '/JPXDecode' END"


@query(
    "SELECT doc_id, NULL::varchar AS q_status, list_sort(['/Count', '/CreationDate', '/CustomTT1_2', '/F1', '/F1NotASpecKey', '/Filter', '/Kids', '/Lang', '/Odd', '/Pages', '/Rotate', '/Size', '/TT1_2', '/Title', '/Type']) AS q_keys, "
    "['/CustomTT1_2', '/F1NotASpecKey', '/Odd'] AS q_keys_oos, list_sort(['/Kids->/Rotate', '/Kids->ARRAY', '/Filter->ARRAY']) AS q_parent_and_keys, list_sort(['/Catalog->/Pages', '/Catalog->/Lang', '/Catalog->/Count', '/Catalog->/Size', '/Catalog->/CreationDate']) AS q_type_keys, "
    f"list_sort(['/Type->/Catalog', '/Pages->REF', '/Lang->' || source, '/Count->' || pages, '/Size->NUMBER', '/CreationDate->DATE', '/F1->NUMBER', '/TT1_2->NUMBER', '/CustomTT1_2->NUMBER', '/F1NotASpecKey->NUMBER', {_LONG}, '/Rotate->90', '/Title->STRING']) AS q_keys_and_values, "
    f"[{_FILTER}] AS q_filters, 2 AS q_max_filter_count FROM documents WHERE source IS NOT NULL AND pages IS NOT NULL AND n_chars IS NOT NULL"
)
def graph_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of object graphs: keys, those out of specification, key paths, values, filter chains."""
    rows = _documents(spark, d).where("source IS NOT NULL AND pages IS NOT NULL AND n_chars IS NOT NULL").withColumn("g", OG.object_graph(_graph_text()))
    known = ["/Count", "/CreationDate", "/Filter", "/Kids", "/Lang", "/Pages", "/Rotate", "/Size", "/Title", "/Type"]
    return OG.graph_features(rows, "g", known).select("doc_id", "q_status", "q_keys", "q_keys_oos", "q_parent_and_keys", "q_type_keys", "q_keys_and_values", "q_filters", "q_max_filter_count")


@query(f"SELECT doc_id, 'ok' AS status, [{_FILTER}] AS filters, 2 AS max_filter_count FROM documents WHERE source IS NOT NULL AND pages IS NOT NULL AND n_chars IS NOT NULL")
def json_graph(spark: SparkSession, d: str) -> DataFrame:
    """Filter chains of object graphs, references followed."""
    g = _documents(spark, d).where("source IS NOT NULL AND pages IS NOT NULL AND n_chars IS NOT NULL").select("doc_id", OG.object_graph(_graph_text()).alias("g"))
    return g.select("doc_id", "g.status", "g.filters", "g.max_filter_count")


# ---- sectioned reports


@query(
    "SELECT doc_id, true AS parseable, 2 AS n_pages, source AS creator, [regexp_replace(text, '\\r\\n|\\r', chr(10), 'g') || chr(10), 'second' || chr(10)] AS pages, ['odd glyph'] AS warnings, ['font ' || source] AS infos "
    "FROM documents WHERE text IS NOT NULL AND source IS NOT NULL"
)
def dump_report(spark: SparkSession, d: str) -> DataFrame:
    """Sections of keyed dumps with whole texts in them, which can't open a section."""
    key = F.concat(F.lit(" key="), F.col("doc_id").cast("string"))
    head = lambda *x: F.concat(*(F.lit(c) if isinstance(c, str) else c for c in x), key)
    text = _lines(
        F.concat(F.lit("# Random Key: "), F.col("doc_id").cast("string")), head("# Document Loaded"), head("# Number of Pages: 2"), head("## Info"), F.concat(F.lit('{\n "n": 1,\n "Creator": "'), F.col("source"), F.lit('"\n}')),
        head("# Page 1"), F.lit("Warning: odd glyph\nWarning: odd glyph\nInfo: getTextContent: time=3"), head("## Text Content"), F.col("text"),
        head("# Page 2"), F.concat(F.lit("Info: font "), F.col("source")), head("## Text Content"), F.lit("second"), head("# End of Document"), F.lit("Warning: behind the end"),
    )
    r = _documents(spark, d).where("text IS NOT NULL AND source IS NOT NULL").select("doc_id", RP.dump_report(text).alias("r"))
    return r.select("doc_id", "r.parseable", "r.n_pages", F.try_element_at("r.info", F.lit("Creator")).alias("creator"), "r.pages", "r.warnings", "r.infos")


@query(
    "SELECT doc_id, true AS parseable, CASE WHEN pages > 1 THEN 'noncompliant' ELSE 'warnings' END AS validity, n_chars::varchar AS size, 'Embedded' AS flags, NULL::varchar AS errors, CASE WHEN pages > 1 THEN 'bad ' || source END AS noncompliances, "
    "'odd date||odd ' || source AS warnings FROM documents WHERE source > 'date' AND n_chars IS NOT NULL UNION ALL "
    "SELECT doc_id, true, CASE WHEN pages > 1 THEN 'noncompliant' ELSE 'warnings' END, n_chars::varchar, 'Embedded', NULL, CASE WHEN pages > 1 THEN 'bad ' || source END, 'odd ' || source || '||odd date' FROM documents WHERE source < 'date' AND n_chars IS NOT NULL"
)
def profile_report(spark: SparkSession, d: str) -> DataFrame:
    """Verdict and findings of colour profile reports."""
    text = _lines(
        F.lit("Profile:          'x.icc'\n\nHeader\n------"), F.concat(F.lit("Size:             "), F.col("n_chars")), F.lit("Flags             Embedded\nVersion:          2.1\n\nProfile Tags\n------------\nTag  x\n\nValidation Report\n-----------------"),
        F.when(F.col("pages") > 1, "Profile violates ICC specification").otherwise("Profile has warning(s)"), F.lit(""), F.concat(F.lit("Warning! - odd "), F.col("source")), F.when(F.col("pages") > 1, F.concat(F.lit("NonCompliant! - bad "), F.col("source"), F.lit(" "))), F.lit("Warning! - odd date"),
    )
    r = _documents(spark, d).where("source IS NOT NULL AND n_chars IS NOT NULL").select("doc_id", RP.profile_report(text).alias("r"))
    key = lambda k: F.try_element_at("r.header", F.lit(k))
    return r.select("doc_id", "r.parseable", "r.validity", key("Size").alias("size"), key("Flags").alias("flags"), "r.errors", "r.noncompliances", "r.warnings")


# ---- bytes


_BYTES_AT = "CASE WHEN instr(text, '<<') > 0 THEN octet_length(encode(left(text, instr(text, '<<') - 1))) ELSE -1 END"


@query(f"SELECT doc_id, len(regexp_extract_all(text, 'obj'))::int AS n_marks, {_BYTES_AT}::bigint AS header_at FROM documents WHERE text IS NOT NULL")
def byte_facts(spark: SparkSession, d: str) -> DataFrame:
    """Marks and header offset in the bytes of every text."""
    facts = _documents(spark, d).where("text IS NOT NULL").select("doc_id", B.byte_facts(F.col("text").cast("binary"), b"obj", b"<<").alias("f"))
    return facts.select("doc_id", F.size("f.eofs").alias("n_marks"), F.col("f.header_offset").alias("header_at"))


@query(f"SELECT doc_id, len(regexp_extract_all(text, 'obj'))::int AS b_num_eofs, {_BYTES_AT}::bigint AS b_header_offset FROM documents WHERE text IS NOT NULL")
def byte_reports(spark: SparkSession, d: str) -> DataFrame:
    """The same printed as a tool's JSON and read as features."""
    json = B.byte_facts_json(B.byte_facts(F.col("text").cast("binary"), b"obj", b"<<"))
    rows = _documents(spark, d).where("text IS NOT NULL").select("doc_id", json.alias("pdfbytes_stdout"))
    return FE.apply(rows, ["pdfbytes"]).select("doc_id", "b_num_eofs", "b_header_offset")


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/zip' WHEN 2 THEN 'image/png' WHEN 3 THEN 'application/vnd.iccprofile' END AS mime FROM documents WHERE text IS NOT NULL")
def magic_mimes(spark: SparkSession, d: str) -> DataFrame:
    """Mimes by magic numbers of contents that begin as files of several kinds."""
    begin = F.element_at(F.array(*(F.lit(bytearray(b)) for b in (b"%PDF-1.7 ", b"PK\x03\x04", b"\x89PNG\r\n\x1a\n", b"\0" * 36 + b"acsp", b"plain "))), (F.col("doc_id") % 5 + 1).cast("int"))
    return _documents(spark, d).where("text IS NOT NULL").select("doc_id", B.magic_mime(F.concat(begin, F.col("text").cast("binary"))).alias("mime"))


@query(
    "WITH c AS (SELECT doc_id, text || '%%EOF' || source || '%%EOF' AS earlier FROM documents WHERE text IS NOT NULL AND source IS NOT NULL) "
    "SELECT doc_id, ((length(earlier) - length(replace(earlier, '%%EOF', ''))) // 5)::bigint AS n_versions, octet_length(encode(earlier))::int AS last_length, sha256(earlier) AS last_digest FROM c"
)
def file_versions(spark: SparkSession, d: str) -> DataFrame:
    """Earlier versions of incrementally saved files: their number, and the last one's bytes."""
    content = F.concat(F.col("text"), F.lit("%%EOF"), F.col("source"), F.lit("%%EOFfinal%%EOF")).cast("binary")
    files = _documents(spark, d).where("text IS NOT NULL AND source IS NOT NULL").select("doc_id", content.alias("content"))
    v = B.versions(files.withColumn("f", B.byte_facts(F.col("content"))), "content", F.col("f.eofs"))
    sized = v.select("doc_id", F.length("version_content").alias("n"), F.sha2("version_content", 256).alias("digest"))
    return sized.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_versions"), F.max("n").alias("last_length"), F.max_by("digest", "n").alias("last_digest"))


# ---- outcomes


@query(
    "SELECT run_id, CASE WHEN timeout THEN 3 WHEN exit_value <> 0 THEN 9 WHEN stdout = '' THEN 4 WHEN length(stderr) > 5 THEN 1 WHEN stdout IS NULL THEN 14 ELSE 0 END AS code FROM tool_runs"
)
def pipe_codes(spark: SparkSession, d: str) -> DataFrame:
    """Pseudo exit codes of the outcome of every run."""
    outcome = (
        F.when(F.col("timeout"), "TIMEOUT").when(F.col("exit_value") != 0, "UNSPECIFIED_CRASH").when(F.col("stdout") == "", "EMPTY_OUTPUT").when(F.length("stderr") > 5, "PARSE_SUCCESS_WITH_EXCEPTION").when(F.col("stdout").isNull(), "none of these").otherwise("PARSE_SUCCESS")
    )
    return table(spark, d, "tool_runs").select("run_id", ST.pipe_code(outcome).alias("code"))


_COMPARED_SQL = ", ".join(f"{sql} AS {to}" for to, sql in (("tk_num_tokens", "n_chars::varchar"), ("mt_num_tokens", "coalesce(pages::varchar, '7')"), ("tk_oov", "NULL::varchar"), ("tk_lang_detected", "nullif(trim(lang), '')"), ("overlap_tk_v_mt", "'0.5'")))


@query(f"SELECT doc_id, {_COMPARED_SQL} FROM documents")
def comparison_features(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a text comparison as features; no number and blank give none, and what is set stays."""
    rows = _documents(spark, d).select(
        "doc_id", F.col("n_chars").cast("string").alias("num_tokens_0"), F.lit("NaN").alias("oov_0"), F.col("lang").alias("detected_lang_0"), F.lit("7").alias("num_tokens_1"), F.col("pages").cast("string").alias("mt_num_tokens"), F.lit("0.5").alias("overlap_tool_0_v_1")
    )
    made = FE.apply(rows, ["comparison"])
    return made.select("doc_id", "tk_num_tokens", "mt_num_tokens", "tk_oov", "tk_lang_detected", "overlap_tk_v_mt")
