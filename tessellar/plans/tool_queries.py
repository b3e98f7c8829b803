"""Queries over tool runs and profiles: status, roll-up, reports, bytes, processes."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.common import scratch, table
from tessellar.functions import digests as D
from tessellar.functions.strings import store_text
from tessellar.operators import object_graph as OG
from tessellar.operators import processes as P
from tessellar.operators import relational as R
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


#: Tools of the wide view; other_tools names those of the run table that are not known.
WIDE = ST.TOOLS


def _status_sql(t: ST.Tool) -> str:
    p = f"{t.prefix}r"
    enc = f"WHEN {p}.{t.stream} LIKE '{t.like}' THEN 'encrypted' " if t.like else ""
    return f"CASE {enc}WHEN {p}.path IS NULL THEN 'missing' WHEN {p}.timeout THEN 'timeout' WHEN {p}.exit_value <> 0 THEN 'crash' WHEN length({p}.stderr) > 5 THEN 'warn' ELSE 'success' END"


_LATEST = "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tool, path ORDER BY started_at DESC NULLS LAST, run_id DESC NULLS LAST) AS r FROM tool_runs WHERE path IS NOT NULL) WHERE r = 1)"
_JOINS = " ".join(f"LEFT JOIN latest {t.prefix}r ON {t.prefix}r.tool = '{t.table}' AND {t.prefix}r.path = a.path" for t in WIDE)
_WIDE_SQL = f"WITH {_LATEST}, anchor AS (SELECT DISTINCT path FROM profiles WHERE path IS NOT NULL), w AS (SELECT a.path, " + ", ".join(f"{_status_sql(t)} AS {t.prefix}_status" for t in WIDE) + f" FROM anchor a {_JOINS})"


def _wide(spark: SparkSession, d: str, keep=()) -> DataFrame:
    anchor = table(spark, d, "profiles").where("path IS NOT NULL").select("path").distinct()
    return ST.wide(anchor, table(spark, d, "tool_runs"), WIDE, keep)


_OTHERS = f"o AS (SELECT path, string_agg(tool, ' ' ORDER BY tool) AS tools FROM (SELECT DISTINCT path, tool FROM tool_runs WHERE tool NOT IN ({', '.join(repr(t.table) for t in WIDE)})) GROUP BY 1)"


@query(_WIDE_SQL + f", {_OTHERS} SELECT w.*, coalesce(o.tools, '') AS other_tools FROM w LEFT JOIN o ON o.path = w.path")
def tool_status(spark: SparkSession, d: str) -> DataFrame:
    """Every profiled file with the status of each tool, in one fold instead of fourteen joins."""
    return _wide(spark, d)


def _named_sql(*status: str) -> str:
    vals = ", ".join(f"'{s}'" for s in status)
    items = ", ".join(f"CASE WHEN {t.prefix}_status IN ({vals}) THEN '{t.prefix}' END" for t in WIDE)
    return f"array_to_string(list_sort(list_filter([{items}], lambda x: x IS NOT NULL)), ' ')"


@query(_WIDE_SQL + " SELECT path, " + ", ".join(f"{_named_sql(*s)} AS {n}" for n, s in (("tools_status_timeout", ["timeout"]), ("tools_status_fail", ["crash", "timeout"]), ("tools_status_warn", ["warn"])))
       + ", array_to_string(list_sort([" + ", ".join(f"'{t.prefix}_' || {t.prefix}_status" for t in WIDE) + "]), ' ') AS tools_status FROM w")
def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Status of all tools per file, rolled up to lists of names."""
    return ST.roll_up(_wide(spark, d)).select("path", "tools_status_timeout", "tools_status_fail", "tools_status_warn", "tools_status")


@query(f"WITH {_LATEST} SELECT tool, CASE WHEN timeout THEN 'timeout' WHEN exit_value <> 0 THEN 'crash' WHEN length(stderr) > 5 THEN 'warn' ELSE 'success' END AS status, count(*) AS n, max(process_time_ms) AS slowest_ms FROM latest GROUP BY 1, 2")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Runs per tool and status, the latest run of each file."""
    one = ST.latest_runs(table(spark, d, "tool_runs"), keep=["process_time_ms"])
    return one.groupBy("tool", ST.named_status(F.col("status")).alias("status")).agg(F.count(F.lit(1)).alias("n"), F.max("process_time_ms").alias("slowest_ms"))


@query("WITH f AS (SELECT path, min(exit_value) AS old, max(exit_value) AS new FROM tool_runs WHERE tool = 'tika' AND path IS NOT NULL GROUP BY 1) SELECT path, CASE WHEN new IS NOT NULL THEN new ELSE old END AS tk_exit FROM f")
def fill_absent_feature(spark: SparkSession, d: str) -> DataFrame:
    """A feature that is filled from another column only where it is absent."""
    f = table(spark, d, "tool_runs").where("tool = 'tika' AND path IS NOT NULL").groupBy("path").agg(F.min("exit_value").alias("old"), F.max("exit_value").alias("new"))
    return ST.rename(ST.fill_absent(f.withColumn("exit", F.col("new")), {"exit": "old"}), {"path": "path", "exit": "tk_exit"}, rest=False)


@query(
    r"SELECT DISTINCT run_id, list_sort(list_distinct(list_filter(list_transform(string_split_regex(stderr, '\r\n|\r|\n'), lambda x: regexp_extract(x, '(\d+) 0 obj|object (\d+)', 2)), lambda x: x <> ''))) AS objects, "
    r"regexp_matches(stderr, '(?m)^Traceback') AS has_trace, len(regexp_extract_all(stderr, 'page \d+'))::int AS n_pages FROM tool_runs WHERE stderr IS NOT NULL"
)
def regex_capture(spark: SparkSession, d: str) -> DataFrame:
    """Patterns over stderr: captures per line, any line that matches, number of matches; found where the text lies, then made distinct."""
    text = F.col("stderr")
    p = RP.capture_pack(text, {"objects": r"object (\d+)"}, {"has_trace": r"^Traceback"})
    found = table(spark, d, "tool_runs").where("stderr IS NOT NULL").select("run_id", p.alias("p"), F.regexp_count(text, F.lit(r"page \d+")).alias("n_pages"))
    return found.select("run_id", F.array_sort("p.objects").alias("objects"), "p.has_trace", "n_pages").distinct()


@query("WITH t AS (SELECT path, tool, stdout FROM tool_runs) SELECT count(*) AS n, count(*) FILTER (stdout IS NULL) AS n_null FROM t")
def packed_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Every stdout gzipped, in base64 and back; rows that came back the same, and null ones."""
    t = table(spark, d, "tool_runs").select("stdout", D.unpack(D.pack(F.col("stdout").cast("binary"))).alias("back"))
    return t.agg(F.count(F.when(F.col("stdout").cast("binary").eqNullSafe(F.col("back")), 1)).alias("n"), F.count(F.when(F.col("stdout").isNull(), 1)).alias("n_null"))


@query("SELECT doc_id, sha256(text) AS digest, substr(sha256(text), 1, 2) || '/' || substr(sha256(text), 3, 2) || '/' || sha256(text) AS target, length(text) AS n_chars FROM documents WHERE text IS NOT NULL")
def digest_paths(spark: SparkSession, d: str) -> DataFrame:
    """Digest and content-addressed path of every text."""
    sha = F.sha2("text", 256)
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", sha.alias("digest"), D.fan_out(sha).alias("target"), F.length("text").alias("n_chars"))


@query("SELECT path, regexp_extract(path, '([0-9a-fA-F]{2}/[0-9a-fA-F]{2}/[0-9a-fA-F]{10,})$', 1) AS normal, regexp_extract(path, '([0-9a-f]{10,})', 1) AS hash, list_last(string_split(path, '/')) <> shasum256 AS misnamed FROM (SELECT DISTINCT path, shasum256 FROM profiles)")
def profile_paths(spark: SparkSession, d: str) -> DataFrame:
    """Normal part and hash of each profiled path, and whether its name differs from its digest."""
    p = F.col("path")
    rows = table(spark, d, "profiles").select("path", "shasum256").distinct()
    return rows.select("path", D.normal_file_path(p).alias("normal"), D.file_hash(p).alias("hash"), (F.element_at(F.split(p, "/"), -1) != F.col("shasum256")).alias("misnamed"))


@query("SELECT filter_name, list_sort(json_keys(filter_json)) AS keys FROM record_filters")
def json_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of JSON objects."""
    return table(spark, d, "record_filters").select("filter_name", OG.json_keys(F.col("filter_json")).alias("keys"))


@query("SELECT doc_id::varchar AS path, 0 AS exit_value, false AS timeout, (length(text) - length(replace(text, chr(10), '')))::int AS n_newlines, length(text) > 1000 AS cut FROM documents WHERE text IS NOT NULL AND instr(text, chr(13)) = 0")
def process_runner(spark: SparkSession, d: str) -> DataFrame:
    """An external program over every text, what it prints bounded to a thousand characters."""
    docs = table(spark, d, "documents").where("text IS NOT NULL AND instr(text, '\\r') = 0")
    runs = P.run_command(docs.select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content")), P.Command("cat", "cat {input}", stdout_most=1000))
    sizes = docs.select(F.col("doc_id").cast("string").alias("path"), F.length("text").alias("n"))
    return runs.join(sizes, "path").select("path", "exit_value", "timeout", (F.col("n") - F.col("stdout_length")).cast("int").alias("n_newlines"), F.col("stdout_truncated").alias("cut"))


@query("SELECT DISTINCT path FROM profiles WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM tool_runs WHERE tool = 'qpdf' AND path IS NOT NULL)")
def files_to_run(spark: SparkSession, d: str) -> DataFrame:
    """Files that a tool has yet to run on."""
    return P.not_yet_run(table(spark, d, "profiles").where("path IS NOT NULL").select("path").distinct(), table(spark, d, "tool_runs"), "qpdf")


@query("SELECT path, collection, size, shasum256, profiled_at FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY profiled_at DESC NULLS LAST, size DESC NULLS LAST, shasum256 DESC NULLS LAST, collection DESC NULLS LAST) AS r FROM profiles) WHERE r = 1")
def latest_profiles(spark: SparkSession, d: str) -> DataFrame:
    """One profile per path, the latest."""
    return R.upsert(None, table(spark, d, "profiles"), ["path"], [F.col(c) for c in ("profiled_at", "size", "shasum256", "collection")])


@query(
    _WIDE_SQL
    + ", p AS (SELECT path, max(collection) AS collection, max(shasum256) AS sha FROM profiles WHERE path IS NOT NULL GROUP BY 1), "
    + f"o AS (SELECT path, stderr FROM (WITH {_LATEST} SELECT * FROM latest) WHERE tool = 'pdfcpu') "
    + "SELECT p.path AS fname, nullif(trim(p.collection), '') AS collection, nullif(trim(p.sha), '') AS shasum_256, nullif(trim(replace(replace(replace(o.stderr, chr(0), 'u0000'), chr(31), 'u001f'), chr(30), 'u001e')), '') IS NOT NULL AS has_cpu_warn, "
    + _named_sql("warn").replace("_status IN", "_status IN")
    + " AS tools_status_warn FROM p JOIN w ON w.path = p.path LEFT JOIN o ON o.path = p.path"
)
def feature_documents(spark: SparkSession, d: str) -> DataFrame:
    """Feature documents of every profiled file: profile, tool outputs and the roll-up of all tools."""
    from tessellar.operators import features as FE

    anchor = table(spark, d, "profiles").where("path IS NOT NULL").groupBy("path").agg(F.max("collection").alias("collection"), F.max("shasum256").alias("shasum_256"))
    rows = ST.wide(anchor, table(spark, d, "tool_runs"), WIDE, ("stderr",)).withColumns({"fname": F.col("path"), "cpu_warn": F.col("cpu_stderr")})
    made = FE.tidy(FE.apply(rows, ["profile", "cpu", "status"]))
    return made.select("fname", "collection", "shasum_256", F.col("cpu_warn").isNotNull().alias("has_cpu_warn"), F.coalesce("tools_status_warn", F.lit("")).alias("tools_status_warn"))


_STREAMS = {"clamav": ("c", "stdout"), "cd": ("pol", "stdout"), "cd_warn": ("pol", "stderr"), "mc_warn": ("mc", "stderr"), "mt_warn": ("mt", "stderr"), "pmd_warn": ("pmd", "stderr"), "pmt_warn": ("pmt", "stderr"), "cpu_warn": ("cpu", "stderr")}
_OF_PREFIX = {t.prefix: t.table for t in WIDE}


@query(
    f"WITH {_LATEST}, a AS (SELECT path, max(collection) AS collection FROM profiles WHERE path IS NOT NULL GROUP BY 1) SELECT a.path AS fname, a.path AS original_fname, nullif(trim(a.collection), '') AS collection, "
    + ", ".join(f"nullif(trim({p}_{n}.{c}), '') AS {n}" for n, (p, c) in _STREAMS.items()) + " FROM a "
    + " ".join(f"LEFT JOIN latest {p}_{n} ON {p}_{n}.path = a.path AND {p}_{n}.tool = '{_OF_PREFIX[p]}'" for n, (p, c) in _STREAMS.items())
)
def passed_on_features(spark: SparkSession, d: str) -> DataFrame:
    """Features that are a tool's output or complaints as they stand, blank ones null."""
    from tessellar.operators import features as FE

    anchor = table(spark, d, "profiles").where("path IS NOT NULL").groupBy("path").agg(F.max("collection").alias("collection"))
    prefixes = {p for p, _ in _STREAMS.values()}
    rows = ST.wide(anchor, table(spark, d, "tool_runs"), [t for t in WIDE if t.prefix in prefixes], ("stdout", "stderr"))
    rows = rows.select(F.col("path").alias("fname"), "collection", *(F.col(f"{p}_{c}").alias(n) for n, (p, c) in _STREAMS.items()))
    made = FE.apply(rows, ["profile", "cpu", "caradoc", "clamav", "mutool", "pdfminer"])
    return made.select("fname", "original_fname", "collection", *_STREAMS)


_STATUS_OF = lambda p: _status_sql(next(t for t in WIDE if t.prefix == p))


@query(
    f"WITH {_LATEST}, a AS (SELECT DISTINCT path FROM profiles WHERE path IS NOT NULL), u AS (SELECT path, max(source) AS universe FROM documents WHERE path IS NOT NULL GROUP BY 1) "
    f"SELECT a.path, u.universe, {_STATUS_OF('q')} AS q_status, {_STATUS_OF('tk')} AS tk_status FROM a LEFT JOIN u ON u.path = a.path LEFT JOIN latest qr ON qr.tool = 'qpdf' AND qr.path = a.path LEFT JOIN latest tkr ON tkr.tool = 'tika' AND tkr.path = a.path"
)
def wide_with_universes(spark: SparkSession, d: str) -> DataFrame:
    """The short wide view: files with the universe that lists them and the status of two tools."""
    from tessellar.operators import features as FE

    universes = table(spark, d, "documents").where("path IS NOT NULL").select("path", F.col("source").alias("text"))
    tools = [t for t in WIDE if t.table in ("qpdf", "tika")]
    anchor = table(spark, d, "profiles").where("path IS NOT NULL").select("path").distinct()
    rows = ST.wide(FE.with_extracts(anchor, {"universe": universes}), table(spark, d, "tool_runs"), tools, ())
    return FE.apply(rows, ["universe"]).select("path", "universe", "q_status", "tk_status")


@query(
    f"WITH {_LATEST}, a AS (SELECT path, max(size) AS size FROM profiles WHERE path IS NOT NULL GROUP BY 1), f AS (SELECT path, min(id) AS id FROM cc_fetch WHERE path IS NOT NULL GROUP BY 1), "
    "u AS (SELECT id, min(url) AS url, min(host) AS host, min(mime) AS mime FROM cc_urls WHERE id IS NOT NULL GROUP BY 1), h AS (SELECT id, min(country) AS country, min(tld) AS tld FROM cc_hosts GROUP BY 1), m AS (SELECT id, min(name) AS mime FROM cc_mimes GROUP BY 1) "
    f"SELECT a.path, a.size, u.url, h.country, h.tld, m.mime, {_STATUS_OF('pinfo')} AS pinfo_status FROM a JOIN f ON f.path = a.path JOIN u ON u.id = f.id LEFT JOIN h ON h.id = u.host LEFT JOIN m ON m.id = u.mime "
    "LEFT JOIN latest pinfor ON pinfor.tool = 'pdfinfo' AND pinfor.path = a.path"
)
def wide_with_crawl(spark: SparkSession, d: str) -> DataFrame:
    """The wide view of files that come from the crawl, with the url, place and mime of their first capture."""
    first = lambda c: F.min(c).alias(c)
    of_file = table(spark, d, "cc_fetch").where("path IS NOT NULL").groupBy("path").agg(first("id"))
    urls = table(spark, d, "cc_urls").where("id IS NOT NULL").groupBy("id").agg(first("url"), first("host"), first("mime"))
    hosts = table(spark, d, "cc_hosts")
    anchor = table(spark, d, "profiles").where("path IS NOT NULL").groupBy("path").agg(F.max("size").alias("size"))
    crawled = anchor.join(of_file, "path").join(urls, "id")
    placed = R.star(crawled, {"mime": (table(spark, d, "cc_mimes"), "id", "name")}).withColumn("country", F.col("host")).withColumn("tld", F.col("host"))
    placed = R.star(R.star(placed, {"country": (hosts, "id", "country")}), {"tld": (hosts, "id", "tld")})
    named = placed.select("path", "size", "url", F.col("country_name").alias("country"), F.col("tld_name").alias("tld"), F.col("mime_name").alias("mime"))
    return ST.wide(named, table(spark, d, "tool_runs"), [t for t in WIDE if t.table == "pdfinfo"], ()).drop("other_tools")


@query("SELECT doc_id, substr(replace(coalesce(text, ''), chr(0), ' '), 1, 1000) AS kept FROM documents")
def kept_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts as a bounded column of a database holds them."""
    return table(spark, d, "documents").select("doc_id", store_text(F.col("text"), 1000).alias("kept"))


@query(
    "WITH t AS (SELECT doc_id, text, regexp_replace(text, '[^\\x00-\\x7f]', '', 'g') AS plain FROM documents WHERE text IS NOT NULL) "
    "SELECT doc_id, octet_length(encode(text))::int AS n, (octet_length(encode(text)) - length(plain) + length(plain) - length(replace(plain, '?', '')))::int AS n_marks, left(plain, 0) || regexp_replace(plain, '\\?', '', 'g') AS plain FROM t"
)
def base64_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts in base64 read as ASCII: a mark for every other byte."""
    a = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", D.base64_ascii(F.base64(F.col("text").cast("binary"))).alias("a"))
    return a.select("doc_id", F.length("a").alias("n"), F.regexp_count("a", F.lit(r"\?")).alias("n_marks"), F.replace("a", F.lit("?"), F.lit("")).alias("plain"))


@query("SELECT doc_id, doc_id % 3 = 1 AS misnamed, sha256(text) = sha256(text || '') AS same FROM documents WHERE text IS NOT NULL")
def misnamed_texts(spark: SparkSession, d: str) -> DataFrame:
    """Which of the texts are stored under another name than their digest."""
    sha = F.sha2("text", 256)
    path = F.concat(F.lit("a/b/"), F.when(F.col("doc_id") % 3 == 1, F.reverse(sha)).otherwise(sha))
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", D.misnamed(path, F.col("text").cast("binary")).alias("misnamed"), (sha == F.sha2(F.col("text").cast("binary"), 256)).alias("same"))


#: Stands for a program: says its name, and writes to its output if it is given one.
_STUB = """sh -c 'echo "run $0"; for x; do case "$x" in */out) echo "made by $0" > "$x";; esac; done' """
_PROGRAMS = ", ".join(f"('{c.table}', '{c.template.split()[0]}', {str(c.prints).lower()}, {c.stdout_most})" for c in P.COMMANDS)


@query(f"SELECT t.tool, f.filter_name AS path, 0 AS exit_value, false AS timeout, CASE WHEN t.prints THEN '' ELSE left('run ' || t.program || chr(10), t.most) END AS stdout FROM (VALUES {_PROGRAMS}) AS t(tool, program, prints, most), record_filters f")
def commands_run(spark: SparkSession, d: str) -> DataFrame:
    """The command of each tool over the small files of a table, with a stub in the place of its program."""
    files = table(spark, d, "record_filters").select(F.col("filter_name").alias("path"), F.col("filter_json").cast("binary").alias("content"))
    runs = [P.run_command(files, replace(c, template=_STUB + c.template)) for c in P.COMMANDS]
    return reduce(DataFrame.unionByName, runs).select("tool", "path", "exit_value", "timeout", "stdout")


@query(
    "WITH n AS (SELECT doc_id, length(text) - length(replace(text, chr(12), '')) AS n FROM documents WHERE text IS NOT NULL) SELECT doc_id::varchar AS path, n::int AS n_pages, unnest(range(1, n + 1))::int AS page, 0 AS exit_value, false AS timeout FROM n "
    "UNION ALL SELECT doc_id::varchar, NULL, NULL, 0, false FROM n WHERE n = 0"
)
def pages_split(spark: SparkSession, d: str) -> DataFrame:
    """Every text split into as many pages as it has page breaks, by programs that count and split."""
    files = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))
    count = P.Command("page_splitter_count", """sh -c 'tr -cd "\\f" < $0 | wc -c' {input}""")
    split = P.Command("page_splitter", "sh -c 'echo $1 > $2' {input} {page} {output}", "pdf")
    return P.split_pages(files, scratch(spark, "pages"), count, split)


@query("SELECT doc_id::varchar AS path, 0 AS exit_value, false AS timeout, CASE WHEN text <> '' THEN sha256(text) END AS digest, text <> '' AS same FROM documents WHERE text IS NOT NULL")
def extracted(spark: SparkSession, d: str) -> DataFrame:
    """What a program takes out of every file, with its digest and itself packed and unpacked again."""
    files = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))
    got = P.extract(files, P.Command("icc", "cat {input}", "icc", prints=True))
    return got.select("path", "exit_value", "timeout", "digest", F.coalesce(F.sha2(D.unpack(F.col("packed")), 256) == F.col("digest"), F.lit(False)).alias("same"))


_BASE32 = (
    "list_aggregate(list_transform(range(4), lambda b: list_aggregate(list_transform(range(8), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "(((('0x' || substr(h, (b * 10 + 1)::int, 10))::bigint >> (35 - 5 * k)) & 31) + 1)::int, 1)), 'string_agg', '')), 'string_agg', '')"
)


@query(f"SELECT doc_id, {_BASE32} AS digest, doc_id % 2 = 0 AS same FROM (SELECT doc_id, sha1(text) AS h FROM documents WHERE text IS NOT NULL)")
def index_digests(spark: SparkSession, d: str) -> DataFrame:
    """The digest of every text as crawl indexes write it, compared with one that is spelled otherwise, or another."""
    content = F.col("text").cast("binary")
    docs = table(spark, d, "documents").where("text IS NOT NULL").withColumn("digest", D.base32_sha1(content))
    told = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" sha1:"), F.lower("digest"))).otherwise(F.concat(F.lit("0"), F.substring("digest", 2, 31)))
    return docs.select("doc_id", "digest", D.same_digest(content, told).alias("same"))
