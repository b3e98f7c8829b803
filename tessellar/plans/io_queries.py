"""Queries that write a source's format to the shared folder and read it back: index files, result tables, lists, archives, counts, streams."""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar import sinks as K
from tessellar.common import scratch, table
from tessellar.files import get, put
from tessellar.functions import urls as U
from tessellar.functions.strings import primary_language
from tessellar.operators import relational as R
from tessellar.operators.record_filter import load_filter
from tessellar.plans.crawl_queries import _NORMAL, _TLD, FILTER, _named
from tessellar.sources import files as S
from tessellar.streaming import incremental as I

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_place = scratch


@query("SELECT coalesce(status::varchar, 'none') AS status, count(*) AS n, count(DISTINCT url) AS n_urls, sum(warc_length)::bigint AS bytes FROM cc_urls WHERE url IS NOT NULL GROUP BY 1")
def index_files(spark: SparkSession, d: str) -> DataFrame:
    """Every capture as a line of gzipped index files, read back, parsed and counted by status."""
    u = table(spark, d, "cc_urls").where("url IS NOT NULL")
    text = lambda c: F.col(c).cast("string")
    record = F.to_json(F.struct("url", text("status").alias("status"), "digest", text("warc_length").alias("length"), text("warc_offset").alias("offset"), F.col("warc_file_name").alias("filename"), "charset", "languages", "truncated"))
    path = _place(spark, "index")
    u.select(F.concat(F.lit("x)/ "), F.date_format("captured_at", "yyyyMMddHHmmss"), F.lit(" "), record)).write.option("compression", "gzip").text(path)
    r = S.parse_index(S.index_lines(spark, path)).where("ok")
    return r.groupBy(F.coalesce("status", F.lit("none")).alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("url").alias("n_urls"), F.sum("length_n").alias("bytes"))


def _text_files(spark: SparkSession, d: str) -> DataFrame:
    """(path, content) of every text, its number as its path."""
    return table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))


@query("SELECT DISTINCT path, coalesce(exit_value, -99) AS exit_value, coalesce(timeout, false) AS timeout, length(replace(replace(coalesce(stderr, ''), chr(13), ''), chr(10), ''))::int AS n_chars, stderr_length FROM tool_runs WHERE path IS NOT NULL")
def result_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tool results to CSV with line ends inside fields, and back."""
    path = _place(spark, "results") + ".csv"
    K.write_by_name(table(spark, d, "tool_runs").where("path IS NOT NULL"), path)
    r = S.tool_results(spark, path)
    plain = F.regexp_replace(F.coalesce("stderr", F.lit("")), r"[\r\n]", "")
    return r.select("path", F.coalesce("exit_value", F.lit(-99)).alias("exit_value"), F.coalesce("timeout", F.lit(False)).alias("timeout"), F.length(plain).alias("n_chars"), "stderr_length").distinct()


@query("SELECT count(*) AS n FROM tool_runs WHERE path IS NOT NULL")
def csv_rows_counted(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a CSV file whose fields hold line ends."""
    path = _place(spark, "counted") + ".csv"
    K.write_by_name(table(spark, d, "tool_runs").where("path IS NOT NULL"), path)
    return spark.createDataFrame([(S.csv_rows(spark, path),)], "n bigint")


@query("SELECT count(DISTINCT regexp_extract(trim(url), '^\\S+')) AS n FROM cc_urls WHERE truncated <> '' AND trim(url) <> ''")
def url_lists(spark: SparkSession, d: str) -> DataFrame:
    """URLs of truncated captures as a list of lines; first tokens read back."""
    path = _place(spark, "urls")
    K.write_url_list(table(spark, d, "cc_urls").where("truncated <> ''"), path)
    return S.key_list(spark, path).agg(F.count_distinct("key").alias("n"))


@query("SELECT coalesce(mime::varchar, 'NULL') AS key, count(*) AS n FROM cc_urls GROUP BY 1")
def count_files(spark: SparkSession, d: str) -> DataFrame:
    """Counts per mime as a tab-separated file, and back."""
    path = _place(spark, "counts")
    K.write_counts(table(spark, d, "cc_urls").groupBy(F.coalesce(F.col("mime").cast("string"), F.lit("NULL")).alias("key")).agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.csv(path, sep="\t", schema="key string, n bigint")


@query("SELECT doc_id AS id, 200 AS http_status, octet_length(encode(text)) AS n_bytes, sha256(text) AS digest FROM documents WHERE text IS NOT NULL")
def archive_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Every text as a record of gzipped archives, fetched back by byte range."""
    folder = _place(spark, "archive")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:  # an archive for each batch
            name, rows, parts, at = f"{folder}/{uuid.uuid4().hex}", [], [], 0
            for i, text in zip(b["doc_id"], b["text"]):
                record = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\n" + text.encode() + b"\r\n\r\n", 1, mtime=0)
                parts.append(record)
                rows.append((i, name, at, len(record)))
                at += len(record)
            if rows:
                put(name, b"".join(parts))
                yield pd.DataFrame(rows, columns=["id", "file", "offset", "length"])

    index = _place(spark, "archive-index")
    table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text").mapInPandas(write, "id bigint, file string, offset bigint, length bigint").write.parquet(index)
    got = S.warc_payloads(spark.read.parquet(index))
    return got.select("id", "http_status", F.octet_length("payload").cast("bigint").alias("n_bytes"), F.sha2("payload", 256).alias("digest"))


@query("SELECT id, status_id, fetched_length, fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC NULLS LAST, status_id DESC NULLS LAST, fetched_length DESC NULLS LAST) AS r FROM cc_fetch) WHERE r = 1")
def fetches_as_they_land(spark: SparkSession, d: str) -> DataFrame:
    """Fetches that land in two deliveries, taken in by a stream into a table of the latest per capture."""
    f = table(spark, d, "cc_fetch").select("id", "status_id", "fetched_length", "fetched_at")
    src, out, progress = (_place(spark, n) for n in ("landing", "latest", "progress"))
    for even in (0, 1):
        f.where(F.pmod("id", F.lit(2)) == even).write.mode("append").parquet(src)
        I.upsert_stream(I.landed(spark, src, f.schema), out, progress, ["id"], [F.col("fetched_at"), F.col("status_id"), F.col("fetched_length")])
    return spark.read.parquet(out)


@query("SELECT sha256(text) AS digest, substr(sha256(text), 1, 2) || '/' || substr(sha256(text), 3, 2) || '/' || sha256(text) AS target FROM documents WHERE text IS NOT NULL GROUP BY ALL")
def blobs(spark: SparkSession, d: str) -> DataFrame:
    """Every text stored once under its digest."""
    return K.write_blobs(_text_files(spark, d), _place(spark, "blobs")).select("digest", "target")


@query("WITH c AS (SELECT path, collection FROM profiles WHERE path IS NOT NULL) SELECT collection, count(*) AS n FROM c GROUP BY 1")
def query_to_csv(spark: SparkSession, d: str) -> DataFrame:
    """The result of an SQL text as CSV with a clean header, and back."""
    table(spark, d, "profiles").where("path IS NOT NULL").createOrReplaceTempView("profiles_to_csv")
    path = _place(spark, "sql")
    K.write_query_csv(spark, "SELECT collection, count(*) AS n FROM profiles_to_csv GROUP BY collection", path, null="\\N")
    return spark.read.csv(path, header=True, schema="collection string, n bigint", nullValue="\\N")


@query("SELECT path, regexp_extract(path, '([^/\\\\]+)$', 1) AS name FROM (SELECT DISTINCT path FROM documents WHERE path IS NOT NULL)")
def extract_names(spark: SparkSession, d: str) -> DataFrame:
    """Distinct names of extracts."""
    files = table(spark, d, "documents").where("path IS NOT NULL").select(F.concat("path", F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise(".json")).alias("path"))
    return S.base_names(files).select("path", F.regexp_extract("path", r"([^/\\]+)$", 1).alias("name"))



def index_build(spark: SparkSession, d: str) -> DataFrame:
    """From index files to the star and back to names: lines parsed, filtered, hosts and dictionaries made, records encoded by id, ids looked up again."""
    u = _named(spark, d).where("url IS NOT NULL")
    text = lambda c: F.col(c).cast("string")
    record = F.to_json(F.struct("url", text("status").alias("status"), F.col("mime_name").alias("mime"), F.col("detected_mime_name").alias("mime-detected"), F.col("warc_file_name").alias("filename"), "languages", "truncated"))
    path = _place(spark, "crawl")
    u.select(F.concat(F.lit("x)/ 20250101000000 "), record)).write.option("compression", "gzip").text(path)
    f = load_filter(FILTER)
    kept = S.parse_index(S.index_lines(spark, path)).where("ok").where(f.accept(F.col("status_n").cast("int"), F.col("mime"), F.col("mime_detected"), F.col("url")))
    h = U.url_host(U.tidy_url(F.col("url")))
    facts = kept.select("url", h.alias("host"), "mime", primary_language(F.col("languages")).alias("language"), "truncated", F.col("filename").alias("warc_file"))
    stored = _place(spark, "facts")
    facts.write.parquet(stored)
    facts = spark.read.parquet(stored)
    hosts = R.hosts(facts, F.col("host"), U.host_tld(F.col("host")))
    sizes = {"mime": 2000, "language": 2000, "truncated": 12, "warc_file": 200}
    words = {c: R.dictionary(facts, c, n) for c, n in sizes.items()}
    coded = facts
    for c, n in sizes.items():
        coded = R.encode(coded, c, words[c], n)
    out = coded.join(hosts, "host", "left")
    for c in sizes:
        out = R.star(out.withColumnRenamed(f"{c}_id", c), {c: (words[c], "id", "name")})
    return out.select("url", "host", F.coalesce("tld", F.lit("")).alias("tld"), F.col("mime_name").alias("mime"), F.col("language_name").alias("language"), F.col("truncated_name").alias("truncated"), F.col("warc_file_name").alias("warc_file"))


_URL_HOST = "lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#: ]*)', 1))"
QUERIES["index_build"] = index_build
ORACLES["index_build"] = (
    f"WITH t AS (SELECT u.url, u.status, u.languages, u.truncated, u.warc_file_name, m.name AS mime, {_NORMAL.format('m.name')} AS m, {_NORMAL.format('d.name')} AS x FROM cc_urls u LEFT JOIN cc_mimes m ON m.id = u.mime LEFT JOIN cc_detected_mimes d ON d.id = u.detected_mime WHERE url IS NOT NULL), "
    "k AS (SELECT * FROM t WHERE status IN (200, 206) AND (coalesce(m IN ('application/pdf', 'application/x-pdf'), false) OR coalesce(x = 'application/rtf', false) OR coalesce(regexp_matches(m, '^image/'), false) OR coalesce(regexp_matches(m, '(?i)vnd\\.'), false) OR coalesce(regexp_matches(x, '^audio'), false))), "
    f"h AS (SELECT *, {_URL_HOST} AS host FROM k) SELECT url, host, {_TLD.format('host')} AS tld, coalesce(mime, '') AS mime, coalesce(split_part(languages, ',', 1), '') AS language, coalesce(truncated, '') AS truncated, coalesce(warc_file_name, '') AS warc_file FROM h"
)


_CRAWLED = "cc_urls WHERE url IS NOT NULL"


def _index_lines(spark: SparkSession, d: str, name: str) -> str:
    """Folder of gzipped index files with a line for every capture."""
    path = _place(spark, name)
    u = table(spark, d, "cc_urls").where("url IS NOT NULL")
    u.select(F.concat(F.lit("x)/ 20250101000000 "), F.to_json(F.struct("url", F.col("status").cast("string").alias("status"))))).write.option("compression", "gzip").text(path)
    return path


@query(f"SELECT count(*) AS n, true AS all_ok, count(*) FILTER (status = 404) AS n_404, least(1000, count(*)) AS n_first FROM {_CRAWLED}")
def index_shards_checked(spark: SparkSession, d: str) -> DataFrame:
    """Index files named by a manifest, each inflated to its end, searched for a pattern, and a scan that ends after a thousand lines."""
    path = _index_lines(spark, d, "shards")
    listed = _place(spark, "manifest")
    S.walk(spark, path).where("path LIKE '%.gz'").select(F.concat(F.lit(" "), F.regexp_extract("path", "([^/]+)$", 1))).write.text(listed)
    names = S.manifest(spark, listed, f"{path}/")
    ok = S.check_shards(spark, names).agg(F.every("ok").alias("all_ok"))
    n = S.index_lines(spark, names).agg(F.count(F.lit(1)).alias("n"))
    hits = S.grep(spark, names, r'"status":"404"').agg(F.count(F.lit(1)).alias("n_404"))
    first = S.index_lines(spark, names, 1000).agg(F.count(F.lit(1)).alias("n_first"))
    one = F.lit(1).alias("k")
    return n.select(one, "n").join(ok.select(one, "all_ok"), "k").join(hits.select(one, "n_404"), "k").join(first.select(one, "n_first"), "k").drop("k")


@query(f"SELECT coalesce(status::varchar, 'none') AS status, count(*) AS n FROM {_CRAWLED} GROUP BY 1")
def index_over_http(spark: SparkSession, d: str) -> DataFrame:
    """Index files read as from a web server, one task per file."""
    path = _index_lines(spark, d, "served")
    urls = S.walk(spark, path).where("path LIKE '%.gz'").select(F.col("path").alias("url"))
    r = S.parse_index(S.http_index_lines(urls, get))
    return r.groupBy(F.coalesce("status", F.lit("none")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT extractor, count(*) AS n, sum(n_chars)::bigint AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY 1")
def search_export(spark: SparkSession, d: str) -> DataFrame:
    """Documents sent to an index in bulks and exported again, scrolled in slices."""
    folder = _place(spark, "index-store")

    def send(bulk: list[dict]) -> None:
        put(f"{folder}/{int(bulk[0]['doc_id']) % 4}/{int(bulk[0]['doc_id'])}.json", json.dumps([{k: None if v is None or v != v else v if isinstance(v, str) else int(v) for k, v in x.items()} for x in bulk]).encode())

    rows = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "extractor", "n_chars")
    sent = K.send_bulk(rows, send).agg(F.sum("n")).first()[0]

    def fetch(k: int, cursor: str | None) -> tuple[list[str], str | None]:
        from tessellar.files import names

        files = [x for x in names(f"{folder}/{k}") if cursor is None or x > cursor]
        return [json.dumps(x) for x in json.loads(get(f"{folder}/{k}/{files[0]}"))] if files else [], files[0] if len(files) > 1 else None

    found = S.scrolled(spark.range(4).select(F.col("id").cast("int").alias("slice")), fetch)
    read = found.select(F.from_json("document", "doc_id bigint, extractor string, n_chars bigint").alias("j")).select("j.*")
    assert sent is not None
    return read.groupBy("extractor").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))


@query("SELECT coalesce(lang, 'none') AS validity, 'B' AS universe, count(*) AS n, count(DISTINCT substr(sha256(text), 1, 2)) AS n_folders FROM documents WHERE text IS NOT NULL AND (lang IS NULL OR trim(lang) <> '') GROUP BY 1")
def universe_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists of keys and validities per universe, whose name says which it is; keys become paths."""
    path = _place(spark, "lists")
    rows = table(spark, d, "documents").where("text IS NOT NULL AND (lang IS NULL OR trim(lang) <> '')")
    rows.select(F.sha2("text", 256).alias("key"), F.coalesce("lang", F.lit("none")).alias("validity")).write.option("header", True).options(**K._CSV).csv(f"{path}/universe_B.csv")
    u = S.universes(spark, f"{path}/universe_B.csv")
    return u.groupBy("validity", "universe").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.split("path", "/")[1]).alias("n_folders"))


@query("SELECT doc_id, octet_length(encode(text)) AS n_bytes, sha256(text) AS digest, doc_id % 2 = 1 AS misnamed FROM documents WHERE text IS NOT NULL")
def walked_files(spark: SparkSession, d: str) -> DataFrame:
    """Every text as a file of its own: the folder walked, contents read back, and names compared with digests."""
    folder = _place(spark, "files")
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    name = F.when(F.col("doc_id") % 2 == 1, F.reverse(F.sha2("text", 256))).otherwise(F.sha2("text", 256))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, n, text in zip(b["doc_id"], b["name"], b["text"]):
                put(f"{folder}/{i}/{n}.txt", text.encode())
            yield pd.DataFrame({"n": [len(b)]})

    docs.select("doc_id", name.alias("name"), "text").mapInPandas(write, "n int").agg(F.sum("n")).collect()
    sized = S.walk(spark, folder).select(F.regexp_extract("path", r"/(\d+)/[^/]+$", 1).cast("bigint").alias("doc_id"), F.col("length").alias("n_bytes"))
    files = S.contents(spark, folder, ".txt")
    bad = _place(spark, "misnamed")
    K.write_mismatches(files, bad)
    listed = spark.read.csv(bad, sep="\t", schema="path string, digest string").select(F.split("path", "/")[0].cast("bigint").alias("doc_id"), F.lit(True).alias("misnamed"))
    read = files.select(F.split("path", "/")[0].cast("bigint").alias("doc_id"), F.sha2("content", 256).alias("digest"))
    return sized.join(read, "doc_id").join(listed, "doc_id", "left").select("doc_id", "n_bytes", "digest", F.coalesce("misnamed", F.lit(False)).alias("misnamed"))


@query("SELECT doc_id, source, pages FROM documents WHERE text IS NOT NULL")
def json_documents(spark: SparkSession, d: str) -> DataFrame:
    """Rows as JSON, written and read as whole documents of one line each, and metadata mapped to typed columns."""
    path = _place(spark, "results") + ".json"
    meta = F.create_map(F.lit("source"), F.array("source"), F.lit("pages"), F.array(F.col("pages").cast("string"), F.lit("9")))
    K.write_by_name(table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.to_json(F.struct(meta.alias("meta"))).alias("m")), path)
    back = S.documents_json(spark, path).select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    rows = back.select(F.from_json("line", "doc_id bigint, m string").alias("j")).select("j.doc_id", F.from_json("j.m", "meta map<string,array<string>>")["meta"].alias("meta"))
    return K.mapped(rows, "meta", {"source": ("source", "string"), "pages": ("pages", "int")})


@query("SELECT tool, count(*) AS n FROM tool_runs GROUP BY 1")
def status_batches(spark: SparkSession, d: str) -> DataFrame:
    """Status reports appended in two batches, one of which comes twice."""
    path = _place(spark, "status")
    runs = table(spark, d, "tool_runs").select("tool", "path", "exit_value", "started_at")
    middle = F.lit(runs.agg(F.median(F.unix_timestamp("started_at"))).first()[0])
    early = F.coalesce(F.unix_timestamp("started_at") <= middle, F.lit(False))
    for batch, rows in (("early", runs.where(early)), ("late", runs.where(~early)), ("early", runs.where(early))):
        K.append_status(rows, path, batch)
    return spark.read.parquet(path).groupBy("tool").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT host, string_agg(x, ' ' ORDER BY k) AS languages FROM (SELECT host, max(captured_at) AS k, trim(languages) AS x FROM cc_urls WHERE host IS NOT NULL AND trim(languages) <> '' AND captured_at IS NOT NULL GROUP BY host, trim(languages)) GROUP BY 1")
def host_languages_by_time(spark: SparkSession, d: str) -> DataFrame:
    """Languages of each host as one export cell in the order in which they were last seen, uncut."""
    pairs = table(spark, d, "cc_urls").select("host", F.trim("languages").alias("l"), "captured_at").where("host IS NOT NULL AND l <> '' AND captured_at IS NOT NULL").groupBy("host", "l").agg(F.max("captured_at").alias("k"))
    lists = pairs.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "l"))), lambda x: x["l"]).alias("languages"))
    return K.export_cells(lists, ["host", "languages"], most=None, sort=False).select(F.col("host").cast("int").alias("host"), "languages")


@query("SELECT id, warc_file_name AS fetch_key, warc_offset AS range_start, warc_offset + warc_length - 1 AS range_end, digest AS emit_key FROM cc_urls WHERE status = 200")
def work_items(spark: SparkSession, d: str) -> DataFrame:
    """Work of a source that a mapping describes: which columns are id, key, range and target."""
    table(spark, d, "cc_urls").createOrReplaceTempView("captures_to_fetch")
    text = S.fill_template("SELECT *, warc_offset + warc_length - 1 AS last FROM ${rows} WHERE status = ${status}", {"rows": "captures_to_fetch", "status": "200"})
    return S.config_rows(spark, {"query": text, "id_column": "id", "fetch_key_column": "warc_file_name", "range_start_column": "warc_offset", "range_end_column": "last", "emit_key_column": "digest"})


@query("SELECT doc_id::varchar AS path, CASE WHEN length(text) > 3000 THEN 'RESPONSE_UNPROCESSABLE_EXCEPTION' ELSE 'RESPONSE_SUCCESS' END AS outcome, CASE WHEN length(text) > 3000 THEN 3 ELSE 1 END AS requests, CASE WHEN length(text) > 3000 THEN NULL ELSE octet_length(encode(text))::varchar END AS answer FROM documents WHERE text IS NOT NULL")
def parsed_remotely(spark: SparkSession, d: str) -> DataFrame:
    """Every text handed to a parsing service that refuses long ones; refused ones are tried three times."""
    from tessellar.operators import clients as C

    send = lambda name, content: (415, None) if len(content.decode()) > 3000 else (200, [{"length": [str(len(content))]}])
    return C.parse_remote(_text_files(spark, d), send, lambda a: a[0]["length"][0])


@query("SELECT doc_id::varchar AS path, 3 AS repeats, CASE WHEN doc_id % 50 = 0 THEN 1 ELSE 0 END AS differing FROM documents WHERE text IS NOT NULL")
def load_tested(spark: SparkSession, d: str) -> DataFrame:
    """Every text sent to a service three times at once, which answers some differently the third time (one request at once, as the service counts)."""
    from tessellar.operators import clients as C

    seen: dict[str, int] = {}

    def send(name: str, content: bytes) -> tuple[int, object]:
        seen[name] = seen.get(name, 0) + 1
        odd = int(name) % 50 == 0 and seen[name] == 3
        return 200, [{"bytes": [str(len(content) + odd)], "time": [str(uuid.uuid4())]}]

    return C.load_test(_text_files(spark, d), send, 3, ["time"], 1).select("path", "repeats", "differing")


@query("SELECT doc_id::varchar AS path, octet_length(encode(text)) AS n_bytes, 2 AS n_parts FROM documents WHERE text IS NOT NULL")
def parsed_files(spark: SparkSession, d: str) -> DataFrame:
    """A function over every file, and a parser that finds two parts in each."""
    from tessellar.operators import features as FE

    files = _text_files(spark, d)
    sizes = FE.map_files(files, lambda p, c: (p, len(c)), "path string, n_bytes bigint")
    parts = FE.parse_files(files, lambda p, c: [{"part": ["first"]}, {"part": ["second"], "n": [str(len(c))]}])
    counted = parts.groupBy("path").agg(F.count(F.lit(1)).cast("int").alias("n_parts"), F.max(F.try_element_at("metadata", F.lit("n"))[0]).cast("bigint").alias("n"))
    return sizes.join(counted, "path").where("n = n_bytes").select("path", "n_bytes", "n_parts")


@query("SELECT doc_id, CASE WHEN n_chars > 2000 THEN 'deleted' ELSE 'kept' END AS outcome FROM documents WHERE text IS NOT NULL AND n_chars IS NOT NULL")
def extras_deleted(spark: SparkSession, d: str) -> DataFrame:
    """Files of every text, of which those that a list lacks are deleted; what is left is read from the folder."""
    folder = _place(spark, "mirror")
    docs = table(spark, d, "documents").where("text IS NOT NULL AND n_chars IS NOT NULL").select("doc_id", "n_chars")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in b["doc_id"]:
                put(f"{folder}/{i}", b"x")
            yield pd.DataFrame({"n": [len(b)]})

    docs.mapInPandas(write, "n int").agg(F.sum("n")).collect()
    there = S.walk(spark, folder).select(F.regexp_extract("path", r"/(\d+)$", 1).alias("key"))
    wanted = docs.where("n_chars <= 2000").select(F.col("doc_id").cast("string").alias("key"))
    extra = R.list_diff(there, wanted, there.limit(0)).where("reason = 'only_left'").select(F.col("key").alias("path"))
    gone = K.delete_extras(extra, folder, sure=True).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    left = S.walk(spark, folder).select(F.regexp_extract("path", r"/(\d+)$", 1).cast("bigint").alias("doc_id"), F.lit("kept").alias("outcome"))
    assert gone is not None
    return docs.select("doc_id").join(left, "doc_id", "left").select("doc_id", F.coalesce("outcome", F.lit("deleted")).alias("outcome"))
