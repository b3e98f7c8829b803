"""Sources: crawl index files, lists, reports, tables of results, archives, databases."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessellar.files import opened

# Fields of a crawl index record; keys have dashes where these have underscores.
INDEX_FIELDS = ("url", "mime", "mime_detected", "status", "digest", "length", "offset", "filename", "charset", "languages", "truncated", "redirect")
#: A manifest names at most so many files.
MOST_FILES = 1_000_000
_INDEX_SCHEMA = T.StructType([T.StructField(f.replace("_", "-"), T.StringType()) for f in INDEX_FIELDS])


def index_lines(spark: SparkSession, paths: str | list[str], most: int | None = None) -> DataFrame:
    """(value, file): non-blank lines of crawl index files, gzipped or not; one task per gzip file. ``most`` limits the whole scan exactly."""
    df = spark.read.text(paths).select("value", F.input_file_name().alias("file")).where(F.trim("value") != "")
    return df if most is None else df.limit(most)


def http_index_lines(urls: DataFrame, get: Callable[[str], bytes] | None = None) -> DataFrame:
    """(value, file): non-blank lines of gzipped index files behind HTTP (column url), one task per file or several files per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for url in b["url"]:
                text = gzip.decompress((get or http_get)(url)).decode("utf-8", "replace")
                lines = [x for x in text.split("\n") if x.strip()]
                for k in range(0, len(lines), 10_000):
                    part = lines[k : k + 10_000]
                    yield pd.DataFrame({"value": part, "file": [url] * len(part)})

    return urls.select("url").where("url IS NOT NULL").repartition("url").mapInPandas(run, "value string, file string")


def scrolled(slices: DataFrame, fetch: Callable[[int, str | None], tuple[list[str], str | None]]) -> DataFrame:
    """(slice, document): the JSON documents of a search index, exported slice by slice (column slice), each scrolled page by page in its task.

    ``fetch`` gives the documents of a page and the cursor of the next, null after the last; no page is gathered with another.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in b["slice"]:
                cursor, more = None, True
                while more:
                    found, cursor = fetch(int(k), cursor)
                    more = cursor is not None
                    if found:
                        yield pd.DataFrame({"slice": [k] * len(found), "document": found})

    return slices.select("slice").repartition("slice").mapInPandas(run, "slice int, document string")


def parse_index(lines: DataFrame) -> DataFrame:
    """Records of index lines: surt and timestamp (null for bare JSON lines), all fields as text, and numbers as *_n; ``ok`` tells which lines parsed.

    The JSON ends at the last brace from which it parses, so braces inside values and rubbish behind do no harm.
    """
    v = F.trim("value")
    head = F.regexp_extract(v, r"^(\S+) (\d{1,14}) \{", 1)
    body = F.regexp_extract(v, r"^(?:\S+ \S+ )?(\{.*\})", 1)
    j = F.from_json(body, _INDEX_SCHEMA, {"mode": "PERMISSIVE"})
    shorter = F.from_json(F.regexp_extract(body, r"^(\{.*\})[^}]*\}$", 1), _INDEX_SCHEMA)
    best = F.when(j["url"].isNotNull(), j).otherwise(shorter)
    out = lines.withColumn("__j", best)
    f = lambda n: F.col("__j").getField(n.replace("_", "-"))
    return out.select(
        F.nullif(head, F.lit("")).alias("surt"),
        F.nullif(F.regexp_extract(v, r"^\S+ (\d{1,14}) \{", 1), F.lit("")).alias("captured"),
        *(f(n).alias(n) for n in INDEX_FIELDS),
        *(f(n).try_cast("bigint").alias(f"{n}_n") for n in ("status", "length", "offset")),
        f("url").isNotNull().alias("ok"),
        *([F.col("file")] if "file" in lines.columns else []),
    )


def manifest(spark: SparkSession, paths: str | list[str], prefix: str = "") -> list[str]:
    """Index files that manifests name: lines that end in .gz, prefixed. It is read on the driver; more than MOST_FILES names are refused."""
    got = spark.read.text(paths).select(F.trim("value").alias("v")).where(F.col("v").endswith(".gz")).distinct().orderBy("v").limit(MOST_FILES + 1).collect()
    if len(got) > MOST_FILES:
        raise ValueError(f"more than {MOST_FILES} files")
    return [prefix + r["v"] for r in got]


def shard_names(crawls: DataFrame, n: int = 300) -> DataFrame:
    """(crawl, shard, path) of the numbered index files of each crawl (column crawl)."""
    name = F.concat(F.lit("cdx-"), F.lpad(F.col("shard").cast("string"), 5, "0"), F.lit(".gz"))
    each = crawls.select("crawl", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"))
    return each.select("crawl", "shard", F.concat(F.lit("cc-index/collections/"), "crawl", F.lit("/indexes/"), name).alias("path"))


def check_shards(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length, ok): whether each gzip file inflates to its end; failures are reported as such. Files are inflated in pieces."""

    @F.pandas_udf(T.BooleanType())
    def whole(contents: pd.Series) -> pd.Series:
        def one(b: bytes) -> bool:
            try:
                rest = bytes(b)
                while rest:
                    d = zlib.decompressobj(31)
                    while rest and not d.eof:
                        d.decompress(rest, 1 << 20)
                        rest = d.unconsumed_tail or d.unused_data
                        if not d.eof and not d.unconsumed_tail:
                            d.flush()
                            return d.eof
                    rest = d.unused_data
                return len(b) > 0
            except zlib.error:
                return False

        return contents.map(one)

    return spark.read.format("binaryFile").load(paths).select("path", "length", whole("content").alias("ok"))


def grep(spark: SparkSession, paths: str | list[str], pattern: str) -> DataFrame:
    """(file, value): lines that match."""
    return index_lines(spark, paths).where(F.col("value").rlike(pattern)).select("file", "value")


class HttpRanges:
    """A file behind HTTP, to seek and read in: each read is a request for a range, tried again after a 503."""

    def __init__(self, url: str, get: Callable | None = None, sleep: Callable[[float], None] | None = None) -> None:
        self.url, self.at, self.get, self.sleep = url, 0, get, sleep

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        out = http_get(self.url, self.at, self.at + n - 1, sleep=self.sleep, get=self.get)
        self.at += len(out)
        return out

    def close(self) -> None:
        pass


def archive(name: str) -> object:
    """A file of archived records by its name."""
    return HttpRanges(name) if name.startswith(("http:", "https:")) else opened(name)


_RANGES = "id bigint, ok boolean, http_status int, headers string, payload binary, error string"


def warc_payloads(rows: DataFrame, opener: Callable[[str], object] | None = None) -> DataFrame:
    """First record of each byte range [offset, offset + length - 1] of archive files; rows have id, file, offset and length.

    Sorted by file and offset before, so that a task reads forward. Names are paths or addresses of a file system, or begin with
    http: and https:, of which the ranges are asked for one by one. ``opener`` opens a file by name instead; a bad range gives a
    row with ``error``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f = None, None
        for b in batches:
            out = []
            for r in b.itertuples():
                try:
                    if r.file != name:
                        if f is not None:
                            f.close()
                        name, f = None, None
                        f = (opener or archive)(r.file)
                        name = r.file
                    f.seek(int(r.offset))
                    raw = gzip.decompress(f.read(int(r.length)))
                    _, _, http = raw.partition(b"\r\n\r\n")
                    head, _, body = http.partition(b"\r\n\r\n")
                    first = head.split(b"\r\n")[0].split()
                    out.append((r.id, True, int(first[1]) if len(first) > 1 and first[1].isdigit() else None, head.decode("latin-1"), body.removesuffix(b"\r\n\r\n"), None))
                except (OSError, EOFError, ValueError, zlib.error, TypeError) as e:
                    out.append((r.id, False, None, None, None, str(e)[:200]))
            yield pd.DataFrame(out, columns=["id", "ok", "http_status", "headers", "payload", "error"])
        if f is not None:
            f.close()

    by = ["file", "offset"]
    laid = rows.select("id", "file", "offset", "length").repartitionByRange(*by).sortWithinPartitions(*by)
    return laid.mapInPandas(run, _RANGES)


def byte_range(offset: Column, length: Column) -> Column:
    """HTTP range header of a record."""
    return F.concat(F.lit("bytes="), offset.cast("string"), F.lit("-"), (offset + length - 1).cast("string"))


def tool_results(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The ten-column result CSV of one tool: header, quotes, line ends inside fields."""
    schema = "path string, exit_value int, timeout boolean, process_time_ms bigint, stdout string, stdout_length bigint, stdout_truncated boolean, stderr string, stderr_length bigint, stderr_truncated boolean"
    return spark.read.csv(paths, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def universes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, universe, validity): the universe comes from the file's name, keys become ``eval-three/aa/bb/key``."""
    df = spark.read.csv(paths, schema="key string, validity string", header=True).withColumn("universe", F.regexp_extract(F.input_file_name(), r"universe_([A-C])", 1))
    return df.select(F.concat_ws("/", F.lit("eval-three"), F.substring("key", 1, 2), F.substring("key", 3, 2), "key").alias("path"), "universe", "validity")


def csv_rows(spark: SparkSession, paths: str | list[str]) -> int:
    """Rows of CSV files, line ends inside quotes not counted."""
    return spark.read.csv(paths, header=True, multiLine=True, escape='"').count()


def key_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(key): first token of each non-blank line."""
    return spark.read.text(paths).select(F.split(F.trim("value"), r"\s+")[0].alias("key")).where("key <> ''")


def walk(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of all files below a folder, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", F.col("modificationTime").alias("modified"))


def contents(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """(path, content) of all files below a folder, the path relative to it and without ``suffix``."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inside = F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/*", "/"), "^" + root.rstrip("/").replace(".", r"\.") + "/", "")
    return df.select(F.regexp_replace(inside, suffix.replace(".", r"\.") + "$", "").alias("path"), "content")


def documents_json(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, text): one JSON document per file, whole."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def base_names(files: DataFrame) -> DataFrame:
    """(path): distinct names of extracts without their last suffix."""
    return files.select(F.regexp_replace("path", r"\.(json|txt)$", "").alias("path")).distinct()


def jdbc(spark: SparkSession, url: str, query: str, key: str, low: int, high: int, partitions: int, options: Mapping[str, str] | None = None) -> DataFrame:
    """A database query in parallel ranges of ``key``, in place of paging by offset.

    Rows come in no order and none is skipped or read twice; a range whose connection is lost is read again as a whole by Spark's
    retry of its task, with a new connection.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=partitions, fetchsize=10_000)
    return reader.options(**(options or {})).load()


def fill_template(text: str, values: Mapping[str, str]) -> str:
    """``${name}`` in a query by values; an unknown name is an error."""
    import string

    return string.Template(text).substitute(values)


def config_rows(spark: SparkSession, conf: Mapping[str, object]) -> DataFrame:
    """Work items of a source described by a mapping: ``query`` (or ``table`` of a path), and the columns for id, fetch key, range and emit key."""
    rows = spark.sql(conf["query"]) if "query" in conf else spark.read.parquet(conf["table"])
    names = {"id": "id_column", "fetch_key": "fetch_key_column", "range_start": "range_start_column", "range_end": "range_end_column", "emit_key": "emit_key_column"}
    return rows.select(*(F.col(conf[k]).alias(n) for n, k in names.items() if k in conf))


#: Waits in seconds before the tries of a fetch; only 503 is tried again.
BACK_OFF = (0, 30, 120, 600)


def http_get(url: str, start: int | None = None, end: int | None = None, tries: int = 3, sleep: Callable[[float], None] | None = None, get=None) -> bytes:
    """A GET with an optional range, up to ``tries`` times, waiting longer each time after a 503; other failures are raised at once."""
    import time
    import urllib.error
    import urllib.request

    request = urllib.request.Request(url, headers={} if start is None else {"Range": f"bytes={start}-{'' if end is None else end}"})
    for k in range(tries):
        try:
            if k:
                (sleep or time.sleep)(BACK_OFF[min(k, len(BACK_OFF) - 1)])
            with (get or urllib.request.urlopen)(request) as r:
                return r.read()
        except urllib.error.HTTPError as e:
            if e.code != 503 or k == tries - 1:
                raise
    raise AssertionError
