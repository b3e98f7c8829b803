"""Queries over the crawl tables: names of URLs, filters, dictionaries, star joins, set operations, orders, fetch outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.common import scratch, table
from tessellar.functions import strings as S
from tessellar.functions import urls as U
from tessellar.functions.dates import content_length
from tessellar.functions.strings import normalize_mime
from tessellar.operators import fetch_state as FS
from tessellar.operators import relational as R
from tessellar.operators.features import of_mime
from tessellar.operators.record_filter import RecordFilter, Rule, load_filter
from tessellar.sinks import export_cells, reload_states
from tessellar.sources.files import byte_range, fill_template, shard_names

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_HOST = "coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#: ]*)', 1), ''), '')"
_TLD = "CASE WHEN regexp_full_match(regexp_extract({0}, '\\.([^.]+)$', 1), '\\d+') THEN '' ELSE lower(regexp_extract({0}, '\\.([^.]+)$', 1)) END"


def _tidy(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cc_urls").withColumn("url", U.tidy_url(F.col("url")))


@query(f"WITH t AS (SELECT {_HOST.replace('url', 'trim(url)')} AS h FROM cc_urls WHERE url IS NOT NULL), u AS (SELECT lower(h) AS host FROM t) SELECT {_TLD.format('host')} AS tld, count(*) AS n, count(DISTINCT host) AS n_hosts FROM u GROUP BY 1")
def url_tld_counts(spark: SparkSession, d: str) -> DataFrame:
    """Captures and hosts per top-level domain of the URL, largest first."""
    h = _tidy(spark, d).where("url IS NOT NULL").select(U.url_host(F.col("url")).alias("host"))
    n = h.groupBy("host").agg(F.count(F.lit(1)).alias("n")).withColumn("tld", U.host_tld(F.col("host")))
    return R.by_count(n.groupBy("tld").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_hosts")), "n", "tld")


@query(
    "WITH e AS (SELECT lower(regexp_replace(trim(regexp_extract(url, '\\.([^.]{1,5})$', 1)), '/$', '')) AS x FROM cc_urls WHERE url IS NOT NULL) "
    "SELECT CASE WHEN x = '' OR regexp_full_match(x, '\\d+') THEN NULL ELSE x END AS extension, count(*) AS n FROM e GROUP BY 1"
)
def url_extensions(spark: SparkSession, d: str) -> DataFrame:
    """Captures per URL extension."""
    return table(spark, d, "cc_urls").where("url IS NOT NULL").groupBy(U.url_extension(F.col("url")).alias("extension")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH t AS (SELECT coalesce(m.name, 'NULL') AS a, coalesce(d.name, 'NULL') AS b, coalesce(d.name, 'null') || '->' || coalesce(m.name, 'null') AS p FROM cc_urls u LEFT JOIN cc_mimes m ON m.id = u.mime LEFT JOIN cc_detected_mimes d ON d.id = u.detected_mime) "
    "SELECT 'mime' AS kind, a AS key, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'detected_mime', b, count(*) FROM t GROUP BY 2 UNION ALL SELECT 'pair', p, count(*) FROM t GROUP BY 2"
)
def mime_counts(spark: SparkSession, d: str) -> DataFrame:
    """Captures per mime, per detected mime and per pair: counted by id first, names joined to the counts."""
    ids = table(spark, d, "cc_urls").groupBy("mime", "detected_mime").agg(F.count(F.lit(1)).alias("n"))
    named = R.star(ids, {"mime": (table(spark, d, "cc_mimes"), "id", "name"), "detected_mime": (table(spark, d, "cc_detected_mimes"), "id", "name")})
    return R.pair_counts(named.select(F.col("mime_name").alias("mime"), F.col("detected_mime_name").alias("detected_mime"), "n"), "mime", "detected_mime", "n")


@query(
    """SELECT id, trim(regexp_replace(regexp_replace(lower(name), '^"|"$', '', 'g'), '\\s+', ' ', 'g')) AS normal, trim(split_part(name, ';', 1)) AS essence,
regexp_replace(trim(coalesce(name, '')), '[\\r\\n\\t]', ' ', 'g') AS clean, substr(replace(coalesce(name, ''), chr(0), ' '), 1, 12) AS stored FROM cc_mimes"""
)
def tidy_mimes(spark: SparkSession, d: str) -> DataFrame:
    """Mime names normalised, without parameters, as clean keys and as bounded columns hold them."""
    n = F.col("name")
    return table(spark, d, "cc_mimes").select("id", S.normalize_mime(n).alias("normal"), S.mime_essence(n).alias("essence"), S.clean_key(n).alias("clean"), S.store_text(n, 12).alias("stored"))


# A filter in the files' layout, with exact and anchored patterns.
FILTER = '{"status": [200, 206], "exact": {"mimes": ["Application/PDF", "application/x-pdf"], "detected_mimes": ["application/rtf"]}, "regex": {"mimes": ["\\\\Aimage/", "(?i)vnd\\\\."], "detected_mimes": ["\\\\Aaudio"]}}'
_NORMAL = "trim(regexp_replace(regexp_replace(lower({}), '^\"|\"$', '', 'g'), '\\s+', ' ', 'g'))"


def _named(spark: SparkSession, d: str) -> DataFrame:
    return R.star(table(spark, d, "cc_urls"), {"mime": (table(spark, d, "cc_mimes"), "id", "name"), "detected_mime": (table(spark, d, "cc_detected_mimes"), "id", "name")})


@query(
    f"""WITH t AS (SELECT u.id, u.status, {_NORMAL.format("m.name")} AS m, {_NORMAL.format("d.name")} AS x FROM cc_urls u LEFT JOIN cc_mimes m ON m.id = u.mime LEFT JOIN cc_detected_mimes d ON d.id = u.detected_mime),
s AS (SELECT CASE WHEN status IS NULL OR status NOT IN (200, 206) THEN NULL WHEN m IN ('application/pdf') THEN 'exact.mimes:Application/PDF' WHEN m = 'application/x-pdf' THEN 'exact.mimes:application/x-pdf'
WHEN x = 'application/rtf' THEN 'exact.detected_mimes:application/rtf' WHEN regexp_matches(m, '^image/') THEN 'regex.mimes:\\Aimage/' WHEN regexp_matches(m, '(?i)vnd\\.') THEN 'regex.mimes:(?i)vnd\\.'
WHEN regexp_matches(x, '^audio') THEN 'regex.detected_mimes:\\Aaudio' END AS rule FROM t) SELECT rule, count(*) AS n FROM s GROUP BY 1"""
)
def record_filter(spark: SparkSession, d: str) -> DataFrame:
    """Captures per rule of a composite filter; a null rule is a rejected record."""
    f = load_filter(FILTER)
    return _named(spark, d).groupBy(f.stratum(F.col("status"), F.col("mime_name"), F.col("detected_mime_name")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH t AS (SELECT u.id, u.url, u.status, {_NORMAL.format("m.name")} AS m FROM cc_urls u LEFT JOIN cc_mimes m ON m.id = u.mime)
SELECT id, url FROM t WHERE status = 200 AND m = 'application/pdf' AND ('0x' || substr(sha256(url), 1, 8))::bigint / 4294967296.0 < 0.08"""
)
def record_sample(spark: SparkSession, d: str) -> DataFrame:
    """PDF captures, 8 % of urls by hash: the same in every run."""
    f = RecordFilter((Rule("exact", "mimes", "application/pdf", 0.08),), (200,))
    return _named(spark, d).where(f.accept(F.col("status"), F.col("mime_name"), F.col("detected_mime_name"), F.col("url"))).select("id", "url")


@query("SELECT id, url FROM cc_urls WHERE ('0x' || substr(sha256(url), 1, 8))::bigint / 4294967296.0 < 0.01")
def thin_sample(spark: SparkSession, d: str) -> DataFrame:
    """Every hundredth url by hash, whatever its mime: the default probability skips all mime tests."""
    f = load_filter('{"defaultProbability": 0.01, "exact": {"mimes": ["text/html"]}}')
    return table(spark, d, "cc_urls").where(f.accept(F.col("status"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("url"))).select("id", "url")


@query("SELECT id, url FROM cc_urls WHERE status = 200 AND length(truncated) = 0")
def whole_captures(spark: SparkSession, d: str) -> DataFrame:
    """Captures with status 200 that weren't cut off; both tests reach the scan."""
    return table(spark, d, "cc_urls").where("status = 200 AND truncated = ''").select("id", "url")


@query("SELECT CASE WHEN trim(coalesce(truncated, '')) <> '' THEN 'url_list' ELSE 'fetch' END AS route, count(*) AS n, sum(warc_length)::bigint AS bytes FROM cc_urls WHERE status = 200 GROUP BY 1")
def fetch_routes(spark: SparkSession, d: str) -> DataFrame:
    """Truncated captures go to the list for the live web, the others to the archive."""
    route = F.when(F.trim(F.coalesce("truncated", F.lit(""))) != "", "url_list").otherwise("fetch")
    return table(spark, d, "cc_urls").where("status = 200").groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"), F.sum("warc_length").alias("bytes"))


@query("SELECT row_number() OVER (ORDER BY name)::int - 1 AS id, name FROM (SELECT DISTINCT substr(coalesce(warc_file_name, ''), 1, 200) AS name FROM cc_urls)")
def dictionary_files(spark: SparkSession, d: str) -> DataFrame:
    """Dictionary of archive file names."""
    return R.dictionary(table(spark, d, "cc_urls"), "warc_file_name", 200)


@query(
    "WITH w AS (SELECT row_number() OVER (ORDER BY name)::int - 1 AS i, name FROM (SELECT DISTINCT substr(coalesce(truncated, ''), 1, 12) AS name FROM cc_urls)) "
    "SELECT i AS truncated_id, name, count(*) AS n FROM cc_urls u JOIN w ON w.name = substr(coalesce(u.truncated, ''), 1, 12) GROUP BY 1, 2"
)
def dictionary_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Captures encoded by a dictionary and decoded again, counted by value."""
    urls = table(spark, d, "cc_urls").select("id", "truncated")
    words = R.dictionary(urls, "truncated", 12)
    coded = R.encode(urls, "truncated", words, 12).groupBy("truncated_id").agg(F.count(F.lit(1)).alias("n"))
    return coded.join(words.withColumnRenamed("id", "truncated_id"), "truncated_id").select("truncated_id", "name", "n")


@query("SELECT coalesce(split_part(languages, ',', 1), '') AS language, count(*) AS n FROM cc_urls GROUP BY 1")
def primary_languages(spark: SparkSession, d: str) -> DataFrame:
    """Captures by first language."""
    return table(spark, d, "cc_urls").groupBy(S.primary_language(F.col("languages")).alias("language")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT u.id, u.url, h.host AS host_name, m.name AS mime_name, d.name AS detected_mime_name FROM cc_urls u LEFT JOIN cc_hosts h ON h.id = u.host LEFT JOIN cc_mimes m ON m.id = u.mime LEFT JOIN cc_detected_mimes d ON d.id = u.detected_mime "
    "WHERE u.status = 200 AND u.truncated = ''"
)
def indexed_records(spark: SparkSession, d: str) -> DataFrame:
    """Whole captures with the names of their host and mimes."""
    dims = {"host": (table(spark, d, "cc_hosts"), "id", "host"), "mime": (table(spark, d, "cc_mimes"), "id", "name"), "detected_mime": (table(spark, d, "cc_detected_mimes"), "id", "name")}
    return R.star(table(spark, d, "cc_urls").where("status = 200 AND truncated = ''"), dims).select("id", "url", "host_name", "mime_name", "detected_mime_name")


@query("WITH f AS (SELECT DISTINCT * FROM cc_fetch), u AS (SELECT DISTINCT id, url FROM cc_urls) SELECT u.id, u.url, f.status_id, s.status, f.fetched_digest FROM u LEFT JOIN f ON f.id = u.id LEFT JOIN cc_fetch_status s ON s.id = f.status_id")
def records_with_fetches(spark: SparkSession, d: str) -> DataFrame:
    """Each capture with what fetching it gave, if it was fetched."""
    fetches = table(spark, d, "cc_fetch").distinct().select("id", "status_id", "fetched_digest")
    named = R.star(fetches, {"status_id": (table(spark, d, "cc_fetch_status"), "id", "status")})
    urls = table(spark, d, "cc_urls").select("id", "url").distinct()
    return urls.join(named, "id", "left").select("id", "url", "status_id", F.col("status_id_name").alias("status"), "fetched_digest")


@query("SELECT coalesce(s.status, 'UNKNOWN') AS status, count(*) AS n FROM cc_fetch f LEFT JOIN cc_fetch_status s ON s.id = f.status_id GROUP BY 1")
def fetch_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Fetches by the name of their state."""
    n = table(spark, d, "cc_fetch").groupBy("status_id").agg(F.count(F.lit(1)).alias("n"))
    named = R.star(n, {"status_id": (table(spark, d, "cc_fetch_status"), "id", "status")})
    return named.groupBy(F.coalesce("status_id_name", F.lit("UNKNOWN")).alias("status")).agg(F.sum("n").alias("n"))


@query("SELECT DISTINCT id, url, warc_file_name, warc_offset, warc_length FROM cc_urls u WHERE status = 200 AND truncated = '' AND NOT EXISTS (SELECT 1 FROM cc_fetch f WHERE f.id = u.id)")
def not_yet_fetched(spark: SparkSession, d: str) -> DataFrame:
    """Whole captures that no fetch has touched."""
    urls = table(spark, d, "cc_urls").where("status = 200 AND truncated = ''").select("id", "url", "warc_file_name", "warc_offset", "warc_length").distinct()
    return R.missing_from(urls, table(spark, d, "cc_fetch"), ["id"])


@query("SELECT DISTINCT u.id, u.url FROM cc_urls u LEFT JOIN cc_fetch f ON f.id = u.id WHERE u.truncated <> '' AND (f.id IS NULL OR f.status_id > 11)")
def to_fetch_again(spark: SparkSession, d: str) -> DataFrame:
    """Truncated captures never fetched, or whose fetch failed on the live web."""
    urls = table(spark, d, "cc_urls").where("truncated <> ''").select("id", "url")
    return R.to_retry(urls, table(spark, d, "cc_fetch").select("id", "status_id"), ["id"], F.col("status_id") > 11).distinct()


@query("SELECT h.id, h.host, max(f.warc_ip_address) AS ip FROM cc_hosts h LEFT JOIN cc_urls u ON u.host = h.id LEFT JOIN cc_fetch f ON f.id = u.id WHERE h.country IS NULL GROUP BY 1, 2")
def hosts_without_country(spark: SparkSession, d: str) -> DataFrame:
    """Hosts without a country, with the largest address seen. Only their captures are read on, and addresses are reduced per capture first."""
    h = table(spark, d, "cc_hosts").where("country IS NULL").select("id", F.col("host").alias("host_name"))
    ips = table(spark, d, "cc_fetch").groupBy(F.col("id").alias("capture")).agg(F.max("warc_ip_address").alias("ip"))
    urls = R.semi(table(spark, d, "cc_urls").select(F.col("id").alias("capture"), "host"), h.select(F.col("id").alias("host")), ["host"], accept_all_if_empty=False)
    of_host = urls.join(ips, "capture").groupBy("host").agg(F.max("ip").alias("ip"))
    return h.join(of_host, h["id"] == of_host["host"], "left").select("id", F.col("host_name").alias("host"), "ip")


@query(
    "SELECT id, coalesce(latitude::double, 0) AS latitude, coalesce(longitude::double, 0) AS longitude, CASE WHEN latitude IS NULL OR longitude IS NULL THEN '' ELSE 'known' END AS location, "
    "CASE WHEN country IS NULL OR country = '' THEN 'UNKNOWN' ELSE country END AS country FROM cc_hosts"
)
def host_places(spark: SparkSession, d: str) -> DataFrame:
    """Hosts with place and country; an incomplete place is '' and a missing country UNKNOWN."""
    full = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return table(spark, d, "cc_hosts").select(
        "id", F.coalesce(F.col("latitude").cast("double"), F.lit(0.0)).alias("latitude"), F.coalesce(F.col("longitude").cast("double"), F.lit(0.0)).alias("longitude"),
        F.when(full, "known").otherwise("").alias("location"), F.coalesce(F.when(F.col("country") != "", F.col("country")), F.lit("UNKNOWN")).alias("country"),
    )


@query(
    "WITH w AS (SELECT row_number() OVER (PARTITION BY ip_address ORDER BY id) AS r, * FROM cc_hosts WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND ip_address IS NOT NULL), k AS (SELECT * FROM w WHERE r = 1) "
    "SELECT h.id, coalesce(h.country, k.country) AS country, coalesce(k.latitude, h.latitude)::double AS latitude FROM cc_hosts h LEFT JOIN k ON k.ip_address = h.ip_address"
)
def hosts_located(spark: SparkSession, d: str) -> DataFrame:
    """Hosts with the place known for their address: a lookup by key that fills what is missing."""
    h = table(spark, d, "cc_hosts")
    known = h.where("latitude IS NOT NULL AND longitude IS NOT NULL AND ip_address IS NOT NULL").groupBy("ip_address").agg(F.min_by(F.struct("latitude", "country"), "id").alias("k"))
    joined = h.join(known, "ip_address", "left")
    return joined.select("id", F.coalesce("country", "k.country").alias("country"), F.coalesce("k.latitude", "latitude").cast("double").alias("latitude"))


@query("SELECT DISTINCT id, warc_file_name, warc_offset, 'bytes=' || warc_offset || '-' || (warc_offset + warc_length - 1) AS byte_range FROM cc_urls WHERE status = 200 AND truncated = ''")
def fetch_plan(spark: SparkSession, d: str) -> DataFrame:
    """Byte ranges of whole captures, laid out by archive file and offset."""
    urls = table(spark, d, "cc_urls").where("status = 200 AND truncated = ''").select("id", "warc_file_name", "warc_offset", "warc_length").distinct()
    return R.fetch_order(urls, "warc_file_name", "warc_offset").select("id", "warc_file_name", "warc_offset", byte_range(F.col("warc_offset"), F.col("warc_length")).alias("byte_range"))


@query("SELECT id, host, id % 7 AS stride FROM cc_hosts WHERE retired_at IS NULL")
def hosts_interleaved(spark: SparkSession, d: str) -> DataFrame:
    """Hosts in use in an order that spreads neighbours."""
    h = table(spark, d, "cc_hosts").where("retired_at IS NULL")
    return R.interleaved(h, "id", "host").select("id", "host", F.pmod("id", F.lit(7)).alias("stride"))


@query("SELECT host, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM cc_urls WHERE truncated <> '' AND host IS NOT NULL GROUP BY 1")
def host_groups(spark: SparkSession, d: str) -> DataFrame:
    """Truncated captures grouped into lists per host, in bounded blocks, then summed up per host."""
    lists = R.grouped(table(spark, d, "cc_urls").where("truncated <> ''").select("host", "id", "url"), "host", ["id", "url"])
    return lists.groupBy("host").agg(F.sum("n").alias("n"), F.min(F.get("items", F.lit(0))["id"]).alias("first_id"), F.max(F.element_at("items", -1)["id"]).alias("last_id"))


@query(
    "WITH a AS (SELECT DISTINCT path AS key FROM profiles WHERE path IS NOT NULL), b AS (SELECT DISTINCT path AS key FROM cc_fetch WHERE path IS NOT NULL), c AS (SELECT DISTINCT path AS key FROM tool_runs WHERE path IS NOT NULL) "
    "SELECT 'only_left' AS reason, key FROM a WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT 'only_right', key FROM b WHERE key NOT IN (SELECT key FROM a) "
    "UNION ALL SELECT 'extra', key FROM c WHERE key NOT IN (SELECT key FROM a) AND key NOT IN (SELECT key FROM b)"
)
def path_lists_compared(spark: SparkSession, d: str) -> DataFrame:
    """Paths profiled but not fetched, fetched but not profiled, and run but neither."""
    k = lambda t: table(spark, d, t).select(F.col("path").alias("key"))
    return R.list_diff(k("profiles"), k("cc_fetch"), k("tool_runs"))


@query("SELECT count(*) AS n_missing FROM (SELECT DISTINCT path FROM profiles WHERE path IS NOT NULL EXCEPT SELECT path FROM tool_runs)")
def paths_never_run(spark: SparkSession, d: str) -> DataFrame:
    """Number of profiled files that no tool has seen."""
    p = table(spark, d, "profiles").where("path IS NOT NULL").select("path").distinct()
    return R.missing_from(p, table(spark, d, "tool_runs"), ["path"]).agg(F.count(F.lit(1)).alias("n_missing"))


@query("WITH t AS (SELECT id, digest, CASE WHEN digest IS NULL THEN 'skipped' WHEN id = min(id) OVER (PARTITION BY upper(regexp_replace(trim(digest), '^[A-Za-z0-9-]+:', ''))) THEN 'copied' ELSE 'skipped' END AS o FROM (SELECT DISTINCT id, digest FROM cc_urls)) SELECT o AS outcome, count(*) AS n FROM t GROUP BY 1")
def first_of_each_digest(spark: SparkSession, d: str) -> DataFrame:
    """Captures that bring a new content, and those that repeat one."""
    key = F.upper(F.regexp_replace(F.trim("digest"), r"^[A-Za-z0-9\-]+:", ""))
    return R.first_seen(table(spark, d, "cc_urls").select("id", "digest").distinct(), key, ["id"]).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT id, status_id, fetched_length, fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC NULLS LAST, status_id DESC NULLS LAST, fetched_length DESC NULLS LAST) AS r FROM cc_fetch) WHERE r = 1")
def latest_fetches(spark: SparkSession, d: str) -> DataFrame:
    """One fetch per capture, the latest: the stored rows and a later delivery merged by key."""
    f = table(spark, d, "cc_fetch").select("id", "status_id", "fetched_length", "fetched_at")
    cut_at = F.lit("2025-03-01").cast("timestamp_ntz")
    return R.upsert(f.where(F.col("fetched_at") < cut_at), f.where(~(F.coalesce(F.col("fetched_at") < cut_at, F.lit(False)))), ["id"], [F.col("fetched_at"), F.col("status_id"), F.col("fetched_length")])


@query(
    "WITH t AS (SELECT DISTINCT u.id, u.truncated, u.warc_length, f.fetched_digest IS NOT NULL AS same FROM cc_urls u LEFT JOIN (SELECT DISTINCT id, fetched_digest FROM cc_fetch WHERE fetched_digest IS NOT NULL) f ON f.id = u.id), "
    "s AS (SELECT CASE WHEN trim(truncated) <> '' THEN 'TRUNCATED' WHEN warc_length = 0 THEN 'EMPTY_PAYLOAD' WHEN warc_length IS NOT NULL THEN CASE WHEN same THEN 'ADDED_TO_REPOSITORY' ELSE 'ADDED_TO_REPOSITORY_DIFF_DIGEST' END END AS state FROM t) "
    "SELECT state, count(*) AS n FROM s GROUP BY 1"
)
def first_fetch_states(spark: SparkSession, d: str) -> DataFrame:
    """States that a first fetch of each capture would have, from recorded facts."""
    seen = table(spark, d, "cc_fetch").where("fetched_digest IS NOT NULL").select("id", "fetched_digest").distinct()
    urls = table(spark, d, "cc_urls").select("id", "truncated", "warc_length")
    rows = urls.join(seen, "id", "left").select("id", "truncated", "warc_length", F.col("fetched_digest").isNotNull().alias("same")).distinct()
    return rows.groupBy(FS.first_fetch(F.col("truncated"), F.col("warc_length"), F.col("same"), F.lit(False)).alias("state")).agg(F.count(F.lit(1)).alias("n"))


_STATES = "states(state_id, name) AS (VALUES " + ", ".join(f"({i}, '{s}')" for i, s in enumerate(FS.FETCH_STATES)) + ")"


@query(f"WITH {_STATES} SELECT f.id, f.status, s.state_id FROM cc_fetch_status f LEFT JOIN states s ON s.name = f.status")
def fetch_states(spark: SparkSession, d: str) -> DataFrame:
    """The statuses in use with the numbers that the table of states has for them."""
    return table(spark, d, "cc_fetch_status").select("id", "status", FS.state_id(F.col("status")).alias("state_id"))


@query(f"WITH {_STATES} SELECT s.name AS state, count(f.id) AS n FROM states s LEFT JOIN cc_fetch f ON f.status_id = s.state_id GROUP BY 1")
def fetches_by_state(spark: SparkSession, d: str) -> DataFrame:
    """Fetches by a table of states that is dropped and loaded again."""
    path = scratch(spark, "states")
    for _ in range(2):
        reload_states(spark, path)
    n = table(spark, d, "cc_fetch").groupBy(F.col("status_id").alias("id")).agg(F.count("id").alias("n"))
    return spark.read.parquet(path).join(n, "id", "left").select(F.col("status").alias("state"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    f"WITH {_STATES}, u AS (SELECT id, min(status) AS status FROM cc_urls GROUP BY 1), r AS (SELECT f.*, u.status AS http_status FROM cc_fetch f LEFT JOIN u ON u.id = f.id), "
    "t AS (SELECT *, CASE WHEN removed_at < fetched_at THEN 'REFETCHED_TIMEOUT' WHEN http_status IS NULL THEN 'REFETCHED_BAD_STATUS' WHEN http_status <> 200 THEN 'REFETCHED_NOT_200' WHEN http_length >= 0 AND fetched_length < http_length THEN 'REFETCHED_TRUNCATED' "
    "WHEN path IS NULL THEN 'REFETCHED_EXCEPTION_EMITTING' ELSE 'REFETCHED_SUCCESS' END AS state FROM r) SELECT t.state, s.state_id, count(*) AS n, count(DISTINCT t.id) AS n_urls FROM t JOIN states s ON s.name = t.state GROUP BY 1, 2"
)
def refetch_states(spark: SparkSession, d: str) -> DataFrame:
    """Every fetch with what became of it: answers by status, lengths that fall short, files that were not kept."""
    answers = table(spark, d, "cc_urls").where("id IS NOT NULL").groupBy("id").agg(F.min("status").alias("http_status"))
    f = table(spark, d, "cc_fetch").join(answers, "id", "left")
    state = FS.refetch(error=F.when(F.col("removed_at") < F.col("fetched_at"), "timeout"), http_status=F.col("http_status"), length=F.col("fetched_length"), expected=F.col("http_length"), emit_error=F.col("path").isNull())
    return f.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_urls")).withColumn("state_id", FS.state_id(F.col("state")))


@query(
    "WITH c AS (SELECT DISTINCT regexp_extract(warc_file_name, '^crawl-data/([^/]+)/', 1) AS crawl FROM cc_urls WHERE warc_file_name LIKE 'crawl-data/%/%') "
    "SELECT crawl, i::int AS shard, 'cc-index/collections/' || crawl || '/indexes/cdx-' || lpad(i::varchar, 5, '0') || '.gz' AS path FROM c, range(300) t(i)"
)
def index_shards(spark: SparkSession, d: str) -> DataFrame:
    """Names of the index files of every crawl that captures come from."""
    crawls = table(spark, d, "cc_urls").where("warc_file_name LIKE 'crawl-data/%/%'").select(F.regexp_extract("warc_file_name", "^crawl-data/([^/]+)/", 1).alias("crawl")).distinct()
    return shard_names(crawls)


@query("SELECT collection, count(*) AS n, sum(size)::bigint AS bytes FROM profiles WHERE collection = split_part(path, '/', 1) GROUP BY 1")
def collections(spark: SparkSession, d: str) -> DataFrame:
    """Profiles by collection, where that is the first part of the path; a query from a template."""
    table(spark, d, "profiles").createOrReplaceTempView("profiles_now")
    return spark.sql(fill_template("SELECT collection, count(*) AS n, sum(size) AS bytes FROM ${t} WHERE collection = split(path, '/')[0] GROUP BY collection", {"t": "profiles_now"}))


@query(
    "SELECT host, substr(string_agg(DISTINCT trim(languages), ' ' ORDER BY trim(languages)), 1, 10000) AS languages FROM cc_urls WHERE host IS NOT NULL AND trim(languages) <> '' GROUP BY 1"
)
def host_languages(spark: SparkSession, d: str) -> DataFrame:
    """Languages of each host as one export cell. Pairs are made distinct first, so a list is as long as there are languages."""
    pairs = table(spark, d, "cc_urls").select("host", F.trim("languages").alias("l")).where("host IS NOT NULL AND l <> ''").distinct()
    return export_cells(pairs.groupBy("host").agg(F.collect_list("l").alias("languages")), ["host", "languages"]).select(F.col("host").cast("int").alias("host"), "languages")


@query("SELECT * FROM (SELECT host, count(*) AS n FROM cc_urls WHERE host IS NOT NULL GROUP BY 1 ORDER BY n DESC, host LIMIT 20)")
def largest_hosts(spark: SparkSession, d: str) -> DataFrame:
    """The twenty hosts with the most captures."""
    return R.page(table(spark, d, "cc_urls").where("host IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("n")).withColumn("neg", -F.col("n")), ["neg", "host"], 20).drop("neg")


_IP = r"'^(\d{1,3}\.\d{1,3}\.\d{1,3})\.(\d{1,3})$'"
_OCTETS_FIT = " AND ".join(f"split_part(trim(ip_address), '.', {k})::int <= 255" for k in range(1, 5))
_PLACE = f"CASE WHEN regexp_matches(trim(ip_address), {_IP}) AND {_OCTETS_FIT} THEN regexp_extract(trim(ip_address), {_IP}, 1) || CASE WHEN regexp_extract(trim(ip_address), {_IP}, 2)::int < 100 THEN ' low' ELSE ' high' END END"


def _address_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Two blocks for each net that a host is in."""
    net = F.regexp_extract(F.trim("ip_address"), r"^(\d{1,3}\.\d{1,3}\.\d{1,3})\.\d{1,3}$", 1)
    nets = table(spark, d, "cc_hosts").select(net.alias("net")).where("net <> ''").distinct()
    ends = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(n).alias("n")) for a, b, n in ((".0", ".99", " low"), (".100", ".255", " high")))))
    return nets.select("net", ends.alias("e")).select(F.concat("net", "e.a").alias("first_ip"), F.concat("net", "e.b").alias("last_ip"), F.concat("net", "e.n").alias("place"))


@query(f"SELECT id, {_PLACE} AS place FROM cc_hosts")
def hosts_by_address_block(spark: SparkSession, d: str) -> DataFrame:
    """The address block of every host: a range join by buckets."""
    return R.locate(table(spark, d, "cc_hosts").select("id", "ip_address"), "ip_address", _address_blocks(spark, d), ["place"]).select("id", "place")


@query(f"SELECT id, host, coalesce({_PLACE}, country) AS country FROM cc_hosts")
def hosts_relocated(spark: SparkSession, d: str) -> DataFrame:
    """Hosts with the country column updated from where their addresses lie."""
    hosts = table(spark, d, "cc_hosts")
    patch = hosts_by_address_block(spark, d).select("id", F.col("place").alias("country"))
    return R.update_from(hosts, patch, "id", ["country"]).select("id", "host", "country")


@query(f"WITH t AS (SELECT {_HOST} AS h FROM cc_urls WHERE url IS NOT NULL) SELECT CASE WHEN regexp_full_match(regexp_extract(h, '\\.([^.]+)$', 1), '\\d+') THEN '' ELSE regexp_extract(h, '\\.([^.]+)$', 1) END AS tld, count(*) AS n FROM t GROUP BY 1")
def tlds_as_written(spark: SparkSession, d: str) -> DataFrame:
    """Captures per top-level domain in the letter case in which it stands."""
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#: ]*)", 1)
    return table(spark, d, "cc_urls").where("url IS NOT NULL").groupBy(U.host_tld(host, lower=False).alias("tld")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT id, CASE WHEN http_length >= 0 THEN http_length END AS announced, CASE WHEN fetched_length >= 0 THEN fetched_length END AS fetched FROM cc_fetch")
def content_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Lengths as headers have them; -1 and what is no number are null."""
    text = lambda c: F.concat(F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(""))
    return table(spark, d, "cc_fetch").select("id", content_length(text("http_length")).alias("announced"), content_length(text("fetched_length")).alias("fetched"))


@query(f"SELECT u.id, m.name AS mime FROM cc_urls u JOIN cc_mimes m ON m.id = u.mime WHERE contains({_NORMAL.format('m.name')}, 'pdf')")
def captures_of_mime(spark: SparkSession, d: str) -> DataFrame:
    """Captures whose mime contains a word."""
    named = R.star(table(spark, d, "cc_urls").select("id", "mime"), {"mime": (table(spark, d, "cc_mimes"), "id", "name")})
    return of_mime(named, normalize_mime(F.col("mime_name")), "pdf").select("id", F.col("mime_name").alias("mime"))


@query("SELECT 20 AS n, true AS inside, true AS again")
def picked_pages(spark: SparkSession, d: str) -> DataFrame:
    """Twenty files at random and of each a page at random: how many, whether each page is one of its file, and whether the pick is the same from another layout."""
    files = table(spark, d, "documents").where("pages > 0").select("doc_id", "pages")
    once, again = (R.page_of_each(R.shuffled_pick(x, 20, "doc_id", 7), "doc_id", "pages", 7) for x in (files, files.repartition(5)))
    both = once.join(again.select("doc_id", F.col("page").alias("other")), "doc_id", "left")
    return both.agg(F.count(F.lit(1)).cast("int").alias("n"), F.every(F.col("page").between(1, F.col("pages"))).alias("inside"), F.every(F.col("page").eqNullSafe(F.col("other"))).alias("again"))


@query("SELECT count(*) AS rows, count(DISTINCT id) AS ids FROM cc_fetch")
def rows_seen(spark: SparkSession, d: str) -> DataFrame:
    """Rows counted while they are written, beside the ids that were written."""
    rows, seen = R.observed(table(spark, d, "cc_fetch"), "rows_seen")
    path = scratch(spark, "fetches")
    rows.write.parquet(path)
    return spark.read.parquet(path).agg(F.lit(seen.get["rows"]).cast("bigint").alias("rows"), F.count_distinct("id").alias("ids"))


@query("SELECT upper(regexp_replace(trim(digest), '^[A-Za-z0-9-]+:', '')) AS digest, count(*) AS n FROM cc_urls WHERE digest IS NOT NULL GROUP BY 1")
def digest_counts(spark: SparkSession, d: str) -> DataFrame:
    """Captures per content, largest first."""
    return R.digest_counts(table(spark, d, "cc_urls"), F.upper(F.regexp_replace(F.trim("digest"), r"^[A-Za-z0-9\-]+:", "")))
