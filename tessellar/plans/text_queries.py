"""Queries over extracted texts and further report formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.common import table
from tessellar.operators import text_compare as TC

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_TOKENS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_ALPHA = r"list_filter(t, lambda x: regexp_full_match(x, '\p{L}+'))"


@query(
    f"WITH d AS (SELECT doc_id, {_TOKENS} AS t FROM documents WHERE text IS NOT NULL) SELECT doc_id, len(t)::int AS n_tokens, len(list_distinct(t))::int AS n_types, len({_ALPHA})::int AS n_alphabetic, "
    f"len(list_distinct({_ALPHA}))::int AS n_alphabetic_types FROM d"
)
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    """Token statistics of every text."""
    return TC.token_stats(table(spark, d, "documents").where("text IS NOT NULL"), ["doc_id"], "text").drop("n_common", "oov")


_LABEL = "lower(regexp_extract(lang, '^[A-Za-z]{2}'))"


@query(
    rf"""WITH d AS (SELECT doc_id, nullif({_LABEL}, '') AS lang, {_TOKENS} AS t FROM documents WHERE text IS NOT NULL),
c AS (SELECT lang, token, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, token) AS r FROM (SELECT DISTINCT doc_id, lang, unnest(t) AS token FROM d WHERE lang IS NOT NULL) WHERE regexp_full_match(token, '\p{{L}}{{2,}}') GROUP BY lang, token),
w AS (SELECT doc_id, unnest({_ALPHA}) AS token FROM d),
n AS (SELECT doc_id, count(*) AS n FROM w GROUP BY 1),
h AS (SELECT w.doc_id, c.lang, count(*) AS n FROM w JOIN c ON c.token = w.token WHERE c.r <= 1000 GROUP BY ALL),
b AS (SELECT doc_id, lang, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) AS r FROM h)
SELECT d.doc_id, b.lang AS lang_detected, coalesce(n.n, 0)::bigint AS n_alphabetic, coalesce(b.n, 0)::bigint AS n_common, CASE WHEN n.n IS NULL THEN -1.0 ELSE 1 - coalesce(b.n, 0) / n.n END::double AS oov
FROM (SELECT DISTINCT doc_id FROM d) d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id AND b.r = 1"""
)
def text_languages(spark: SparkSession, d: str) -> DataFrame:
    """Detected language and share of uncommon words of every text, by the thousand commonest words of each labelled language."""
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    label = F.lower(F.regexp_extract("lang", "^[A-Za-z]{2}", 0))
    common = TC.common_words(docs.select(F.when(label != "", label).alias("lang"), "text"), "lang", "text")
    return TC.language_stats(docs, ["doc_id"], "text", common)


@query(f"WITH d AS (SELECT DISTINCT doc_id, unnest({_TOKENS}) AS token FROM documents WHERE text IS NOT NULL) SELECT token, count(*) AS n_docs FROM d GROUP BY 1")
def token_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold each token."""
    bag = TC.token_bag(table(spark, d, "documents").where("text IS NOT NULL"), ["doc_id"], "text")
    return bag.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))


@query(
    f"""WITH d AS (SELECT path, extractor AS tool, {_TOKENS} AS t FROM documents WHERE text IS NOT NULL AND path IS NOT NULL AND extractor IS NOT NULL),
bag AS (SELECT path, tool, token, count(*) AS n FROM (SELECT path, tool, unnest(t) AS token FROM d) GROUP BY ALL),
tot AS (SELECT DISTINCT d.path, d.tool, coalesce(types, 0) AS types, coalesce(tokens, 0) AS tokens FROM d LEFT JOIN (SELECT path, tool, count(*) AS types, sum(n) AS tokens FROM bag GROUP BY ALL) b ON b.path = d.path AND b.tool = d.tool),
sh AS (SELECT a.path, a.tool AS tool_a, b.tool AS tool_b, count(*) AS types, sum(least(a.n, b.n)) AS tokens FROM bag a JOIN bag b ON a.path = b.path AND a.token = b.token AND a.tool < b.tool GROUP BY ALL)
SELECT a.path, a.tool AS tool_a, b.tool AS tool_b, CASE WHEN a.types + b.types > 0 THEN 2 * coalesce(sh.types, 0) / (a.types + b.types) END::double AS dice,
CASE WHEN a.tokens + b.tokens > 0 THEN 2 * coalesce(sh.tokens, 0) / (a.tokens + b.tokens) END::double AS overlap
FROM tot a JOIN tot b ON a.path = b.path AND a.tool < b.tool LEFT JOIN sh ON sh.path = a.path AND sh.tool_a = a.tool AND sh.tool_b = b.tool"""
)
def extractions_compared(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of every two extractors on the files that both have read."""
    docs = table(spark, d, "documents").where("text IS NOT NULL AND path IS NOT NULL AND extractor IS NOT NULL")
    return TC.pairwise(docs.select("path", F.col("extractor").alias("tool"), "text"), "path", "tool", "text")


@query(
    "WITH p AS (SELECT DISTINCT path FROM profiles WHERE path IS NOT NULL), e AS (SELECT path, max(octet_length(encode(text))) AS bytes FROM documents WHERE path IS NOT NULL AND text IS NOT NULL GROUP BY 1) "
    "SELECT CASE WHEN e.path IS NULL THEN 'MISSING' WHEN bytes > 20000 THEN 'TOO_LONG' WHEN bytes = 0 THEN 'EMPTY' ELSE 'OK' END AS status, count(*) AS n FROM p LEFT JOIN e ON e.path = p.path GROUP BY 1"
)
def extract_states(spark: SparkSession, d: str) -> DataFrame:
    """Profiled files by the state of their longest extract."""
    p = table(spark, d, "profiles").where("path IS NOT NULL").select("path").distinct()
    e = table(spark, d, "documents").where("path IS NOT NULL AND text IS NOT NULL").groupBy("path").agg(F.max(F.octet_length("text")).alias("bytes"))
    joined = p.join(e, "path", "left")
    return joined.groupBy(TC.extract_status(F.col("bytes"), F.col("bytes").isNotNull(), 20_000).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(r"SELECT source, count(*) AS n, sum(len(regexp_extract_all(text, '(?i)warning')))::bigint AS n_marks, count(*) FILTER (regexp_matches(text, '(?m)^> ')) AS n_quoted FROM documents WHERE text IS NOT NULL GROUP BY 1")
def pattern_counts(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of a pattern, and texts with a line that matches another, per source."""
    t = F.col("text")
    rows = table(spark, d, "documents").where("text IS NOT NULL")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.regexp_count(t, F.lit("(?i)warning"))).alias("n_marks"), F.count(F.when(t.rlike(r"(?m)^> "), 1)).alias("n_quoted"))
