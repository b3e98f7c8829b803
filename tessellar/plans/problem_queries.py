"""Queries p1 to p3: log entries, orphan references, hot keys; each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.common import table
from tessellar.operators import hot_keys as H
from tessellar.operators import log_entries as G
from tessellar.operators import orphans as O

REFERENCES = (
    O.Reference("cc_urls", "host", "cc_hosts", "id", "added_at", "retired_at"),
    O.Reference("cc_fetch", "status_id", "cc_fetch_status", "id", "added_at", "retired_at"),
    O.Reference("profiles", "path", "cc_fetch", "path", "fetched_at", "removed_at"),
    O.Reference("cc_fetch", "id", "cc_urls", "id"),
    O.Reference("tool_runs", "path", "profiles", "path"),
)
#: With the texts, which p2_found and the SQL of p2_report leave out.
ALL_REFERENCES = (
    *REFERENCES,
    O.Reference("documents", "host", "cc_hosts", "id", "added_at", "retired_at"),
    O.Reference("documents", "path", "profiles", "path"),
)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Log entries of all runs with their header fields."""
    return G.entries(table(spark, d, "tool_runs"))


def p1_messages(spark: SparkSession, d: str) -> DataFrame:
    """The same with messages."""
    return G.entries(table(spark, d, "tool_runs"), messages=True)


def p1_templates(spark: SparkSession, d: str) -> DataFrame:
    """Leaf templates of the lines that might begin an entry, with the number of different lines of each and what its slots mean."""
    parts = G.partition(G.candidate_lines(table(spark, d, "tool_runs")).select("seq").distinct())
    n = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n_sequences"))
    t = G.template_fields(parts).join(n, "part")
    return t.select(F.concat_ws("", F.transform("template", lambda x: x)).alias("template"), "n_sequences", "s.is_header", "s.opens")


def _orphans(spark: SparkSession, d: str, references: tuple[O.Reference, ...] = REFERENCES) -> DataFrame:
    t = lambda n: table(spark, d, n)
    sources = {
        "cc_urls": O.Source(t("cc_urls"), F.col("id"), "loaded_at"),
        "cc_fetch": O.Source(t("cc_fetch"), F.col("id"), "fetched_at"),
        "profiles": O.Source(t("profiles"), F.col("path"), "profiled_at"),
        "tool_runs": O.Source(t("tool_runs"), F.col("run_id"), "started_at"),
        "cc_hosts": O.Source(t("cc_hosts"), F.col("id"), "added_at"),
        "cc_fetch_status": O.Source(t("cc_fetch_status"), F.col("id"), "added_at"),
    }
    if any(r.child == "documents" for r in references):
        sources["documents"] = O.Source(t("documents"), F.col("doc_id"), "extracted_at")
    return O.find_orphans(sources, references, compare={"path": O.plain_path})


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Direct orphans: rows whose reference is live nowhere at their own time."""
    return _orphans(spark, d).where("kind = 'direct'").select("src_table", "row_key", "period")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Direct and inherited orphans per table and month."""
    return O.per_table_and_period(_orphans(spark, d))


def p2_report_all(spark: SparkSession, d: str) -> DataFrame:
    """The same down the whole foreign-key graph, with documents whose host is not live or whose file is an orphan."""
    return O.per_table_and_period(_orphans(spark, d, ALL_REFERENCES))


def _hot(spark: SparkSession, d: str) -> DataFrame:
    urls = table(spark, d, "cc_urls")
    states = H.key_states(urls, ["host", "mime"], "warc_length", "captured_at")
    dims = H.dimension_states({"host": (table(spark, d, "cc_hosts"), "id", F.col("host")), "mime": (table(spark, d, "cc_mimes"), "id", F.col("name"))})
    return H.joined_states(states, dims, H.all_rows(urls))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Hosts and mimes that hold at least 2 % of all captures."""
    return H.heavy_keys(_hot(spark, d), 2).select("field_name", "key_id")


def p3_key_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Captures, summed length and latest capture per host and per mime."""
    return _hot(spark, d).select("field_name", "key_id", "n_rows", F.col("sum_measure").alias("sum_length"), F.col("latest").alias("latest_capture"), "n_dim", "joined_rows", F.col("joined_sum").alias("joined_length"))


def p3_roll_up(spark: SparkSession, d: str) -> DataFrame:
    """The same rolled up to tidy mime names and to host labels in lower case."""
    tidy = F.trim(F.regexp_replace(F.lower(F.coalesce("label", F.lit(""))), r'^\s*"|"\s*$|;.*$', ""))
    return H.roll_up(_hot(spark, d), tidy).select("field_name", "label", "n_keys", "n_rows", F.col("sum_measure").alias("sum_length"), F.col("latest").alias("latest_capture"))


_LIVE = {
    "cc_urls": ("cc_urls c", "c.host", "c.loaded_at", "c.id::varchar", "cc_hosts p", "p.id = c.host", "p.added_at", "p.retired_at"),
    "cc_fetch": ("cc_fetch c", "c.status_id", "c.fetched_at", "c.id::varchar", "cc_fetch_status p", "p.id = c.status_id", "p.added_at", "p.retired_at"),
}
_PLAIN = r"lower(regexp_replace(replace({}, '\', '/'), '^(\./)+', ''))"


def _direct_sql() -> str:
    parts = [
        f"SELECT '{name}' AS src_table, {key} AS row_key, strftime({at}, '%Y-%m') AS period FROM {child} WHERE {ref} IS NOT NULL AND {at} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} WHERE {on} AND {since} <= {at} AND ({until} IS NULL OR {at} < {until}))"
        for name, (child, ref, at, key, parent, on, since, until) in _LIVE.items()
    ]
    parts.append(
        "SELECT 'profiles', c.path, strftime(c.profiled_at, '%Y-%m') FROM (SELECT *, " + _PLAIN.format("path") + " AS k FROM profiles) c "
        "WHERE c.k IS NOT NULL AND c.profiled_at IS NOT NULL AND NOT EXISTS (SELECT 1 FROM (SELECT *, " + _PLAIN.format("path") + " AS k FROM cc_fetch) p "
        "WHERE p.k = c.k AND p.fetched_at <= c.profiled_at AND (p.removed_at IS NULL OR c.profiled_at < p.removed_at))"
    )
    return " UNION ".join(parts)


# A record is inherited if every record of the key that it refers to is an orphan; of fetches, every one live at the profile's time.
_CASCADE_SQL = f"""
WITH direct AS ({_direct_sql()}),
url_keys AS (SELECT u.id, bool_and(d.row_key IS NOT NULL) AS bad FROM cc_urls u LEFT JOIN direct d ON d.src_table = 'cc_urls' AND d.row_key = u.id::varchar AND d.period IS NOT DISTINCT FROM strftime(u.loaded_at, '%Y-%m') GROUP BY 1),
fetches AS (SELECT id, {_PLAIN.format("path")} AS k, fetched_at, removed_at, strftime(fetched_at, '%Y-%m') AS period FROM cc_fetch),
o1 AS (SELECT DISTINCT 'cc_fetch' AS src_table, f.id::varchar AS row_key, f.period FROM fetches f JOIN url_keys u ON u.id = f.id WHERE u.bad),
bad_fetch AS (SELECT row_key, period FROM direct WHERE src_table = 'cc_fetch' UNION SELECT row_key, period FROM o1),
judged AS (SELECT f.*, b.row_key IS NOT NULL AS bad FROM fetches f LEFT JOIN bad_fetch b ON b.row_key = f.id::varchar AND b.period IS NOT DISTINCT FROM f.period WHERE f.k IS NOT NULL),
profile_keys AS (SELECT path, {_PLAIN.format("path")} AS k, profiled_at AS t, strftime(profiled_at, '%Y-%m') AS period FROM profiles),
o2 AS (SELECT DISTINCT 'profiles' AS src_table, p.path AS row_key, p.period FROM profile_keys p WHERE p.t IS NOT NULL AND p.k IN (SELECT k FROM judged WHERE bad)
  AND NOT EXISTS (SELECT 1 FROM judged s WHERE NOT s.bad AND s.k = p.k AND s.fetched_at <= p.t AND (s.removed_at IS NULL OR p.t < s.removed_at))),
bad_profiles AS (SELECT row_key, period FROM direct WHERE src_table = 'profiles' UNION SELECT row_key, period FROM o2),
bad_paths AS (SELECT p.k FROM profile_keys p LEFT JOIN bad_profiles b ON b.row_key = p.path AND b.period IS NOT DISTINCT FROM p.period WHERE p.k IS NOT NULL GROUP BY 1 HAVING bool_and(b.row_key IS NOT NULL)),
o3 AS (SELECT DISTINCT 'tool_runs' AS src_table, t.run_id::varchar AS row_key, strftime(t.started_at, '%Y-%m') AS period FROM tool_runs t WHERE {_PLAIN.format("t.path")} IN (SELECT k FROM bad_paths)),
inherited AS (SELECT * FROM (SELECT * FROM o1 UNION SELECT * FROM o2 UNION SELECT * FROM o3) EXCEPT SELECT * FROM direct)"""
_REPORT_SQL = f"""{_CASCADE_SQL}
SELECT src_table, period, count(*) FILTER (kind = 'd') AS n_direct, count(*) FILTER (kind = 'i') AS n_inherited
FROM (SELECT *, 'd' AS kind FROM direct UNION ALL SELECT *, 'i' FROM inherited) GROUP BY 1, 2
"""

# The same keys and orphans as in p2_report, then the documents.
_REPORT_ALL_SQL = f"""{_CASCADE_SQL},
direct_docs AS (SELECT DISTINCT 'documents' AS src_table, doc_id::varchar AS row_key, strftime(extracted_at, '%Y-%m') AS period FROM documents c WHERE host IS NOT NULL AND extracted_at IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM cc_hosts p WHERE p.id = c.host AND p.added_at <= c.extracted_at AND (p.retired_at IS NULL OR c.extracted_at < p.retired_at))),
o4 AS (SELECT DISTINCT 'documents' AS src_table, doc_id::varchar AS row_key, strftime(extracted_at, '%Y-%m') AS period FROM documents WHERE {_PLAIN.format("path")} IN (SELECT k FROM bad_paths)),
kinds AS (SELECT *, 'd' AS kind FROM direct UNION ALL SELECT *, 'i' FROM inherited UNION ALL SELECT *, 'd' FROM direct_docs UNION ALL SELECT *, 'i' FROM (SELECT * FROM o4 EXCEPT SELECT * FROM direct_docs))
SELECT src_table, period, count(*) FILTER (kind = 'd') AS n_direct, count(*) FILTER (kind = 'i') AS n_inherited FROM kinds GROUP BY 1, 2
"""

_STATES = """states AS (
  SELECT 'host' AS field_name, host::bigint AS key_id, count(*) AS n_rows, sum(warc_length)::bigint AS sum_length, max(captured_at) AS latest_capture FROM cc_urls GROUP BY 2
  UNION ALL SELECT 'mime', mime::bigint, count(*), sum(warc_length)::bigint, max(captured_at) FROM cc_urls GROUP BY 2),
dims AS (SELECT 'host' AS field_name, id::bigint AS key_id, count(*) AS n_dim, min(host) AS label FROM cc_hosts GROUP BY 2
  UNION ALL SELECT 'mime', id::bigint, count(*), min(name) FROM cc_mimes GROUP BY 2)"""

QUERIES = {"p1_found": p1_found, "p1_messages": p1_messages, "p1_templates": p1_templates, "p2_found": p2_found, "p2_report": p2_report, "p2_report_all": p2_report_all, "p3_found": p3_found, "p3_key_profiles": p3_key_profiles, "p3_roll_up": p3_roll_up}

ORACLES = {
    "p2_found": _direct_sql(),
    "p2_report": _REPORT_SQL,
    "p2_report_all": _REPORT_ALL_SQL,
    "p3_found": """SELECT 'host' AS field_name, host::bigint AS key_id FROM cc_urls WHERE host IS NOT NULL GROUP BY host HAVING count(*) * 100 >= 2 * (SELECT count(*) FROM cc_urls)
UNION ALL SELECT 'mime', mime::bigint FROM cc_urls WHERE mime IS NOT NULL GROUP BY mime HAVING count(*) * 100 >= 2 * (SELECT count(*) FROM cc_urls)""",
    "p3_key_profiles": f"""WITH {_STATES} SELECT s.field_name, s.key_id, n_rows, sum_length, latest_capture, coalesce(n_dim, 0) AS n_dim,
n_rows * greatest(coalesce(n_dim, 0), 1) AS joined_rows, sum_length * greatest(coalesce(n_dim, 0), 1) AS joined_length FROM states s LEFT JOIN dims d ON s.field_name = d.field_name AND s.key_id = d.key_id""",
    "p3_roll_up": f"""WITH {_STATES} SELECT s.field_name, trim(regexp_replace(lower(coalesce(label, '')), '^\\s*"|"\\s*$|;.*$', '', 'g')) AS label, count(s.key_id) AS n_keys, sum(n_rows)::bigint AS n_rows,
sum(sum_length)::bigint AS sum_length, max(latest_capture) AS latest_capture FROM states s LEFT JOIN dims d ON s.field_name = d.field_name AND s.key_id = d.key_id GROUP BY 1, 2""",
}
