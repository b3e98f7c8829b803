"""Queries p4 to p8 and their SQL."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.common import cut, join_sized, scratch, shared_dir, table
from tessellar.functions.strings import normalize_mime
from tessellar.functions.urls import tidy_url
from tessellar.llm import langid as G
from tessellar.llm import leakage as L
from tessellar.llm import ledger as E
from tessellar.llm import mixing as M
from tessellar.llm import sketches as S
from tessellar.operators.record_filter import has_probability, load_filter

#: Record filters are configuration: more than this are refused.
MOST_FILTERS = 1000


_GROUPS = ["day", "tld", "mime"]
#: Stands for the day of captures without one until results are labelled; no capture is of that day.
_UNDATED = "DATE '0001-01-01'"


def _label_days(rows: DataFrame) -> DataFrame:
    """Days as yyyy-MM-dd, '(none)' for captures without one; null, as the union over all days, stays."""
    return rows.withColumn("day", F.when(F.col("day") == F.expr(_UNDATED), S.NONE).otherwise(F.date_format("day", "yyyy-MM-dd")))


def _captures(spark: SparkSession, d: str) -> tuple[DataFrame, dict, dict]:
    """Captures with their host's tld and mime's name, and the groups and identifiers to count; a tld or mime that is not known is '(none)', a day _UNDATED."""
    urls = table(spark, d, "cc_urls").select("captured_at", "host", "mime", "digest")
    hosts = table(spark, d, "cc_hosts").where("id IS NOT NULL").groupBy(F.col("id").alias("host")).agg(F.min("tld").alias("tld"))
    mimes = table(spark, d, "cc_mimes").where("id IS NOT NULL").groupBy(F.col("id").alias("mime")).agg(F.min("name").alias("mime_name"))
    rows = join_sized(urls, hosts, ["host"], "left", salt_by=["digest", "captured_at"])
    rows = join_sized(rows, mimes, ["mime"], "left", salt_by=["digest", "captured_at"])
    tld = S.tidy_label(F.col("tld"))
    groups = {"day": F.coalesce(F.to_date("captured_at"), F.expr(_UNDATED)), "tld": tld, "mime": S.tidy_label(F.col("mime_name"))}
    return rows, groups, {"digest": S.tidy_digest(F.col("digest")), "host": F.col("host"), "tld": F.when(tld != S.NONE, tld)}


def _capture_states(spark: SparkSession, d: str) -> DataFrame:
    """(day, tld, mime, field, bucket, bits) of digests and hosts, and of tlds per day under field 'tld'."""
    return S.sketch(*_captures(spark, d))


def p4_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct digests and hosts for each day, tld and mime, for their unions, and distinct tlds per day, with standard error and bounds.

    A null in day, tld or mime stands for the union over all its values; '(none)' for captures without one.
    """
    sets = [_GROUPS, ["day", "tld"], ["day", "mime"], ["tld", "mime"], ["day"], ["tld"], ["mime"], []]
    return _label_days(S.estimate(S.unions(_capture_states(spark, d), _GROUPS, sets, own={"tld": [["day"]]}), _GROUPS))


def p4_bounds(spark: SparkSession, d: str) -> DataFrame:
    """The estimates beside exact counts: for single groups and unions, how many there are, and whether the bounds hold as often as they should.

    ``within``: at least 90 % of the groups' exact counts lie inside their 95 % bounds, half a count allowed, and none is off by more than
    five standard errors and one. The exact side holds every identifier; it is the check of the method, not a way to count.
    """
    rows, groups, fields = _captures(spark, d)
    sets = [_GROUPS, ["day"], ["tld"], ["mime"], []]
    own = {"tld": [["day"]]}
    estimated = S.estimate(S.unions(S.sketch(rows, groups, fields), _GROUPS, sets, own), _GROUPS)
    both = S.beside(S.exact(rows, groups, fields, sets, own), estimated, _GROUPS)
    kind = F.concat_ws(",", *(F.when(F.col(g).isNotNull(), g) for g in _GROUPS))
    inside = F.coalesce(F.col("n_exact").between(F.col("low") - 0.5, F.col("high") + 0.5), F.lit(False))
    near = F.coalesce(F.abs(F.col("n_distinct") - F.col("n_exact")) <= 5 * F.col("std_error") + 1, F.lit(False))
    out = both.groupBy(kind.alias("grouped_by"), "field").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n_exact").alias("n_identifiers"), F.avg(inside.cast("int")).alias("inside"), F.every(near).alias("near"))
    return out.select("grouped_by", "field", "n_groups", "n_identifiers", (F.col("near") & (F.col("inside") >= 0.9)).alias("within"))


def p4_states(spark: SparkSession, d: str) -> DataFrame:
    """Size of the mergeable states per day: buckets in use and bits set."""
    return _label_days(_capture_states(spark, d).groupBy("day", "field").agg(F.count(F.lit(1)).alias("n_buckets"), F.sum(F.bit_count("bits")).alias("n_bits")))


def _strata(spark: SparkSession, d: str, until: Column | None = None) -> tuple[DataFrame, list[tuple[str, float]], list[int], str]:
    """Keys by first epoch, name and rate of each stratum, epochs (months of loaded_at, counted as year * 12 + month), and the ledger's name.

    The name stands for the tables' path and the sampling filters, so that every run over them finds the ledger of the runs before.
    ``until``: only captures for which it holds.
    """
    confs = table(spark, d, "record_filters").where("filter_json IS NOT NULL").orderBy("filter_name", "filter_json").limit(MOST_FILTERS + 1).collect()
    if len(confs) > MOST_FILTERS:
        raise ValueError(f"more than {MOST_FILTERS} filters")
    urls = table(spark, d, "cc_urls").select("url", "mime", "detected_mime", "status", "loaded_at")
    urls = urls if until is None else urls.where(until)
    names = lambda t, key, out: table(spark, d, t).where("id IS NOT NULL").groupBy(F.col("id").alias(key)).agg(F.min(normalize_mime(F.col("name"))).alias(out))
    rows = join_sized(urls, names("cc_mimes", "mime", "mime_name"), ["mime"], "left", salt_by=["url"])
    rows = join_sized(rows, names("cc_detected_mimes", "detected_mime", "detected_name"), ["detected_mime"], "left", salt_by=["url"])
    rates: dict[str, float] = {}
    strata = []
    for c in confs:
        if has_probability(c["filter_json"]):
            f = load_filter(c["filter_json"])
            rates |= {f"{c['filter_name']}|{k}": v for k, v in f.rates().items()}
            strata.append(F.concat(F.lit(f"{c['filter_name']}|"), f.stratum(F.col("status"), F.col("mime_name"), F.col("detected_name"), tidy=True)))
    url = tidy_url(F.col("url"))
    named = list(rates.items()) or [("", 0.0)]
    seen = E.first_seen(rows, F.array(*strata) if strata else F.array(F.lit(None).cast("string")), F.when(url != "", url), F.year("loaded_at") * 12 + F.month("loaded_at") - 1, {n: i for i, (n, _) in enumerate(named)})
    keys = E.sorted_keys(seen, scratch(spark, "keys"))
    sampling = [[c["filter_name"], c["filter_json"]] for c in confs if has_probability(c["filter_json"])]
    name = "ledger-" + hashlib.sha256(json.dumps([_full_path(spark, d), sampling]).encode()).hexdigest()[:32]
    return keys, named, [r[0] for r in keys.select("epoch").distinct().orderBy("epoch").collect()], name


def _full_path(spark: SparkSession, d: str) -> str:
    """``d`` with scheme and host and without a final slash, however it was given."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(d)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def _ledger(spark: SparkSession, d: str) -> tuple[DataFrame, list[tuple[str, float]], DataFrame]:
    keys, named, epochs, ledger = _strata(spark, d)
    return keys, named, E.grow(keys, {i: r for i, (_, r) in enumerate(named)}, f"{shared_dir(spark)}/{ledger}", epochs)


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    """Each sampling filter's urls, selected month by month of loading, with the month that selected them."""
    _, named, ledger = _ledger(spark, d)
    name = F.element_at(F.array(*(F.lit(n) for n, _ in named)), F.col("stratum") + 1)
    month = F.format_string("%04d-%02d", F.expr("epoch DIV 12"), F.expr("epoch % 12 + 1"))
    return ledger.select(F.substring_index(name, "|", 1).alias("filter_name"), F.regexp_replace(name, r"^[^|]*\|", "").alias("rule"), F.col("key").alias("url"), month.alias("selected_in"))


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rate aimed at and reached, per filter and rule."""
    keys, named, ledger = _ledger(spark, d)
    out = E.shares(keys, {i: r for i, (_, r) in enumerate(named)}, ledger)
    return out.select(F.element_at(F.array(*(F.lit(n) for n, _ in named)), F.col("stratum") + 1).alias("rule"), "n_keys", "n_selected", "rate", "reached")


def p5_lost(spark: SparkSession, d: str) -> DataFrame:
    """Urls that a run up to the middle of the newest but one month had selected and a later run over all captures has not: none.

    Both runs share a ledger of their own, and the later one reads the keys in another layout.
    """
    newest = table(spark, d, "cc_urls").agg(F.max("loaded_at").alias("t")).select(F.expr("add_months(trunc(t, 'MM'), -1) + INTERVAL 14 DAYS").alias("t")).first()["t"]
    path = scratch(spark, "ledger")
    before, named, epochs, _ = _strata(spark, d, F.col("loaded_at") < F.lit(newest))
    rates = {i: r for i, (_, r) in enumerate(named)}
    first = cut(E.grow(before, rates, path, epochs))
    after, _, epochs, _ = _strata(spark, d)
    second = E.grow(after.repartition(7), rates, path, epochs)
    name = F.element_at(F.array(*(F.lit(n) for n, _ in named)), F.col("stratum") + 1)
    return first.join(second, ["stratum", "key"], "left_anti").select(name.alias("rule"), F.col("key").alias("url"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of a held-out item."""
    return L.leaked(table(spark, d, "documents"), table(spark, d, "heldout_items"))


def p6_items(spark: SparkSession, d: str) -> DataFrame:
    """Each held-out item with the number of documents that give it away."""
    items = table(spark, d, "heldout_items")
    return L.leaked_items(L.leaked(table(spark, d, "documents"), items), items)


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """Each mix as a sequence of documents: order by slot, then offset."""
    return M.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached shares of tokens, and repeats, per mix and source."""
    return M.mixed(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p7_length_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares with sizes in characters, which SQL can count as well."""
    sized = table(spark, d, "documents").select("doc_id", "source", F.length("text").cast("bigint").alias("n_tokens"))
    out = M.mix(sized, table(spark, d, "mix_targets"))[1]
    return out.select("mix_name", "source", F.round("target_share", 9).alias("target_share"), F.round("aimed_share", 9).alias("aimed_share"), F.round("reached_share", 9).alias("reached_share"), "n_tokens", "most_repeats", "max_repeats")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Language stretches of documents whose label is absent or wrong or too simple."""
    return G.label_faults(G.language_stretches(table(spark, d, "documents"))).select("doc_id", "seg_no", "lang")


def p8_stretches(spark: SparkSession, d: str) -> DataFrame:
    """Every language stretch of every document, with its confidence."""
    return G.language_stretches(table(spark, d, "documents")).drop("n_segs")


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its language and confidence."""
    documents = table(spark, d, "documents")
    return G.document_languages(G.language_stretches(documents), documents)


def p8_covered(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document that its stretches cover, and that stretches are numbered from 1 without a gap."""
    per_doc = G.language_stretches(table(spark, d, "documents")).groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), (F.max("seg_no") == F.count(F.lit(1))).alias("numbered"))
    return per_doc.select("doc_id", "n_words", "numbered")


QUERIES = {
    f.__name__: f
    for f in (p4_distinct, p4_states, p4_bounds, p5_sample, p5_shares, p5_lost, p6_found, p6_items, p7_mix, p7_shares, p7_length_shares, p8_found, p8_stretches, p8_documents, p8_covered)
}

# Words as in the operator; runs of eight equal words, of which every case has one, find the alignments to compare.
_JOIN_HYPHENS = "regexp_replace({}, '([\\p{{L}}\\p{{N}}_])[-‐‑‒]([ \\t]*\\r?\\n[\\s>|]*)?([\\p{{L}}\\p{{N}}_])', '\\1\\3', 'g')"
_PLAIN = "regexp_replace(strip_accents(lower(text)), '[\\x{00AD}\\x{0300}-\\x{036F}\\x{200B}-\\x{200D}\\x{2060}\\x{FEFF}]', '', 'g')"
_WORDS = f"regexp_extract_all({_JOIN_HYPHENS.format(_JOIN_HYPHENS.format(_PLAIN))}, '[\\p{{L}}\\p{{N}}]+')"
_LEAKED = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, {_WORDS} AS w FROM heldout_items WHERE text IS NOT NULL),
dp AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, w FROM d WHERE len(w) >= 24),
dg AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS g FROM dp),
ip AS (SELECT item_id, unnest(range(1, len(w) - 6)) AS p, w FROM i WHERE len(w) >= 24),
ig AS (SELECT item_id, p, array_to_string(w[p:p + 7], ' ') AS g FROM ip),
c AS (SELECT DISTINCT doc_id, item_id, dg.p - ig.p AS shift FROM dg JOIN ig USING (g)),
x AS (SELECT c.doc_id, c.item_id, list_transform(range(greatest(1, 1 - shift), least(len(i.w), len(d.w) - shift) + 1), lambda k: CASE WHEN i.w[k] = d.w[k + shift] THEN 1 ELSE 0 END) AS same
  FROM c JOIN d USING (doc_id) JOIN i USING (item_id)),
leaked AS (SELECT DISTINCT doc_id, item_id FROM x WHERE len(same) >= 24 AND list_max(list_transform(range(1, len(same) - 22), lambda s: list_sum(same[s:s + 23]))) >= 22)"""

# Rules of the filters in their order; a quota never falls, so the last epoch's is the number selected.
_NORMAL = "trim(regexp_replace(regexp_replace(lower({}), '^\"|\"$', '', 'g'), '\\s+', ' ', 'g'))"
_SHARES = f"""WITH f AS (SELECT filter_name, filter_json::json AS j FROM record_filters WHERE filter_json LIKE '%"probability"%' OR filter_json LIKE '%"defaultProbability"%'),
f2 AS (SELECT *, coalesce(try_cast(j->>'defaultProbability' AS double), 1) AS thin, coalesce(try_cast(j->>'defaultInclude' AS boolean), false) AS rest,
  CASE WHEN json_type(j->'status') = 'ARRAY' THEN from_json(j->'status', '["int"]') WHEN j->>'status' IS NOT NULL THEN [(j->>'status')::int] ELSE []::int[] END AS ok FROM f),
e AS (SELECT filter_name, 1 AS k, 'exact.mimes' AS kind, unnest(from_json(coalesce(j->'exact'->'mimes', '[]'), '["json"]')) AS el FROM f2
  UNION ALL SELECT filter_name, 2, 'exact.detected_mimes', unnest(from_json(coalesce(j->'exact'->'detected_mimes', '[]'), '["json"]')) FROM f2
  UNION ALL SELECT filter_name, 3, 'regex.mimes', unnest(from_json(coalesce(j->'regex'->'mimes', '[]'), '["json"]')) FROM f2
  UNION ALL SELECT filter_name, 4, 'regex.detected_mimes', unnest(from_json(coalesce(j->'regex'->'detected_mimes', '[]'), '["json"]')) FROM f2),
r AS (SELECT filter_name, k, kind, CASE WHEN json_type(el) = 'VARCHAR' THEN el->>'$' ELSE el->>'pattern' END AS pattern, CASE WHEN json_type(el) = 'VARCHAR' THEN 1 ELSE coalesce(try_cast(el->>'probability' AS double), 1) END AS p FROM e),
u AS (SELECT DISTINCT u.id, lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*')) || regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', '') AS key, u.status,
  {_NORMAL.format('m.name')} AS m, {_NORMAL.format('d.name')} AS x FROM cc_urls u LEFT JOIN cc_mimes m ON m.id = u.mime LEFT JOIN cc_detected_mimes d ON d.id = u.detected_mime WHERE trim(url) <> ''),
s AS (SELECT u.id, u.key, f2.filter_name, f2.thin, f2.rest FROM u JOIN f2 ON len(f2.ok) = 0 OR list_contains(f2.ok, u.status)),
hit AS (SELECT u.id, u.key, r.filter_name, min_by(r.kind || ':' || r.pattern, r.k) AS rule, min_by(r.p, r.k) AS p FROM u JOIN r ON CASE r.k WHEN 1 THEN u.m = lower(r.pattern) WHEN 2 THEN u.x = lower(r.pattern) WHEN 3 THEN regexp_matches(u.m, r.pattern) ELSE regexp_matches(u.x, r.pattern) END GROUP BY ALL),
st AS (SELECT s.filter_name, s.key, CASE WHEN thin < 1 THEN 'default' ELSE coalesce(hit.rule, CASE WHEN rest THEN 'default' END) END AS rule, CASE WHEN thin < 1 THEN thin ELSE coalesce(hit.p, 1) END AS p
  FROM s LEFT JOIN hit ON hit.id = s.id AND hit.key = s.key AND hit.filter_name = s.filter_name),
n AS (SELECT filter_name || '|' || rule AS rule, max(p)::double AS rate, count(DISTINCT key) AS n_keys FROM st WHERE rule IS NOT NULL GROUP BY 1)
SELECT rule, n_keys, round(rate * n_keys)::bigint AS n_selected, rate, round(rate * n_keys) / n_keys AS reached FROM n"""

_LABEL = "coalesce(nullif(lower(regexp_replace(trim({}), '^\\.+', '')), ''), '(none)')"
_BOUNDS = f"""WITH h AS (SELECT id, min(tld) AS tld FROM cc_hosts WHERE id IS NOT NULL GROUP BY 1), m AS (SELECT id, min(name) AS name FROM cc_mimes WHERE id IS NOT NULL GROUP BY 1),
r AS (SELECT coalesce(strftime(captured_at, '%Y-%m-%d'), '(none)') AS day, {_LABEL.format('h.tld')} AS tld, {_LABEL.format('m.name')} AS mime, u.host::varchar AS host,
  nullif(upper(trim(regexp_replace(digest, '^\\s*[A-Za-z0-9\\-]+:', ''))), '') AS digest FROM cc_urls u LEFT JOIN h ON h.id = u.host LEFT JOIN m ON m.id = u.mime),
v AS (SELECT DISTINCT day, tld, mime, 'digest' AS field, digest AS x FROM r WHERE digest IS NOT NULL UNION ALL SELECT DISTINCT day, tld, mime, 'host', host FROM r WHERE host IS NOT NULL),
n AS (SELECT field, concat_ws(',', CASE WHEN grouping(day) = 0 THEN 'day' END, CASE WHEN grouping(tld) = 0 THEN 'tld' END, CASE WHEN grouping(mime) = 0 THEN 'mime' END) AS grouped_by, count(DISTINCT x) AS c
  FROM v GROUP BY GROUPING SETS ((field, day, tld, mime), (field, day), (field, tld), (field, mime), (field))
  UNION ALL SELECT 'tld', 'day', count(DISTINCT tld) FROM r WHERE tld <> '(none)' GROUP BY day)
SELECT grouped_by, field, count(*) AS n_groups, sum(c)::bigint AS n_identifiers, true AS within FROM n GROUP BY 1, 2"""

# Whole weights to a millionth, so that shares are exact here, too.
_LENGTH_SHARES = """WITH t AS (SELECT mix_name, source, sum(CASE WHEN weight > 0 THEN round(weight * 1000000) ELSE 0 END)::hugeint AS a, max(max_repeats) AS most FROM mix_targets GROUP BY 1, 2),
s AS (SELECT source, sum(length(text)) AS n FROM documents WHERE length(text) > 0 AND source IS NOT NULL GROUP BY 1),
u AS (SELECT t.*, coalesce(n, 0)::hugeint AS available, a > 0 AND most > 0 AND coalesce(n, 0) > 0 AS usable FROM t LEFT JOIN s ON s.source = t.source),
c AS (SELECT *, (most * available)::hugeint AS cap, sum(a) OVER (PARTITION BY mix_name) AS whole, coalesce(sum(a) FILTER (usable) OVER (PARTITION BY mix_name), 0) AS period FROM u),
b AS (SELECT mix_name, arg_min(cap, cap::double / a::double) AS bc, arg_min(a, cap::double / a::double) AS ba FROM c WHERE usable GROUP BY 1),
k AS (SELECT c.*, CASE WHEN usable THEN least(cap, bc * a // ba) ELSE 0 END AS take FROM c LEFT JOIN b ON b.mix_name = c.mix_name)
SELECT mix_name, source, round(a::double / whole::double, 9) AS target_share, CASE WHEN usable THEN round(a::double / period::double, 9) ELSE 0 END AS aimed_share,
coalesce(round(take::double / nullif(sum(take) OVER (PARTITION BY mix_name), 0)::double, 9), 0) AS reached_share, take::bigint AS n_tokens,
CASE WHEN take > 0 THEN ((take + available - 1) // available)::int ELSE 0 END AS most_repeats, most AS max_repeats FROM k"""

# Words as the labels' texts are split: at white space, of whatever kind.
_BLANKS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_COVERED = f"WITH w AS (SELECT doc_id, len(regexp_extract_all(text, '[^{_BLANKS}]+')) AS n FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL) SELECT doc_id, sum(n)::bigint AS n_words, true AS numbered FROM w WHERE n > 0 GROUP BY 1"

ORACLES: dict[str, str] = {
    "p4_bounds": _BOUNDS,
    "p5_lost": "SELECT '' AS rule, '' AS url WHERE false",
    "p7_length_shares": _LENGTH_SHARES,
    "p8_covered": _COVERED,
    "p5_shares": _SHARES,
    "p6_found": f"{_LEAKED} SELECT doc_id, item_id FROM leaked",
    "p6_items": f"{_LEAKED}, items AS (SELECT DISTINCT item_id FROM heldout_items) SELECT items.item_id, count(doc_id) AS n_documents FROM items LEFT JOIN leaked ON leaked.item_id = items.item_id GROUP BY 1",
}
