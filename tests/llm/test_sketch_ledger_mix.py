import random
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessellar.llm import ledger as E
from tessellar.llm import mixing as M
from tessellar.llm import queries as Q
from tessellar.llm import sketches as S
from tessellar.llm import tokens as T


def states(df):
    return S.sketch(df, {"g": S.tidy_label(F.col("g"))}, {"id": F.col("id")})


@pytest.mark.parametrize("n", [0, 1, 7, 300, 5000, 200_000])
def test_estimate_within_bounds(spark, n):
    df = spark.range(n).select(F.lit("A").alias("g"), F.col("id"))
    r = S.estimate(states(df.unionByName(df)), ["g"]).collect()
    if not n:
        assert r == []
        return
    assert r[0].g == "a" and abs(r[0].n_distinct - n) <= max(0.5, 4 * r[0].std_error) and r[0].std_error <= 0.012 * n + 0.6 and r[0].low <= r[0].n_distinct <= r[0].high


def test_merging_parts_is_the_whole(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, " .X").otherwise("y").alias("g"), (F.col("id") % 9000).alias("id"), F.lit(1).alias("bucket"))
    whole = states(df)
    parts = states(df.where("id < 100")).unionByName(states(df.where("id >= 50")))
    key = lambda s: sorted(map(tuple, s.select("g", "field", "bucket", "bits").collect()))
    assert key(S.merge(parts, ["g"])) == key(S.merge(whole, ["g"]))
    u = {r.g: r.n_distinct for r in S.estimate(S.unions(whole, ["g"], [["g"], []]), ["g"]).collect()}
    assert abs(u[None] - 9000) < 400 and set(u) == {None, "x", "y"}
    only = S.estimate(S.unions(whole, ["g"], [["g"], []], own={"id": [["g"]]}), ["g"]).collect()
    assert {r.g for r in only} == {"x", "y"}


def test_stored_states_take_late_rows(spark, tmp_path):
    df = spark.range(5000).select(F.lit("a").alias("g"), "id")
    path = str(tmp_path / "states")
    S.accumulate(states(df.where("id % 2 = 0")), path, ["g"])
    for _ in range(2):
        stored = S.accumulate(states(df.where("id % 2 = 1")), path, ["g"])
    key = lambda s: sorted(map(tuple, s.select("g", "field", "bucket", "bits").collect()))
    assert key(stored) == key(states(df))


def test_standard_error_is_honest():
    rng = np.random.default_rng(1)
    n, m, errors = 20_000, 512, []
    for _ in range(120):
        b, r = rng.integers(0, m, n), rng.geometric(0.5, n) - 1
        seen = np.zeros((m, 44), bool)
        seen[b, np.minimum(r, 43)] = True
        est, se = S.likelihood_estimate(seen.sum(axis=0)[None], m)
        errors.append((est[0] - n) / se[0])
    assert abs(np.mean(errors)) < 0.35 and 0.75 < np.std(errors) < 1.25


def test_sketch_nulls_and_digests(spark):
    df = spark.createDataFrame([(None, "a"), ("", None), (" ", "b")], "g string, id string")
    got = {(r.g, round(r.n_distinct)) for r in S.estimate(states(df), ["g"]).collect()}
    assert got == {(S.NONE, 2)}
    d = spark.createDataFrame([("sha1:ab",), ("AB ",), ("",), (None,)], "d string").select(S.tidy_digest(F.col("d")).alias("d"))
    assert [r.d for r in d.collect()] == ["AB", "AB", None, None]


def keys_of(spark, rows):
    df = spark.createDataFrame(rows, "name string, url string, epoch int")
    return E.first_seen(df, F.array("name"), F.col("url"), F.col("epoch"), {"s": 0, "t": 1})


def test_ledger_keeps_and_fills(spark, tmp_path):
    rows = [("s", f"u{i}", i % 4) for i in range(4000)] + [("t", f"u{i}", 0) for i in range(50)] + [("s", "u1", 3), (None, "x", 0), ("s", None, 0), ("s", "y", None)]
    rates = {0: 0.1, 1: 1.0}
    keys = keys_of(spark, rows).cache()
    path = str(tmp_path / "ledger")
    three = E.grow(keys, rates, path, [0, 1, 2])
    before = {(r.stratum, r.key) for r in three.collect()}
    assert Counter(s for s, _ in before) == {0: 300, 1: 50}
    after = {(r.stratum, r.key) for r in E.grow(keys, rates, path, [0, 1, 2, 3]).collect()}
    assert before < after and Counter(s for s, _ in after) == {0: 400, 1: 50}
    again = {(r.stratum, r.key) for r in E.grow(keys.repartition(7), rates, str(tmp_path / "other"), [0, 1, 2, 3]).collect()}
    assert again == after and E.grow(keys, rates, path, [0, 1, 2, 3]).count() == 450
    # brute force: lowest hashes among unseen, epoch by epoch
    k = keys.collect()
    kept: set = set()
    for e in range(4):
        seen = [r for r in k if r.stratum == 0 and r.epoch <= e]
        want = round(0.1 * len(seen)) - len(kept)
        kept |= {r.key for r in sorted((r for r in seen if r.key not in kept), key=lambda r: (r.priority, r.key))[:want]}
    assert kept == {key for s, key in after if s == 0}
    got = {r.stratum: (r.n_keys, r.n_selected) for r in E.shares(keys, rates, E.grow(keys, rates, path, [0, 1, 2, 3])).collect()}
    assert got == {0: (4000, 400), 1: (50, 50)}


def test_ledger_small_bins_and_empty(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(E, "BIN_KEYS", 10)
    keys = keys_of(spark, [("s", f"u{i}", 0) for i in range(3000)])
    assert E.grow(keys, {0: 0.25}, str(tmp_path / "a"), [0]).count() == 750
    assert E.grow(keys_of(spark, []), {0: 0.25}, str(tmp_path / "b"), []).count() == 0


def lags(parts, n):
    """Largest distance of any source from its exact share at any prefix of ``n`` slots, in blocks."""
    period, done, most = sum(parts.values()), dict.fromkeys(parts, 0), 0.0
    wanted = {s: -(-n * a // period) for s, a in parts.items()}
    for s, k, t in M.schedule(parts, wanted):
        if t >= n:
            break
        assert k == done[s]
        done[s] += 1
        if n <= 5000:
            most = max(most, *(abs(done[x] * period - (t + 1) * a) / period for x, a in parts.items()))
        else:
            most = max(most, abs(done[s] * period - (t + 1) * parts[s]) / period, abs((done[s] - 1) * period - t * parts[s]) / period)
    return most


def test_pfair_schedule_lag():
    rng = random.Random(2)
    for _ in range(20):
        parts = M.exact({str(i): rng.random() + 0.01 for i in range(rng.randrange(1, 9))})
        assert lags(parts, 400) < 1
    many = M.exact({str(i): 1.0 for i in range(1500)})
    assert many == {str(i): 1 for i in range(1500)} and lags(many, 1500) < 1
    assert M.exact({"a": 0.3, "b": 0.25, "c": 0.45}) == {"a": 6, "b": 5, "c": 9}


@pytest.mark.parametrize("weights", [{"a": 1 / 3, "b": 2 / 3}, {"a": 0.0001, "b": 0.9999}, {"a": 0.123456789012345, "b": 3.3, "c": 0.00071}])
def test_no_drift_over_a_million_blocks(weights):
    assert lags(M.exact(weights), 1_000_000) < 1


def test_mix_shares_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, "big", rng.randrange(1, 60)) for i in range(3000)] + [(10_000 + i, "small", rng.randrange(1, 60)) for i in range(60)] + [(1, None, 5), (None, "big", 9), (99_999, "big", 0)]
    sized = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, source string, n_tokens bigint, slot string")
    targets = spark.createDataFrame([("m", "big", 3.0, 2), ("m", "small", 1.0, 5), ("m", "gone", 1.0, 5), ("n", "small", None, 2), ("o", "small", 2.0, 0)], "mix_name string, source string, weight double, max_repeats int")
    mixed, shares = M.mix(sized, targets, block=256)
    got = {(r.mix_name, r.source): r for r in shares.collect()}
    assert abs(got["m", "big"].reached_share - 0.75) < 0.01 and got["m", "small"].most_repeats == 5 and got["m", "gone"].n_tokens == 0 and got["o", "small"].reached_share == 0.0
    seq = [(r.source, r.n_tokens) for r in mixed.where("mix_name = 'm'").orderBy("slot", "offset").collect()]
    total = {"big": 0, "small": 0}
    for s, n in seq:
        total[s] += n
        t = sum(total.values())
        assert abs(total["small"] - 0.25 * t) < 2 * 256  # less than a block each way
    assert got["m", "big"].n_tokens == 3 * got["m", "small"].n_tokens == 15 * sum(r[2] for r in rows if r[1] == "small")
    per_doc = mixed.groupBy("doc_id").agg(F.count_distinct("repeat_no").alias("n"), F.sum("n_tokens").alias("t")).collect()
    assert max(r["n"] for r in per_doc) <= 5 and max(r["t"] for r in per_doc) <= 5 * 59
    per_block = mixed.groupBy("slot").agg(F.sum("n_tokens").alias("t"), F.count_distinct("source").alias("s")).collect()
    assert all(r["s"] == 1 and r["t"] <= 256 for r in per_block) and sum(r["t"] < 256 for r in per_block) <= 2
    again = M.mix(sized.repartition(5), targets, block=256)[0]
    key = lambda d: sorted((r.mix_name, r.slot, r.offset, r.doc_id, r.repeat_no) for r in d.collect())
    assert key(again) == key(mixed)


def test_long_document_goes_on_in_further_blocks(spark):
    sized = spark.createDataFrame([(1, "a", 1000), (2, "b", 1000), (3, "b", 1)], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([(None, "a", 0.5, 3), (None, "b", 0.5, 3)], "mix_name string, source string, weight double, max_repeats int")
    mixed, shares = M.mix(sized, targets, block=100)
    seq = mixed.orderBy("slot", "offset").collect()
    assert [r.source for r in seq if r.doc_id != 3][:6] == ["a", "b"] * 3 and {r.n_tokens for r in seq if r.source == "a"} == {100}
    assert [r.first_token for r in seq if r.source == "a"] == list(range(0, 1000, 100)) * 3
    assert {(r.source, r.n_tokens, r.n_rows, r.reached_share) for r in shares.collect()} == {("a", 3000, 3, 0.5), ("b", 3000, 6, 0.5)}


def test_offsets_without_overlap(spark):
    sized = spark.createDataFrame([(i, "s", 1 + i % 7) for i in range(500)], "doc_id bigint, source string, n_tokens bigint")
    got = sorted((r["__at"], r.n_tokens) for r in M.offsets(sized, 20).collect())
    at = 0
    for a, n in got:
        assert a == at
        at += n


def test_mix_of_nothing(spark):
    sized = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("m", "a", 1.0, 2)], "mix_name string, source string, weight double, max_repeats int")
    mixed, shares = M.mix(sized, targets)
    assert mixed.count() == 0 and shares.first().n_tokens == 0


def test_token_counts_are_exact(spark):
    texts = ["", None, "Don't  stop\n\n  42nd café — ünïcode 😀​ x's", "a" * 3000, "  \t ", "ﬁn\ud800x"]
    c = T.TokenCounter()
    for t in texts[:-1]:
        assert c.count(t) == (len(c.encoding.encode_ordinary(t)) if t else 0)
    assert c.count(texts[-1]) > 0
    df = spark.createDataFrame([(1, "s", texts[2], "x"), (2, None, None, "y")], "doc_id bigint, source string, text string, n_tokens string")
    assert {r.doc_id: r.n_tokens for r in T.token_counts(df).collect()} == {1: c.count(texts[2]), 2: 0}


def test_epochs_are_months(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 5),)], "t timestamp_ntz")
    assert df.select(F.year("t") * 12 + F.month("t") - 1).first()[0] == 2025 * 12


def test_ledger_grows_within_its_last_epoch(spark, tmp_path):
    path, rates = str(tmp_path / "ledger"), {0: 0.1, 1: 0.5}
    rows = [("s", f"u{i}", i % 3) for i in range(3000)] + [("t", f"u{i}", 2) for i in range(50)]
    of = lambda ledger: {(r.stratum, r.key) for r in ledger.collect()}
    first = of(E.grow(keys_of(spark, rows), rates, path, [0, 1, 2]))
    assert Counter(s for s, _ in first) == {0: 300, 1: 25}
    rows += [("s", f"v{i}", 2 - i % 2) for i in range(3000)] + [("t", f"v{i}", 2) for i in range(50)]
    second = of(E.grow(keys_of(spark, rows), rates, path, [0, 1, 2]))
    assert first < second and Counter(s for s, _ in second) == {0: 600, 1: 50}
    parts = sorted(p.name for p in (tmp_path / "ledger").iterdir())
    assert of(E.grow(keys_of(spark, rows), rates, path, [0, 1, 2])) == second and sorted(p.name for p in (tmp_path / "ledger").iterdir()) == parts
    rows += [("s", f"w{i}", 2 + i % 2) for i in range(1000)]
    third = E.grow(keys_of(spark, rows), rates, path, [0, 1, 2, 3])
    assert second < of(third) and third.count() == len(of(third)) == 750
    fewer = of(E.grow(keys_of(spark, [r for r in rows if r[1][0] != "w"]), rates, path, [0, 1, 2]))
    assert second <= fewer and not any(k[0] == "w" for _, k in fewer)


def test_sample_query_keeps_its_urls_when_the_newest_month_grows(spark, tmp_path):
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    save([(1, "text/html")], "id int, name string", "cc_mimes")
    save([(1, "text/html")], "id int, name string", "cc_detected_mimes")
    save([(f"f{i}", '{"defaultInclude": true, "defaultProbability": 0.1}') for i in range(8)], "filter_name string, filter_json string", "record_filters")
    captures = [(f"http://a/{i}", 1, 1, 200, datetime(2025, 1 + i % 2, 5)) for i in range(1000)]
    runs = []
    for rows in (captures, captures + [(f"http://b/{i}", 1, 1, 200, datetime(2025, 2, 20)) for i in range(1000)]):
        save(rows, "url string, mime int, detected_mime int, status int, loaded_at timestamp_ntz", "cc_urls")
        runs.append({(r.filter_name, r.url) for r in Q.p5_sample(spark, str(tmp_path)).collect()})
    assert len(runs[0]) == 800 and len(runs[1]) == 1600 and runs[0] < runs[1]


def test_every_month_is_an_epoch(spark, tmp_path):
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    save([(1, "text/html")], "id int, name string", "cc_mimes")
    save([(1, "text/html")], "id int, name string", "cc_detected_mimes")
    save([("f", '{"defaultInclude": true, "defaultProbability": 0.1}')], "filter_name string, filter_json string", "record_filters")
    save([(f"http://a/{i}", 1, 1, 200, datetime(1800 + i // 12, 1 + i % 12, 1)) for i in range(2500)], "url string, mime int, detected_mime int, status int, loaded_at timestamp_ntz", "cc_urls")
    assert Q._strata(spark, str(tmp_path))[2] == [1800 * 12 + i for i in range(2500)]


def test_undated_captures_are_apart_from_the_union_over_days(spark, tmp_path):
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    save([(1, ".COM"), (2, None)], "id int, tld string", "cc_hosts")
    save([(1, "a/b")], "id int, name string", "cc_mimes")
    save([(datetime(2025, 1, 1), 1, 1, "sha1:AA"), (None, 1, 1, "bb"), (None, 2, None, "BB"), (None, None, 1, None)], "captured_at timestamp_ntz, host int, mime int, digest string", "cc_urls")
    got = {(r.day, r.tld, r.mime, r.field): round(r.n_distinct) for r in Q.p4_distinct(spark, str(tmp_path)).collect()}
    assert got[None, None, None, "digest"] == 2 and got["(none)", None, None, "digest"] == 1 and got["2025-01-01", None, None, "digest"] == 1
    assert got[None, "com", None, "host"] == 1 and got[None, "(none)", None, "host"] == 1 and got["(none)", None, None, "tld"] == 1
    bounds = {(r.grouped_by, r.field): (r.n_groups, r.n_identifiers, r.within) for r in Q.p4_bounds(spark, str(tmp_path)).collect()}
    assert bounds["", "digest"] == (1, 2, True) and bounds["day", "digest"] == (2, 2, True) and all(x[2] for x in bounds.values())
