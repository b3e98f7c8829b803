import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tessellar.operators import hot_keys as H
from tessellar.operators import orphans as O
from tessellar.plans import all_queries

T0 = datetime(2025, 1, 1)


def brute(children, targets):
    return sorted((k, t) for k, t in children if k is not None and t is not None and not any(k == tk and a is not None and a <= t and (b is None or t < b) for tk, a, b in targets))


def test_not_live_both_ways(spark, monkeypatch):
    rng = random.Random(5)
    at = lambda: T0 + timedelta(hours=rng.randrange(24 * 60))
    targets = [(rng.choice([1, 2, 3, None]), at() if rng.random() > 0.05 else None, None) for _ in range(30)]
    targets = [(k, a, a + timedelta(hours=rng.randrange(60)) if a and rng.random() < 0.9 else None) for k, a, _ in targets] + [(4, T0, T0 + timedelta(days=50))] * 3
    children = [(rng.choice([1, 2, 3, 4, 9, None]), at()) for _ in range(400)] + [(1, None), (4, T0), (4, T0 + timedelta(days=50))]
    c = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(children)], "__key int, __t timestamp_ntz, row int")
    p = spark.createDataFrame(targets, "__key int, __since timestamp_ntz, __until timestamp_ntz")
    want = brute(children, targets)
    for most in (0, 1000):
        got = sorted((r["__key"], r["__t"]) for r in O.not_live(c, p, most).collect())
        assert got == want
    monkeypatch.setattr(O, "HOT_ROWS", 2)  # a key's children of one day in several parts
    assert sorted((r["__key"], r["__t"]) for r in O.not_live(c, p, 0).collect()) == want
    one_day = spark.range(5000).select(F.lit(1).alias("__key"), F.lit(T0).cast("timestamp_ntz").alias("__t"), F.col("id").alias("row"))
    assert O.not_live(one_day, p.where("__key = 4").withColumn("__key", F.lit(1)), 0).count() == 0
    assert O.not_live(one_day, p.where("__key = 9"), 0).count() == 5000
    monkeypatch.undo()
    assert O.not_live(c, p.limit(0)).count() == sum(k is not None and t is not None for k, t in children)
    assert O.not_live(c.limit(0), p, 0).count() == 0


def test_cascade_and_cycle(spark):
    a = spark.createDataFrame([(1, 9, None, T0, "clash"), (2, 5, None, T0, "c"), (3, None, 1, T0, "c"), (4, None, 3, T0, "c")], "id int, tag int, up int, at timestamp_ntz, __key string")
    tags = spark.createDataFrame([(5, T0, None)], "id int, since timestamp_ntz, until timestamp_ntz")
    src = {"a": O.Source(a, F.col("id"), "at"), "tags": O.Source(tags, F.col("id"), None)}
    refs = [O.Reference("a", "tag", "tags", "id", "since", "until"), O.Reference("a", "up", "a", "id")]
    got = sorted((r.row_key, r.kind) for r in O.find_orphans(src, refs).collect())
    assert got == [("1", "direct"), ("3", "inherited"), ("4", "inherited")]
    report = O.per_table_and_period(O.find_orphans(src, refs)).collect()
    assert [(r.src_table, r.period, r.n_direct, r.n_inherited) for r in report] == [("a", "2025-01", 1, 2)]


def test_empty_tables_repeats_and_null_keys(spark):
    a = spark.createDataFrame([(1, 9, T0), (1, 9, T0), (None, 9, T0), (2, None, T0), (3, 9, None)], "id int, tag int, at timestamp_ntz")
    tags = spark.createDataFrame([], "id int, since timestamp_ntz, until timestamp_ntz")
    refs = [O.Reference("a", "tag", "tags", "id", "since", "until")]
    found = lambda rows: sorted(map(str, O.find_orphans({"a": O.Source(rows, F.col("id"), "at"), "tags": O.Source(tags, F.col("id"), None)}, refs).select("row_key", "kind").collect()))
    assert found(a) == ["Row(row_key='1', kind='direct')", "Row(row_key=None, kind='direct')"]
    assert found(a.limit(0)) == []


def test_paths(spark):
    df = spark.createDataFrame([(".\\A\\b",), ("./a/B",), ("a/b",), (None,)], "p string").select(O.plain_path(F.col("p")).alias("p"))
    assert [r.p for r in df.collect()] == ["a/b", "a/b", "a/b", None]


def test_hot_keys(spark):
    rows = [(1, 7, 10, T0)] * 97 + [(2, None, None, None), (2, 8, 5, T0), (None, 8, 1, T0 + timedelta(1))]
    facts = spark.createDataFrame([(*r, 0) for r in rows], "host int, mime int, len bigint, at timestamp_ntz, key_id int")
    dims = spark.createDataFrame([(1, "a"), (1, "b"), (7, "x"), (None, "n")], "id int, name string")
    j = H.joined_states(H.key_states(facts, ["host", "mime"], "len", "at"), H.dimension_states({"host": (dims, "id", F.col("name")), "mime": (dims, "id", F.col("name"))}), H.all_rows(facts))
    got = {(r.field_name, r.key_id): (r.n_rows, r.sum_measure, r.joined_rows, r.joined_sum, r.n_dim) for r in j.collect()}
    assert got[("host", 1)] == (97, 970, 194, 1940, 2) and got[("host", 2)] == (2, 5, 2, 5, 0) and got[("host", None)] == (1, 1, 1, 1, 0) and got[("mime", None)] == (1, None, 1, None, 0)
    assert {(r.field_name, r.key_id) for r in H.heavy_keys(j, 2).collect()} == {("host", 1), ("host", 2), ("mime", 7), ("mime", 8)}
    up = {(r.field_name, r.label): (r.n_keys, r.n_rows) for r in H.roll_up(j, F.upper("label")).collect()}
    assert up[("host", "A")] == (1, 97) and up[("host", None)] == (1, 3)
    assert H.joined_states(H.key_states(facts.limit(0), ["host"], "len", "at"), H.dimension_states({"host": (dims, "id", F.col("name"))}), H.all_rows(facts.limit(0))).count() == 0


def test_report_of_all_tables_reaches_documents(spark, tmp_path):
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    save([(1, T0, None)], "id int, added_at timestamp_ntz, retired_at timestamp_ntz", "cc_hosts")
    save([(1, T0, None)], "id int, added_at timestamp_ntz, retired_at timestamp_ntz", "cc_fetch_status")
    save([(1, 1, T0)], "id bigint, host int, loaded_at timestamp_ntz", "cc_urls")
    save([(1, 1, "a/kept", T0, None)], "id bigint, status_id int, path string, fetched_at timestamp_ntz, removed_at timestamp_ntz", "cc_fetch")
    save([("a/kept", T0), ("./A/gone", T0)], "path string, profiled_at timestamp_ntz", "profiles")
    save([], "run_id bigint, path string, started_at timestamp_ntz", "tool_runs")
    docs = [(1, 1, "a/kept", T0), (2, 1, "a\\gone", T0), (3, 9, "a/kept", T0), (4, 9, "a/gone", T0), (5, None, None, T0), (6, 1, "a/kept", T0 - timedelta(hours=1))]
    save(docs, "doc_id bigint, host int, path string, extracted_at timestamp_ntz", "documents")
    of = lambda name: {(r.src_table, r.period, r.n_direct, r.n_inherited) for r in all_queries()[name](spark, str(tmp_path)).collect()}
    assert of("p2_report_all") == {("profiles", "2025-01", 1, 0), ("documents", "2025-01", 2, 1), ("documents", "2024-12", 1, 0)}
    assert of("p2_report") == {("profiles", "2025-01", 1, 0)}


def test_cascade_of_a_hundred_rounds(spark):
    a = spark.createDataFrame([(i, 9 if i == 0 else None, i - 1 if i else None, T0) for i in range(100)], "id int, tag int, up int, at timestamp_ntz")
    tags = spark.createDataFrame([], "id int, since timestamp_ntz, until timestamp_ntz")
    src = {"a": O.Source(a, F.col("id"), "at"), "tags": O.Source(tags, F.col("id"), None)}
    found = O.find_orphans(src, [O.Reference("a", "tag", "tags", "id", "since", "until"), O.Reference("a", "up", "a", "id")])
    assert {int(r.row_key) for r in found.collect()} == set(range(100))


def test_a_sound_record_of_the_key_keeps_its_children(spark):
    at = lambda h: T0 + timedelta(hours=h)
    up = spark.createDataFrame([(1, 9, "x", at(0), None), (2, 5, "x", at(0), at(2)), (3, 9, "y", at(0), None), (4, 9, "y", at(40 * 24), None)], "id int, tag int, name string, at timestamp_ntz, gone timestamp_ntz")
    down = spark.createDataFrame([(1, "x", at(1)), (2, "x", at(3)), (3, "y", at(1)), (4, "z", at(1)), (5, "x", None)], "id int, name string, at timestamp_ntz")
    plain = spark.createDataFrame([(1, "x", at(9)), (2, "y", at(9)), (3, None, at(9))], "id int, name string, at timestamp_ntz")
    tags = spark.createDataFrame([(5, T0, None)], "id int, since timestamp_ntz, until timestamp_ntz")
    src = {"up": O.Source(up, F.col("id"), "at"), "down": O.Source(down, F.col("id"), "at"), "plain": O.Source(plain, F.col("id"), "at"), "tags": O.Source(tags, F.col("id"), None)}
    refs = [O.Reference("up", "tag", "tags", "id", "since", "until"), O.Reference("down", "name", "up", "name", "at", "gone"), O.Reference("plain", "name", "up", "name")]
    found = {(r.src_table, r.row_key, r.kind) for r in O.find_orphans(src, refs).collect()}
    # down 1 has a sound parent at its time, down 2 no more; plain 1 has one at all
    assert found == {("up", "1", "direct"), ("up", "3", "direct"), ("up", "4", "direct"), ("down", "2", "inherited"), ("down", "3", "inherited"), ("down", "4", "direct"), ("plain", "2", "inherited")}
