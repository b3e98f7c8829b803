import base64
import gzip
import hashlib
import os
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessellar.operators import fetch_state as FS
from tessellar.operators import processes as P
from tessellar.operators import relational as R
from tessellar.operators import status as ST
from tessellar.operators import text_compare as TC

T0 = datetime(2025, 1, 1)


def test_join_sized_both_ways(spark):
    from tessellar.common import join_sized

    big = spark.createDataFrame([(i % 3, i) for i in range(60)] + [(None, 99)], "k int, v int")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k int, n string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = [sorted(map(str, join_sized(big, small, ["k"], how, ["v"], most).collect())) for most in (10, 0)]
        assert got[0] == got[1]


def test_dictionary_round_trip(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), ("long" * 5,)], "w string")
    d = R.dictionary(df, "w", 6)
    assert sorted((r.id, r.name) for r in d.collect()) == [(0, ""), (1, "a"), (2, "b"), (3, "longlo")]
    coded = R.encode(df.withColumn("id", F.lit(5)), "w", d, 6)
    assert sorted(r.w_id for r in coded.collect()) == [0, 1, 2, 2, 3] and coded.columns == ["id", "w_id"]
    assert R.dictionary(df.limit(0), "w", 6).count() == 0


def test_set_operations(spark):
    k = lambda *x: spark.createDataFrame([(v,) for v in x], "key string")
    diff = {(r.reason, r.key) for r in R.list_diff(k("a", "b", "b", None), k("b", "c"), k("d", "a")).collect()}
    assert diff == {("only_left", "a"), ("only_right", "c"), ("extra", "d")}
    assert R.list_diff(k("a"), k("a"), k("a")).count() == 0
    assert R.missing_from(k("a", "b"), k("b"), ["key"]).collect()[0].key == "a"
    assert R.semi(k("a", "b"), k(), ["key"]).count() == 2
    again = spark.createDataFrame([("a", 12), ("b", 3)], "key string, s int")
    assert sorted(r.key for r in R.to_retry(k("a", "b", "c"), again, ["key"], F.col("s") > 11).collect()) == ["a", "c"]


def test_upsert_first_seen_update(spark):
    a = spark.createDataFrame([(1, T0, "x"), (2, None, "y")], "id int, at timestamp_ntz, v string")
    b = spark.createDataFrame([(2, T0, "z"), (3, T0, "w")], "id int, at timestamp_ntz, v string")
    assert sorted((r.id, r.v) for r in R.upsert(a, b, ["id"], [F.col("at")]).collect()) == [(1, "x"), (2, "z"), (3, "w")]
    s = R.first_seen(spark.createDataFrame([(1, "d"), (2, "d"), (3, None)], "id int, d string"), F.col("d"), ["id"])
    assert {r.id: r.outcome for r in s.collect()} == {1: "copied", 2: "skipped", 3: "skipped"}
    u = R.update_from(a, spark.createDataFrame([(1, "new"), (2, None)], "id int, v string"), "id", ["v"])
    assert {r.id: r.v for r in u.collect()} == {1: "new", 2: "y"}


def test_grouped_blocks_lose_nothing(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("h"), "id")
    got = R.grouped(rows, "h", ["id"], block=500).collect()
    assert sum(r.n for r in got) == 5000 and len(got) >= 8 and len({x["id"] for r in got for x in r["items"]}) == 5000


def test_orders(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (8, "c")], "id int, h string")
    assert [r.h for r in R.page(df, ["id"], 2, 1).collect()] == ["c", "a"]
    assert [r.h for r in R.interleaved(df.where("id IS NOT NULL"), "id", "h").collect()] == ["b", "c"]
    assert R.shuffled_pick(df, 2, "h", 3).collect() == R.shuffled_pick(df.repartition(3), 2, "h", 3).collect()
    n = {(r.kind, r.key): r.n for r in R.pair_counts(df, "id", "h").collect()}
    assert n[("id", "NULL")] == 1 and n[("pair", "a->null")] == 1
    assert R.fetch_order(df, "h", "id").count() == 3


RUNS = "run_id bigint, tool string, path string, exit_value int, timeout boolean, stdout string, stderr string, started_at timestamp_ntz"


def test_status_cascade_and_roll_up(spark):
    rows = [
        (1, "pdfinfo", "a", 1, True, "", "Command Line Error: Incorrect password x", T0), (2, "pdfinfo", "b", 1, True, "", "x", T0), (3, "pdfinfo", "c", 1, False, "", None, T0),
        (4, "pdfinfo", "d", 0, False, "", "abcdef", T0), (5, "pdfinfo", "e", 0, False, "", "abc", T0), (6, "pdfid", "a", 0, False, "/Encrypt 1", "", T0), (7, "pdfinfo", "e", 1, False, "", "", None),
    ]
    anchor = spark.createDataFrame([(p,) for p in "abcdef"], "path string")
    tools = [t for t in ST.TOOLS if t.table in ("pdfinfo", "pdfid")]
    w = ST.wide(anchor, spark.createDataFrame(rows, RUNS), tools, keep=("exit_value",))
    got = {r.path: (r.pinfo_status, r.pid_status) for r in w.collect()}
    assert {r.path: r.other_tools for r in ST.wide(anchor, spark.createDataFrame(rows, RUNS), [tools[0]]).collect()} == {p: "pdfid" if p == "a" else "" for p in "abcdef"} or tools[0].table == "pdfid"
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "stderr" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    assert got == {"a": ("encrypted", "encrypted"), "b": ("timeout", "missing"), "c": ("crash", "missing"), "d": ("warn", "missing"), "e": ("success", "missing"), "f": ("missing", "missing")}
    up = {r.path: (r.tools_status_fail, r.tools_status_warn, r.tools_status_timeout, r.tools_status) for r in ST.roll_up(w).collect()}
    assert up["b"] == ("pinfo", "", "pinfo", "pid_missing pinfo_timeout") and up["d"] == ("", "pinfo", "", "pid_missing pinfo_warn")


def test_fill_and_rename(spark):
    df = spark.createDataFrame([(None, "NaN"), (None, "3"), ("1", "2")], "a string, b string")
    assert [r.a for r in ST.fill_absent(df, {"a": "b"}).collect()] == [None, "3", "1"]
    assert ST.rename(df, {"a": "x"}).columns == ["x", "b"] and ST.rename(df, {"a": "x"}, rest=False).columns == ["x"]


def test_compare_extracts(spark):
    df = spark.createDataFrame([("f", "a", "one two two"), ("f", "b", "two three"), ("f", "c", ""), ("g", "a", "x")], "path string, tool string, text string")
    got = {(r.tool_a, r.tool_b): (r.dice, r.overlap) for r in TC.pairwise(df, "path", "tool", "text").collect()}
    assert got == {("a", "b"): (0.5, 0.4), ("a", "c"): (0.0, 0.0), ("b", "c"): (0.0, 0.0)}
    s = TC.token_stats(spark.createDataFrame([(1, "The 4 cats, the dog"), (2, None), (3, "12")], "id int, t string"), ["id"], "t", ["the"]).orderBy("id").collect()
    assert (s[0].n_tokens, s[0].n_types, s[0].n_alphabetic, s[0].n_common, s[0].oov) == (5, 4, 4, 2, 0.5) and s[1].oov == s[2].oov == -1.0


def test_processes(spark, tmp_path):
    files = spark.createDataFrame([("a/b", bytearray(b"one\ntwo\n")), ("c", None)], "path string, content binary")
    r = {x.path: x for x in P.run_command(files, P.Command("cat", "cat {input}", stdout_most=4)).collect()}
    assert (r["a/b"].stdout, r["a/b"].stdout_length, r["a/b"].stdout_truncated, r["a/b"].exit_value) == ("one\n", 6, True, 0) and r["c"].stdout == ""
    late = P.run_command(files, P.Command("slow", "sleep 5", seconds=0.2)).collect()
    assert all(x.timeout and x.exit_value == -1 for x in late)
    assert P.run_command(files, P.Command("none", "no-such-program {input}")).collect()[0].exit_value == -1000
    P.run_command(files, P.Command("cp", "cp {input} {output}", "txt"), str(tmp_path)).collect()
    assert (tmp_path / "cp/a/b.txt").read_bytes() == b"one\ntwo\n"


def test_fetch_states(spark):
    df = spark.createDataFrame([("length", 5, True), ("", 0, True), (None, 3, True), ("", 3, None), ("", None, None)], "t string, n int, same boolean")
    got = [r[0] for r in df.select(FS.first_fetch(F.col("t"), F.col("n"), F.col("same"), F.lit(False))).collect()]
    assert got == ["TRUNCATED", "EMPTY_PAYLOAD", "ADDED_TO_REPOSITORY", "ADDED_TO_REPOSITORY_DIFF_DIGEST", None]
    t = spark.createDataFrame([("timeout", None, None, None), (None, 404, 1, 1), (None, 200, 5, 9), (None, 200, 9, 9)], "e string, s int, n int, x int")
    assert [r[0] for r in t.select(FS.refetch(F.col("e"), F.col("s"), F.col("n"), F.col("x"), F.lit(False))).collect()] == ["REFETCHED_TIMEOUT", "REFETCHED_NOT_200", "REFETCHED_TRUNCATED", "REFETCHED_SUCCESS"]
    targets = spark.createDataFrame([("bad", i, "u") for i in range(14)] + [("good", 1, "u")], "host string, id bigint, url string")
    out = FS.refetch_hosts(targets.withColumn("url", F.col("host")), lambda u: FS.Fetched("timeout") if u == "bad" else FS.Fetched(None, 200), pause=(0, 0)).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in out} == {"REFETCHED_TIMEOUT": 11, "REFETCH_UNHAPPY_HOST": 3, "REFETCHED_SUCCESS": 1}


def test_every_refetch_state_and_pauses(spark):
    answers = {
        "timeout": FS.Fetched("timeout"), "io": FS.Fetched("io"), "read": FS.Fetched("read", 200), "length": FS.Fetched("length", 200), "digest": FS.Fetched("digest", 200), "closed": FS.Fetched("closed"),
        "emit": FS.Fetched("emit", 200), "404": FS.Fetched(None, 404, 1, 1), "short": FS.Fetched(None, 200, 5, 9), "ok": FS.Fetched(None, 200, 9, -1), "odd": FS.Fetched(None, None),
    }

    def fetch(url):
        if url == "late":
            raise TimeoutError
        if url == "broken":
            raise OSError
        return answers[url]

    targets = spark.createDataFrame([(f"h{i}", i, u) for i, u in enumerate([*answers, "late", "broken"])] + [(None, 99, "ok")], "host string, id bigint, url string")
    got = {r.host: r.status for r in FS.refetch_hosts(targets, fetch, pause=(0, 0)).collect()}
    assert [got[f"h{i}"] for i in range(13)] == [*FS.BY_ERROR.values(), "REFETCHED_NOT_200", "REFETCHED_TRUNCATED", "REFETCHED_SUCCESS", "REFETCHED_BAD_STATUS", "REFETCHED_TIMEOUT", "REFETCHED_IO_EXCEPTION"] and got[None] == "REFETCHED_SUCCESS"

    def wait(seconds):
        assert 0.1 <= seconds <= 2.1
        raise RuntimeError("waited")

    one_host = spark.createDataFrame([("h", 1, "ok"), ("h", 2, "ok")], "host string, id bigint, url string")
    with pytest.raises(Exception, match="waited"):
        FS.refetch_hosts(one_host, fetch, sleep=wait).collect()
    assert FS.refetch_hosts(one_host.where("id = 1"), fetch, sleep=wait).count() == 1


STUB = """#!/bin/sh
echo "run $(basename $0)"
for last; do case "$last" in */out) echo "made by $(basename $0)" > "$last";; esac; done
"""


@pytest.fixture()
def stubs(tmp_path, monkeypatch):
    folder = tmp_path / "bin"
    folder.mkdir()
    for name in {c.template.split()[0] for c in P.COMMANDS}:
        (folder / name).write_text(STUB)
        (folder / name).chmod(0o755)
    return f"{folder}:{os.environ['PATH']}"


@pytest.mark.parametrize("command", P.COMMANDS, ids=lambda c: c.table)
def test_every_command_runs(command, stubs, tmp_path, monkeypatch):
    monkeypatch.setenv("PATH", stubs)
    got, made = P._Place(str(tmp_path)).run(command, b"%PDF-1.7")
    assert got[0] == 0 and not got[1] and "{" not in " ".join(command.arguments("a", "b", 3))
    program = command.template.split()[0]
    if command.prints:
        assert made == f"run {program}\n".encode() and got[3] == ""
    else:
        assert got[3] == f"run {program}\n"[: command.stdout_most] and (made is not None) == ("{output}" in command.template)


def test_pages_are_split(spark, tmp_path):
    for name, text in (("count", 'grep -c page "$1" || true'), ("split", 'grep page "$1" | sed -n "$2p" > "$3"')):
        (tmp_path / name).write_text(f"#!/bin/sh\n{text}\n")
        (tmp_path / name).chmod(0o755)
    count, split = P.Command("page_splitter_count", f"{tmp_path}/count {{input}}"), P.Command("page_splitter", f"{tmp_path}/split {{input}} {{page}} {{output}}", "pdf")
    files = spark.createDataFrame([("f", bytearray(b"page a\npage b\n")), ("g", bytearray(b"nothing"))], "path string, content binary")
    got = sorted(map(tuple, P.split_pages(files, str(tmp_path / "o"), count, split).collect()), key=str)
    assert got == [("f", 2, 1, 0, False), ("f", 2, 2, 0, False), ("g", None, None, 0, False)]
    assert [(tmp_path / f"o/page_splitter/f-{k}.pdf").read_text() for k in (1, 2)] == ["page a\n", "page b\n"]
    one = P.split_pages(files.where("path = 'f'"), str(tmp_path / "p"), count, split, pick=3).collect()
    assert len(one) == 1 and one[0].page in (1, 2) and one == P.split_pages(files.where("path = 'f'"), str(tmp_path / "p"), count, split, pick=3).collect()


def test_output_is_bounded_and_children_end(tmp_path):
    got = P.run_one(["sh", "-c", "head -c 3000000 /dev/zero | tr '\\0' x; echo; echo e >&2"], 20, 10, 10)
    assert got[3:6] == ("x" * 10, 3_000_000, True) and got[6:] == ("e\n", 1, False)
    began = time.monotonic()
    got = P.run_one(["sh", "-c", "sleep 60 & sleep 60"], 0.3, 10, 10)
    assert got[:2] == (-1, True) and time.monotonic() - began < 4 and not got[5]
    got = P.run_one(["sh", "-c", "printf 'a\\r\\nb\\n'"], 5, 10, 10)
    assert got[3:6] == ("a\nb\n", 2, False)


def test_extraction_and_fuzzing(spark, tmp_path):
    files = spark.createDataFrame([("f", bytearray(b"abcdefgh" * 20)), ("g", None)], "path string, content binary")
    got = {r.path: r for r in P.extract(files, P.Command("icc", "cat {input}", "icc", prints=True)).collect()}
    assert got["f"].digest == hashlib.sha256(b"abcdefgh" * 20).hexdigest() and gzip.decompress(base64.b64decode(got["f"].packed)) == b"abcdefgh" * 20 and got["g"].digest is None
    c = P.Command("strict", f"sh -c 'test $(wc -c < {{input}}) -eq 160 || {{{{ echo bad >&2; exit 3; }}}}'")
    crashes = P.fuzz(files.where("path = 'f'"), c, 20, 1).collect()
    assert [(r.tool, r.exit_value, r.timeout) for r in crashes] == [("strict", 3, False)] and 0 < crashes[0].n <= 20
    again = P.mutate(b"abcdefgh" * 20, random.Random(f"1:f:{crashes[0]['round']}"))
    assert len(again) != 160 and P.fuzz(files.where("path = 'f'"), c, 20, 1).collect() == crashes


def test_languages_by_common_words(spark):
    docs = [(1, "en", "the cat and the dog"), (2, "en", "the cat and a bird"), (3, "de", "der hund und die katze"), (4, "de", "die katze und der vogel"), (5, None, "the hund and the bird"), (6, "en", ""), (7, "de", "42 7"), (8, None, "zzz")]
    df = spark.createDataFrame(docs, "id int, lang string, text string")
    common = TC.common_words(df, "lang", "text", 4)
    assert {(r.lang, r.token) for r in common.collect()} == {("en", "and"), ("en", "cat"), ("en", "the"), ("en", "bird"), ("de", "der"), ("de", "die"), ("de", "katze"), ("de", "und")}
    got = {r.id: (r.lang_detected, r.n_alphabetic, r.n_common, round(r.oov, 2)) for r in TC.language_stats(df, ["id"], "text", common).collect()}
    assert got == {1: ("en", 5, 4, 0.2), 2: ("en", 5, 4, 0.2), 3: ("de", 5, 4, 0.2), 4: ("de", 5, 4, 0.2), 5: ("en", 5, 4, 0.2), 6: (None, 0, 0, -1.0), 7: (None, 0, 0, -1.0), 8: (None, 1, 0, 1.0)}
