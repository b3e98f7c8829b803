import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessellar import sinks as K
from tessellar.operators import object_graph as OG
from tessellar.operators import reports as RP
from tessellar.sources import files as S
from tessellar.streaming import incremental as I


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "t string").select(make(F.col("t")).alias("x")).first()["x"]


def test_info_report(spark):
    r = one(spark, "Creator: GPL 9\r\nPages:  2\nEncrypted: yes (x)\nCreationDate: Fri Aug  7 03:04:05 2026 CET\n", RP.info_report)
    assert (r.pinfo_creator, r.pinfo_pages, r.pinfo_encrypted, str(r.pinfo_created), r.pinfo_producer) == ("GPL 9", 2, True, "2026-08-07 03:04:05", None)
    assert one(spark, None, RP.info_report).pinfo_pages is None


def test_captures(spark):
    assert one(spark, "a=1 a=2\nb\na=3\na=1", lambda c: RP.capture_lines(c, r"a=(\d)")) == ["1", "3"]
    assert one(spark, "x\ny: 7 z", RP.update_count) == 7
    assert one(spark, "x", lambda c: RP.capture_first(c, "(y)")) is None


def test_grammar(spark):
    s = lambda t, late=False, code=0: one(spark, t, lambda c: RP.grammar_status(c, F.lit(late), F.lit(code)))
    assert s("BEGIN\nError: b (x)\nError: a\nError: a").a_warn == ["a", "b"]
    assert s("BEGIN\nError: x Can't select any link y").a_warn == ["Can't select any link"]
    assert s("BEGIN\nFailed to open document").a_status == "fail" and s("x", late=True).a_status == "timeout" and s("x", code=2).a_status == "crash" and s(None).a_status == "missing_extract"
    assert s("").a_status is None


def test_fonts(spark):
    t = "name       type     emb sub uni prob object\n---------- -------- --- --- --- ---- ------\nAbc        Type 1   yes no  no       1 0  x\n"
    f = one(spark, t, lambda c: RP.font_table(c, RP.XPDF_FONT_COLUMNS))
    assert (f.names, f.types, f.embedded, f.unicode) == (["Abc"], ["Type 1"], "yes", "no")
    assert one(spark, "single", RP.font_table) is None and one(spark, None, RP.font_table) is None


def test_json_reports(spark):
    assert one(spark, "{bad", RP.checker_report).pc_font_errors is None and one(spark, "{bad", RP.metadata_report).tk_mime is None
    assert one(spark, '{"preheader":"YQ==","eofs":[931,1241],"header-offset":1}', RP.byte_report).b_num_eofs == 2
    assert one(spark, "nope", RP.byte_report) is None
    d = one(spark, "no key here", RP.dump_report)
    assert d.parseable is False and d.pages == []


def test_graph(spark):
    loop = json.dumps({"objects": {"1 0 R": {"/Filter": "2 0 R", "/S": 7, "/T": 1.5, "/Title": "x", "/A": True}, "2 0 R": "2 0 R", "3 0 R": [[{"/K": "b:ab"}]]}})
    g = one(spark, loop, OG.object_graph)
    assert g.status == "ok" and g.filters == ["2 0 R"] and g.max_filter_count == 1
    assert g.keys_and_values == ["/A->TRUE", "/Filter->REF", "/K->b:ab", "/S->7", "/T->NUMBER", "/Title->STRING"]
    assert one(spark, None, OG.object_graph).status == "missing" and one(spark, "[]", OG.object_graph).status == "bad_extract"
    deep = '{"objects": {"1 0 R": ' + '{"/a":' * 400 + "1" + "}" * 400 + "}}"
    assert one(spark, deep, OG.object_graph).keys == ["/a"]
    df = spark.createDataFrame([(json.dumps({"objects": {"1 0 R": {"/F1": 1, "/Odd": 1, "/" + "x" * 200: 1, "/Known": 2}}}),)], "t string").withColumn("g", OG.object_graph(F.col("t")))
    r = OG.graph_features(df, "g", ["/Known"]).first()
    assert r.q_keys_oos == ["/Odd", "/" + "x" * 99 + "..."]
    names = dict.fromkeys(["/F1", "/TT1_2", "/XO7", "/F1NotASpecKey", "/CustomTT1_2", "/TT1_2x", "/AF1"], 1)
    df = spark.createDataFrame([(json.dumps({"objects": {"1 0 R": names}}),)], "t string").withColumn("g", OG.object_graph(F.col("t")))
    assert OG.graph_features(df, "g").first().q_keys_oos == ["/AF1", "/CustomTT1_2", "/F1NotASpecKey", "/TT1_2x"]


LINE = 'org,x)/ 20240101000000 {"url": "http://x.org/{a}", "mime": "text/html", "mime-detected": "text/html", "status": "200", "digest": "AB", "length": "10", "offset": "7", "filename": "f", "redirect": "{b}"}'


def test_index(spark, tmp_path):
    p = tmp_path / "cdx-00000.gz"
    p.write_bytes(gzip.compress(("\n".join([LINE, "", LINE.partition(" {")[0] and "{" + LINE.partition(" {")[2], LINE + " }", "rubbish"])).encode()))
    r = S.parse_index(S.index_lines(spark, str(p))).collect()
    assert [x.ok for x in r] == [True, True, True, False] and r[0].url == "http://x.org/{a}" and r[0].status_n == 200 and r[0].surt == "org,x)/" and r[1].surt is None
    bad = tmp_path / "cdx-00001.gz"
    bad.write_bytes(p.read_bytes()[:-9])
    assert {x.path.rsplit("/")[-1]: x.ok for x in S.check_shards(spark, str(tmp_path / "*.gz")).collect()} == {"cdx-00000.gz": True, "cdx-00001.gz": False}
    (tmp_path / "paths").write_text("a/b.gz\nx\na/c.gz\n")
    assert S.manifest(spark, str(tmp_path / "paths"), "s3/") == ["s3/a/b.gz", "s3/a/c.gz"]
    assert S.grep(spark, str(p), "rubb").count() == 1 and S.index_lines(spark, str(p), 2).count() == 2


def test_warc_ranges(spark, tmp_path):
    rec = lambda body: gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nX: y\r\n\r\n" + body + b"\r\n\r\n")
    a, b = rec(b"first"), rec(b"second")
    (tmp_path / "w").write_bytes(a + b)
    rows = spark.createDataFrame([(2, str(tmp_path / "w"), len(a), len(b)), (1, str(tmp_path / "w"), 0, len(a)), (3, str(tmp_path / "w"), 3, 5), (4, str(tmp_path / "none"), 0, 1)], "id bigint, file string, offset bigint, length bigint")
    got = {r.id: r for r in S.warc_payloads(rows).collect()}
    assert bytes(got[1].payload) == b"first" and bytes(got[2].payload) == b"second" and got[1].http_status == 200 and not got[3].ok and not got[4].ok


def test_tables_and_lists(spark, tmp_path):
    (tmp_path / "r.csv").write_text("path,exit_value,timeout,process_time_ms,stdout,stdout_length,stdout_truncated,stderr,stderr_length,stderr_truncated\na,0,false,1,\"x\ny\",2,false,,0,false\n")
    assert S.tool_results(spark, str(tmp_path / "r.csv")).first().stdout == "x\ny" and S.csv_rows(spark, str(tmp_path / "r.csv")) == 1
    (tmp_path / "universe_B.csv").write_text("key,validity\nabcdef,ok\n")
    assert tuple(S.universes(spark, str(tmp_path / "universe_B.csv")).first()) == ("eval-three/ab/cd/abcdef", "B", "ok")
    (tmp_path / "list").write_text(" a x\n\nb\n")
    assert [r.key for r in S.key_list(spark, str(tmp_path / "list")).collect()] == ["a", "b"]
    assert S.fill_template("x ${a}", {"a": "1"}) == "x 1"
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/f.json").write_text("{}")
    assert S.base_names(S.contents(spark, str(tmp_path / "d"))).first().path == "e/f" and S.walk(spark, str(tmp_path / "d")).count() == 1 and S.documents_json(spark, str(tmp_path / "d/e")).first().text == "{}"
    assert [r.path for r in S.shard_names(spark.createDataFrame([("c",)], "crawl string"), 2).collect()] == ["cc-index/collections/c/indexes/cdx-00000.gz", "cc-index/collections/c/indexes/cdx-00001.gz"]


def test_http_back_off():
    import io
    import urllib.error

    calls, waits = [], []

    def get(request):
        calls.append(request.headers)
        if len(calls) < 3:
            raise urllib.error.HTTPError("u", 503, "busy", {}, None)
        return io.BytesIO(b"ok")

    assert S.http_get("http://x.invalid/", 1, 5, sleep=waits.append, get=get) == b"ok" and waits == [30, 120] and calls[0] == {"Range": "bytes=1-5"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2025, 1, 1), "a")], "id int, at timestamp_ntz, v string")
    p = str(tmp_path / "t")
    K.upsert_table(df, p, ["id"], [F.col("at")])
    K.upsert_table(df.withColumn("at", F.lit(datetime(2025, 2, 1)).cast("timestamp_ntz")).withColumn("v", F.lit("b")), p, ["id"], [F.col("at")])
    assert [r.v for r in spark.read.parquet(p).collect()] == ["b"]
    K.upsert_table(df, p, ["id"], [F.col("at")], delta=False)
    assert [r.v for r in spark.read.parquet(p).collect()] == ["a"]
    (tmp_path / "t").rename(tmp_path / "t.new")  # as if the driver had died before the swap
    K.upsert_table(df.withColumn("id", F.lit(2)), p, ["id"], [F.col("at")])
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [1, 2]
    files = spark.createDataFrame([("x", bytearray(b"1")), ("y", bytearray(b"1")), ("z", None)], "path string, content binary")
    assert [r.outcome for r in K.write_blobs(files, str(tmp_path / "blobs")).collect()] == ["written"]
    assert [r.outcome for r in K.write_blobs(files, str(tmp_path / "blobs")).collect()] == ["present"]
    cells = K.export_cells(spark.createDataFrame([(["b", "a"], None)], "l array<string>, s string"), ["l", "s"]).first()
    assert tuple(cells) == ("a b", "")
    K.write_query_csv(spark, "SELECT 1 AS a, 'x,y' AS b", str(tmp_path / "q"))
    assert next((tmp_path / "q").glob("*.csv")).read_text() == 'a,b\n1,"x,y"\n'
    K.write_counts(spark.createDataFrame([("a", 1), ("b", 2)], "key string, n int"), str(tmp_path / "c"))
    assert "".join(x.read_text() for x in sorted((tmp_path / "c").glob("*.csv"))) == "b\t2\na\t1\n"
    K.write_url_list(spark.createDataFrame([("a\r\nb",), (None,)], "url string"), str(tmp_path / "u"))
    assert "".join(x.read_text() for x in (tmp_path / "u").glob("*.txt")) == "a  b\n"
    K.reload_states(spark, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 23
    m = K.mapped(spark.createDataFrame([({"k": ["7", "8"]},)], "m map<string,array<string>>"), "m", {"k": ("n", "int"), "z": ("t", "string")})
    assert tuple(m.first()) == (7, None)
    K.write_mismatches(files.where("path = 'x'"), str(tmp_path / "mm"))
    assert "".join(x.read_text() for x in (tmp_path / "mm").glob("*.csv")).startswith("x\t")
    K.write_by_name(df, str(tmp_path / "o.json"))
    K.append_status(df, str(tmp_path / "st"), "a")
    K.append_status(df, str(tmp_path / "st"), "a")
    K.write_features(df, str(tmp_path / "fe"))
    assert spark.read.json(str(tmp_path / "o.json")).count() == spark.read.parquet(str(tmp_path / "st")).count() == spark.read.parquet(str(tmp_path / "fe")).count() == 1


def test_incremental_upsert(spark, tmp_path):
    src, out, prog = (str(tmp_path / x) for x in ("src", "out", "prog"))
    row = lambda i, d, v: spark.createDataFrame([(i, datetime(2025, 1, d), v)], "id int, at timestamp_ntz, v string")
    row(1, 1, "a").write.parquet(src)
    go = lambda: I.upsert_stream(I.landed(spark, src, row(1, 1, "a").schema), out, prog, ["id"], [F.col("at")])
    go()
    row(1, 2, "b").write.mode("append").parquet(src)
    row(2, 1, "c").write.mode("append").parquet(src)
    go()
    go()
    assert sorted((r.id, r.v) for r in spark.read.parquet(out).collect()) == [(1, "b"), (2, "c")]


def test_late_rows_in_a_stream(spark, tmp_path):
    src, prog = str(tmp_path / "src"), str(tmp_path / "prog")
    df = spark.createDataFrame([(datetime(2025, 1, 1, 5), "a"), (datetime(2025, 1, 20), "a"), (datetime(2025, 1, 1, 9), "a")], "at timestamp_ntz, k string")
    df.write.parquet(src)
    q = I.late_counts(I.landed(spark, src, df.schema), "at", ["k"]).writeStream.format("memory").queryName("late_counts").outputMode("complete").option("checkpointLocation", prog).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("late_counts").collect()) == [1, 2]


def test_jdbc_ranges(spark):
    url = "jdbc:derby:memory:tessellar;create=true"
    spark.range(100).select(F.col("id").cast("int").alias("ID"), F.concat(F.lit("p"), "id").alias("PATH")).write.format("jdbc").options(url=url, dbtable="T", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").mode("overwrite").save()
    got = S.jdbc(spark, url, "SELECT ID, PATH FROM T WHERE ID >= 10", "ID", 0, 100, 4, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert got.rdd.getNumPartitions() == 4 and got.count() == 90


def test_results_keep_blanks(spark, tmp_path):
    row = ("p", 0, False, 1, " out ", 5, False, 'a "b"\n c, ', 9, True)
    df = spark.createDataFrame([row], "path string, exit_value int, timeout boolean, process_time_ms bigint, stdout string, stdout_length bigint, stdout_truncated boolean, stderr string, stderr_length bigint, stderr_truncated boolean")
    K.write_results_csv(df, str(tmp_path / "r.csv"))
    assert tuple(S.tool_results(spark, str(tmp_path / "r.csv")).first()) == row


def test_config_rows(spark):
    spark.createDataFrame([(1, "f", 3, 9)], "id int, file string, a int, b int").createOrReplaceTempView("work_rows")
    conf = {"query": S.fill_template("SELECT * FROM ${t}", {"t": "work_rows"}), "id_column": "id", "fetch_key_column": "file", "range_start_column": "a", "range_end_column": "b"}
    assert S.config_rows(spark, conf).first().asDict() == {"id": 1, "fetch_key": "f", "range_start": 3, "range_end": 9}
    assert spark.range(1).select(S.byte_range(F.lit(5), F.lit(10)).alias("r")).first().r == "bytes=5-14"


def test_swap_that_fails_keeps_the_old_table(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(3).write.parquet(p)
    with pytest.raises(OSError):
        K.swap_in(spark, str(tmp_path / "nothing"), p)
    assert spark.read.parquet(p).count() == 3 and not (tmp_path / "t.old").exists()
    (tmp_path / "t").rename(tmp_path / "t.old")
    assert K.table_exists(spark, p) and spark.read.parquet(p).count() == 3


def test_jdbc_merge_by_key(spark):
    driver, url = "org.apache.derby.iapi.jdbc.AutoloadedDriver", "jdbc:derby:memory:merged;create=true"
    rows = lambda *r: spark.createDataFrame(list(r), "path string, n int, at timestamp_ntz")
    put = lambda df, **k: K.upsert_jdbc(df, url, "results", ["path"], [F.col("at")], driver, "path VARCHAR(64)", **k)
    put(rows(("a", 1, datetime(2025, 1, 1)), ("a", 2, datetime(2025, 1, 2)), ("b", None, None)))
    for _ in range(2):  # a batch that comes again changes nothing more
        put(rows(("b", 3, datetime(2025, 1, 3)), ("c", 4, datetime(2025, 1, 3))))
    read = lambda: {r.path: r.n for r in spark.read.format("jdbc").options(url=url, dbtable='"results"', driver=driver).load().collect()}
    assert read() == {"a": 2, "b": 3, "c": 4}
    waits = []
    with pytest.raises(Exception, match="no-such"):
        K.upsert_jdbc(rows(), "jdbc:derby:memory:no-such", "t", ["path"], [F.col("at")], driver, tries=2, sleep=waits.append)


def test_bulk_sink_flushes_and_tries_again(spark, tmp_path):
    folder = str(tmp_path)

    def send(bulk):
        from tessellar.files import exists, put

        if not exists(f"{folder}/tried-{bulk[0]['id']}"):
            put(f"{folder}/tried-{bulk[0]['id']}", b"")
            raise OSError("busy")
        put(f"{folder}/sent-{bulk[0]['id']}", str(sum(x["id"] for x in bulk)).encode())

    got = K.send_bulk(spark.range(250).coalesce(1), send, most=100, sleep=lambda s: None).collect()
    assert [tuple(r) for r in got] == [(100, 2), (100, 2), (50, 2)] and sum(int(x.read_text()) for x in tmp_path.glob("sent-*")) == sum(range(250))

    def never(bulk):
        raise OSError("down")

    with pytest.raises(Exception, match="down"):
        K.send_bulk(spark.range(3), never, sleep=lambda s: None).collect()


def test_extras_are_deleted_only_when_sure(spark, tmp_path):
    (tmp_path / "x").write_text("1")
    paths = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "path string")
    assert {r.path: r.outcome for r in K.delete_extras(paths, str(tmp_path)).collect()} == {"x": "would delete", "y": "would delete"} and (tmp_path / "x").exists()
    assert {r.path: r.outcome for r in K.delete_extras(paths, str(tmp_path), sure=True).collect()} == {"x": "deleted", "y": "absent"} and not (tmp_path / "x").exists()


def test_ranges_over_http(spark, tmp_path):
    import io

    data = b"0123456789"
    asked = []

    def get(request):
        a, b = request.headers["Range"].removeprefix("bytes=").split("-")
        asked.append((int(a), int(b)))
        return io.BytesIO(data[int(a) : int(b) + 1])

    f = S.HttpRanges("http://x.invalid/w", get)
    f.seek(3)
    assert f.read(4) == b"3456" and f.read(2) == b"78" and asked == [(3, 6), (7, 8)]
    assert isinstance(S.archive("https://x.invalid/w"), S.HttpRanges)
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"one\n\n two\n"))
    from tessellar.files import get as read

    lines = S.http_index_lines(spark.createDataFrame([(str(tmp_path / "a.gz"),), (None,)], "url string"), read)
    assert sorted(r.value for r in lines.collect()) == [" two", "one"]


def test_scroll(spark):
    pages = {None: (["a", "b"], "1"), "1": ([], "2"), "2": (["c"], None)}
    got = S.scrolled(spark.createDataFrame([(0,), (1,)], "slice int"), lambda k, cursor: pages[cursor]).collect()
    assert sorted((r.slice, r.document) for r in got) == [(k, x) for k in (0, 1) for x in "abc"]


def test_dump_sections_end_at_line_ends_only(spark):
    text = "# Random Key: 7\n# Number of Pages: 1 key=7\n# Page 1 key=7\n## Text Content key=7\na\fb\x85c\r\nd\n# Page 2 key=8\n# End of Document key=7\nx"
    d = one(spark, text, RP.dump_report)
    assert d.pages == ["a\fb\x85c\nd\n# Page 2 key=8\n"] and d.n_pages == 1
