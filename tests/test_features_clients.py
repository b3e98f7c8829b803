import json

from pyspark.sql import functions as F

from tessellar.operators import clients as C
from tessellar.operators import features as FE
from tessellar.operators import relational as R


def test_mappers(spark):
    fonts = "name       type     encoding emb sub uni object\n---------- -------- -------- --- --- --- ------\nAbc        Type 1   Std      yes no  no  1 0\n"
    row = ("f", " ", "Pages: 3\n", "x: 4", fonts, '{"eofs":[1],"header-offset":0}', '[{"Content-Type":"a/b;c"}]', "BEGIN\nError: bad (x)", False, 0, "0.5", "NaN", None, "crash")
    names = "fname string, cpu_warn string, pinfo_stdout string, pr string, pdffonts_stdout string, pdfbytes_stdout string, tika_json string, arlington_txt string, arlington_timeout boolean, arlington_exit_value int, oov_0 string, oov_1 string, qpdf_json string, mc_status string"
    r = FE.apply(spark.createDataFrame([row], names), ["profile", "cpu", "pdfinfo", "pdfresurrect", "pdffonts", "xpdffonts", "pdfbytes", "pdfchecker", "tika", "arlington", "comparison", "qpdf", "status"]).first()
    assert (r.original_fname, r.cpu_warn, r.pinfo_pages, r.pr_updates, r.pf_font_names, r.b_num_eofs, r.tk_mime, r.a_status, r.a_warn) == ("f", None, 3, 4, ["Abc"], 1, "a/b", "warn", ["bad"])
    assert (r.tk_oov, r.mt_oov, r.q_status, r.tools_status_fail) == ("0.5", None, "missing", "mc")


def test_earlier_features_stay_and_extracts_join(spark):
    df = FE.with_extracts(spark.createDataFrame([("a", "9"), ("b", None)], "path string, tk_oov string"), {"tika_json": spark.createDataFrame([("a", json.dumps([{"tika-eval:oov": "0.1"}])), ("a", None)], "path string, text string")})
    got = {r.path: (r.tk_oov, r.tk_extract) for r in FE.apply(df, ["tika"]).collect()}
    assert got == {"a": ("9", None), "b": (None, "missing")}
    t = FE.tidy(spark.createDataFrame([("\x00", " ", ["a\x1f"])], "a string, b string, c array<string>")).first()
    assert tuple(t) == ("u0000", None, ["au001f"])
    assert [x[0] for x in spark.createDataFrame([(["x"],), (["x", "y"],), ([],)], "v array<string>").select(FE.collapse(F.col("v"))).collect()] == ["x", '["x","y"]', None]


def test_packs(spark):
    r = spark.createDataFrame([("Pages:   7\nPage rot: 90\nTagged: no\n",)], "t string").select(FE.info_pack(F.col("t")).alias("i")).first().i
    assert (r.pages, r.page_rotation, r.tagged, r.creator) == (7, 90, "no", None)


def test_files(spark):
    files = spark.createDataFrame([("a", bytearray(b"xy")), ("b", None)], "path string, content binary")
    assert sorted(map(tuple, FE.map_files(files, lambda p, c: (p, len(c)), "path string, n int").collect())) == [("a", 2), ("b", 0)]
    assert FE.parse_files(files, lambda p, c: [{"n": [str(len(c))]}] * 2).where("part = 1").count() == 2
    assert FE.of_mime(files.withColumn("m", F.lit("a/pdf")), F.col("m"), "pdf").count() == 2


def test_client_retries():
    answers = iter([OSError(), (503, None), (200, [{"k": ["v"]}])])
    waits = []

    def send(name, content):
        a = next(answers)
        if isinstance(a, OSError):
            raise a
        return a

    assert C.request(send, "x", b"", sleep=waits.append) == ("RESPONSE_SUCCESS", [{"k": ["v"]}], 3) and waits == [1]
    assert C.request(lambda n, c: (500, None), "x", b"", sleep=waits.append)[::2] == ("RESPONSE_NON_200_STATUS", 3)
    clock = iter(range(0, 1000, 20))

    def down(n, c):
        raise OSError

    assert C.request(down, "x", b"", sleep=waits.append, clock=lambda: next(clock))[0] == "NO_RESPONSE_IO_EXCEPTION"


def test_put():
    import io
    import urllib.error

    asked = []

    class Answer(io.BytesIO):
        status = 200

    def opener(request, timeout):
        asked.append((request.method, request.data, request.headers["Content-disposition"], timeout))
        if request.data == b"bad":
            raise urllib.error.HTTPError("u", 422, "no", {}, None)
        return Answer(b'[{"k": ["v"]}]')

    send = C.put_json("http://x.invalid/parse", 9, opener=opener)
    assert C.once(send, "a b.pdf", b"1") == ("RESPONSE_SUCCESS", [{"k": ["v"]}]) and asked[0] == ("PUT", b"1", "attachment; filename*=UTF-8''a%20b.pdf", 9)
    assert send("x", b"bad") == (422, None)
    assert C.once(C.put_json("http://x.invalid/", opener=lambda r, timeout: Answer(b"{")), "x", b"") == ("RESPONSE_BAD_ENTITY", None)


def test_requests_of_a_load_test_run_at_once(spark):
    import threading
    import time

    def send(name, content):
        n = sum(t.name.startswith("ThreadPool") for t in threading.enumerate())
        time.sleep(0.2)
        return 200, [{"at_once": [str(n >= 4)]}]

    files = spark.createDataFrame([("a", bytearray(b"1"))], "path string, content binary")
    began = time.monotonic()
    assert C.load_test(files, send, 8, ["at_once"], 8).first().differing == 0 and time.monotonic() - began < 8


def test_remote_and_load(spark):
    files = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "path string, content binary")
    send = lambda n, c: (200, [{"n": [n], "time": [str(id(c))]}]) if n == "a" else (415, None)
    assert {r.path: r.outcome for r in C.parse_remote(files, send, str).collect()} == {"a": "RESPONSE_SUCCESS", "b": "RESPONSE_UNPROCESSABLE_EXCEPTION"}
    assert {r.path: r.differing for r in C.load_test(files, send, 3, ["time"]).collect()} == {"a": 0, "b": 0}
    assert C.same_answer([{"a": ["1"]}], [{"a": ["2"]}]) == "part 0: a" and C.same_answer([], [{}]) == "parts: 0 and 1"


def test_locate_and_observe(spark):
    blocks = spark.createDataFrame([("10.0.0.0", "10.3.0.7", "x"), ("10.3.0.8", "10.3.0.8", "y")], "first_ip string, last_ip string, place string")
    rows = spark.createDataFrame([("10.2.9.9",), ("10.3.0.8",), ("10.3.0.9",), ("bad",), (None,), ("300.1.1.1",), ("10.0.0.0",)], "ip string")
    got = {r.ip: r.place for r in R.locate(rows, "ip", blocks, ["place"]).collect()}
    assert got == {"10.2.9.9": "x", "10.3.0.8": "y", "10.3.0.9": None, "bad": None, None: None, "300.1.1.1": None, "10.0.0.0": "x"}
    df, seen = R.observed(rows, "n")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7
    assert [(r.digest, r.n) for r in R.digest_counts(spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "d string"), F.col("d")).collect()] == [("b", 2), ("a", 1)]
