import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tessellar.functions import bytes as B
from tessellar.functions import dates, digests, strings, urls
from tessellar.operators import record_filter as RF


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [('"Text/HTML"', "text/html"), ("a  b\t c ", "a b c"), (None, None), ("", "")])
def test_normalize_mime(spark, raw, want):
    assert one(spark, raw, strings.normalize_mime) == want


@pytest.mark.parametrize("url,host,tld,ext", [("http://A.b.Org/x.PDF", "A.b.Org", "org", "pdf"), ("nonsense", "", "", None), ("http://10.0.0.1/a.123", "10.0.0.1", "", None), (None, "", "", None), ("http://x.de/a.html/", "x.de", "de", "html")])
def test_urls(spark, url, host, tld, ext):
    assert one(spark, url, urls.url_host) == host
    assert one(spark, url, lambda c: urls.host_tld(urls.url_host(c))) == tld
    assert one(spark, url, urls.url_extension) == ext


def test_tidy_url(spark):
    assert one(spark, " HTTPs://A.B/Path?Q ", urls.tidy_url) == "https://a.b/Path?Q"
    assert one(spark, None, urls.tidy_url) is None


def test_strings(spark):
    assert one(spark, "a\x00b", lambda c: strings.store_text(c, 2)) == "a "
    assert one(spark, "a\x00\x1f\x1e", strings.escape_controls) == "au0000u001fu001e"
    assert one(spark, " 7 or so", strings.leading_int) == 7 and one(spark, "x", strings.leading_int) is None
    assert one(spark, None, strings.primary_language) == "" and one(spark, "eng,deu", strings.primary_language) == "eng"
    assert one(spark, " a\tb\n", strings.clean_key) == "a\tb".replace("\t", " ") or one(spark, "a\tb", strings.clean_key) == "a b"


def test_dates_and_lengths(spark):
    assert str(one(spark, "Fri Aug  7 03:04:05 2026 UTC", dates.report_date)) == "2026-08-07 03:04:05"
    assert one(spark, "never", dates.report_date) is None
    assert one(spark, "-1", dates.content_length) is None and one(spark, "12", dates.content_length) == 12 and one(spark, "x", dates.content_length) is None


def test_digests(spark):
    b = b"some content"
    want = base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert one(spark, bytearray(b), digests.base32_sha1, "binary") == want
    assert one(spark, bytearray(b), lambda c: digests.same_digest(c, F.lit("sha1:" + want.lower())), "binary") is True
    assert bytes(one(spark, bytearray(b), lambda c: digests.unpack(digests.pack(c)), "binary")) == b
    assert one(spark, "no payload", digests.unpack) is None and one(spark, None, digests.unpack) is None
    assert one(spark, base64.b64encode(b"ab\xff").decode(), digests.base64_ascii) == "ab?"
    assert one(spark, "x/aa/bb/0123456789abcdef", digests.normal_file_path) == "aa/bb/0123456789abcdef"


def test_bytes(spark):
    f = one(spark, bytearray(b"xx%PDF-1 %%EO%%EOF%%EOF"), B.byte_facts, "binary")
    assert f["eofs"] == [18, 23] and f["header_offset"] == 2 and bytes(f["preheader"]) == b"xx"
    assert one(spark, None, B.byte_facts, "binary")["header_offset"] == -1
    j = json.loads(spark.createDataFrame([(bytearray(b"x%PDF-%%EOF"),)], "v binary").select(B.byte_facts(F.col("v")).alias("f")).select(B.byte_facts_json(F.col("f")).alias("j")).first()["j"])
    assert j == {"preheader": base64.b64encode(b"x").decode(), "eofs": [11], "header-offset": 1}


CONF = {"status": 200, "exact": {"mimes": ["Application/PDF", {"pattern": "text/html", "probability": "0.5"}], "detected_mimes": [{"pattern": "a/b", "probability": 0}]}, "regex": {"mimes": ["\\Aaudio", {"pattern": "blah.{3}\\Z"}]}}


def test_filter_order_and_rates(spark):
    f = RF.load_filter(json.dumps(CONF))
    rows = [(200, "application/pDf", "a/b"), (404, "application/pdf", None), (None, "application/pdf", None), (200, None, "A/B"), (200, "audio/x", None), (200, "x-audio", None), (200, "text/html", "a/b"), (200, "BlahpDf", None), (200, "blahpdfa", None)]
    df = spark.createDataFrame(rows, "s int, m string, d string")
    got = [r[0] for r in df.select(f.stratum(F.col("s"), F.col("m"), F.col("d"))).collect()]
    assert got == ["exact.mimes:Application/PDF", None, None, "exact.detected_mimes:a/b", "regex.mimes:\\Aaudio", None, "exact.mimes:text/html", "regex.mimes:blah.{3}\\Z", None]
    assert f.rates()["exact.mimes:text/html"] == 0.5 and f.rates()["exact.detected_mimes:a/b"] == 0


def test_filter_sampling_is_stable_and_nested(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.lit(200).alias("s"), F.lit("text/html").alias("m"), F.lit(None).cast("string").alias("d"))
    pick = lambda p, df: {r.k for r in df.where(RF.RecordFilter((RF.Rule("exact", "mimes", "text/html", p),), ()).accept(F.col("s"), F.col("m"), F.col("d"), F.col("k"))).collect()}
    a, b = pick(0.1, ids), pick(0.2, ids.repartition(7))
    assert a < b and abs(len(a) - 2000) < 250 and pick(0.1, ids.repartition(3)) == a and pick(0.0, ids) == set()


def test_filter_absent_and_bad(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s int, m string, d string, k string")
    assert df.where(RF.load_filter(None).accept(*(F.col(c) for c in "smdk"))).count() in (0, 1)
    with pytest.raises(ValueError):
        RF.load_filter("[1]")
    assert RF.load_filter('{"defaultProbability": 0.25, "exact": {"mimes": ["a"]}}').rates() == {"default": 0.25}
