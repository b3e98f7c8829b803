from datetime import datetime

import pytest

from tessellar.operators import log_entries as G

AT = datetime(2025, 3, 1, 22, 0, 0)
SCHEMA = "run_id bigint, started_at timestamp_ntz, stderr string, tool string, line_no string"


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "clash") for r in rows], SCHEMA)
    return {(r.run_id, r.line_no): (r.n_lines, r.log_ts, r.log_level, r.component) for r in G.entries(df, **kw).collect()}


HEADERS = [
    ("warning: odd page", "", "WARN", ""),
    ("qpdf: ERROR: odd", "", "ERROR", "qpdf"),
    ("INFO: (object 3 0, offset 6): odd", "", "INFO", ""),
    ("[stream-filter] Info (pos 7): odd", "", "INFO", "stream-filter"),
    ("DEBUG:root:odd", "", "DEBUG", "root"),
    ("**** Note: odd", "", "INFO", ""),
    ("ERROR [main] 02:01:55,067 o.q.c.Filter odd", "2025-03-01 02:01:55", "ERROR", "o.q.c.Filter"),
    ("2025-03-10 03:28:23,304 WARN  [pool-3-thread-6] a.b.Main - odd", "2025-03-10 03:28:23", "WARN", "a.b.Main"),
    ("2025-02-15 17:24:18,906 - root - ERROR - odd", "2025-02-15 17:24:18", "ERROR", "root"),
    ("1742633933100|WARN|pages|odd", "2025-03-22 08:58:53", "WARN", "pages"),
    ("[1743906521.533] <crit> meta: odd", "2025-04-06 02:28:41", "FATAL", "meta"),
    ('{"module": "icc", "lvl": "warning", "time": "2025-05-01T02:41:54+01:00", "msg": "odd"}', "2025-05-01 01:41:54", "WARN", "icc"),
    ('lvl=fatal ts=2025-04-27T22:35:24.653Z component=crypt msg="odd level=debug"', "2025-04-27 22:35:24", "FATAL", "crypt"),
    ("W0331 16:01:53.870670   38640 xref.go:595] odd", "2025-03-31 16:01:53", "WARN", "xref.go"),
    ("Mar  2 23:45:00 node3 scan-runner[41]: ERROR: odd", "2025-03-02 23:45:00", "ERROR", "scan-runner"),
    ("Mar 12 23:45:04 node19 freshdb[2]: odd at 12:58:07", "2025-03-12 23:45:04", "", "freshdb"),
    ("2025-03-01T10:00:00.123Z  INFO 12345 --- [main] c.e.App : odd", "2025-03-01 10:00:00", "INFO", "c.e.App"),
    ("[2025-03-01 10:00:00,123] {task.py:90} INFO - odd", "2025-03-01 10:00:00", "INFO", "task.py"),
    ("ERROR 2025-03-01 10:00:00,123 module 123 odd", "2025-03-01 10:00:00", "ERROR", ""),
    ("2025/03/01 10:00:00 [error] 123#0: *1 odd", "2025-03-01 10:00:00", "ERROR", ""),
    ('time="2025-03-01T10:00:00+02:00" level=info msg="x y" component=yy', "2025-03-01 08:00:00", "INFO", "yy"),
]
NONE = ["Traceback (most recent call last):", "KeyError: odd", "a.b.BadState: odd (error: none)", "Caused by: a.B: odd", "while reading x", "-----", "build 7.41", "error reading file", ""]


def test_headers(spark):
    got = found(spark, [(i, AT, h[0]) for i, h in enumerate(HEADERS)])
    assert got == {(i, 1): (1, *h[1:]) for i, h in enumerate(HEADERS)}
    assert found(spark, [(i, AT, x) for i, x in enumerate(NONE)]) == {}


def test_blocks_and_further_lines(spark):
    text = "banner\n\nMar 02, 2025 3:14:46 PM a.b.Main load\r\nSEVERE: odd\r\n\tat x\n\n> 2025-01-01 00:00:00 INFO quoted\n  \n{\n  \"level\": \"fine\",\n  \"logger\": \"x\"\n}\n\x1b[31merror: last\x1b[0m\n\n"
    assert found(spark, [(1, AT, text)]) == {(1, 3): (5, "2025-03-02 15:14:46", "ERROR", "a.b.Main"), (1, 9): (4, "", "DEBUG", "x"), (1, 13): (1, "", "ERROR", "")}


def test_nulls_repeats_and_empty(spark):
    rows = [(1, AT, "error: a"), (1, AT, "error: a"), (2, None, "01:02:03 ERROR a.b - x"), (3, AT, None), (None, AT, "error: b"), (4, AT, "")]
    assert found(spark, rows) == {(1, 1): (1, "", "ERROR", ""), (2, 1): (1, "", "ERROR", "a.b")}
    assert found(spark, []) == {}


def test_many_copies_of_a_run(spark):
    rows = [(7, AT, "error: a\n  b\ninfo: c")] * 500 + [(i, AT, "warning: d") for i in range(5)]
    want = {(7, 1): (2, "", "ERROR", ""), (7, 3): (1, "", "INFO", "")} | {(i, 1): (1, "", "WARN", "") for i in range(5)}
    assert found(spark, rows) == want


def test_differing_copies_of_a_run(spark):
    got = found(spark, [(1, AT, "error: a"), (1, AT, "info: b\nwarn: c")])
    assert got in ({(1, 1): (1, "", "ERROR", ""), (1, 2): (1, "", "WARN", "")}, {(1, 1): (1, "", "INFO", ""), (1, 2): (1, "", "WARN", "")})  # one key of the dict for two rows
    df = spark.createDataFrame([(1, AT, "error: a", "t", "c"), (1, AT, "info: b\nwarn: c", "t", "c"), (1, AT, "error: a\n  more", "t", "c"), (1, AT, "info: b", "t", "c")], SCHEMA)
    rows = sorted((r.line_no, r.n_lines, r.log_level) for r in G.entries(df).collect())
    assert rows == [(1, 1, "ERROR"), (1, 1, "INFO"), (1, 2, "ERROR"), (2, 1, "WARN")]


def test_long_text_and_salted_joins(spark):
    text = "\n".join(f"warning: page {i}\n  more" for i in range(3000))
    got = found(spark, [(1, AT, text)], max_rows=0)
    assert len(got) == 3000 and set(got.values()) == {(2, "", "WARN", "")}


def test_partition_splits_by_bijection(spark):
    seqs = [G.SEP.join(x) for x in (["a", "x", "1"], ["a", "x", "2"], ["b", "y", "1"], ["b", "y", "2"], ["c", "z", "1"], ["c", "z", "2"], ["a"])]
    parts = G.partition(spark.createDataFrame([(s,) for s in seqs], "seq string"))
    templates = {tuple(r.template) for r in G.leaf_templates(parts).collect()}
    assert ("a",) in templates and len(templates) >= 3


def test_messages(spark):
    text = 'x.c: ERROR: one two\n  more\r\nwarning: b\n{"level": "info", "msg": "c \\"d\\""}\nlvl=warn msg="e f"\n{\n  "level": "info",\n  "msg": "g"\n}\ntail\n{"level": "info", "msg": "cut o'
    df = spark.createDataFrame([(1, AT, text, "t", "c"), (1, AT, text, "t", "c"), (2, AT, None, "t", "c")], SCHEMA)
    got = [(r.line_no, r.n_lines, r.message) for r in G.entries(df, messages=True).orderBy("line_no").collect()]
    assert got == [(1, 2, "one two\n  more"), (3, 1, "b"), (4, 1, 'c "d"'), (5, 1, "e f"), (6, 5, "g\ntail"), (11, 1, "cut o")]


def test_message_goes_on_in_the_next_line_and_beyond_entries(spark):
    text = "banner\nMar 02, 2025 3:14:46 PM a.b.Main load\nSEVERE: odd thing\n\n\tat x\nplain\n2025-01-01 00:00:00 INFO a.b - c"
    df = spark.createDataFrame([(1, AT, text, "t", "c")], SCHEMA)
    for most in (0, 1000):
        got = [(r.line_no, r.n_lines, r.message) for r in G.entries(df, max_rows=most, messages=True).orderBy("line_no").collect()]
        assert got == [(2, 5, "odd thing\n\tat x\nplain"), (7, 1, "c")]


@pytest.mark.parametrize("kind,raw,want", [("iso", "2025-02-30 00:00:00", ""), ("iso", "2025-01-01T00:30:00+0200", "2024-12-31 22:30:00"), ("long", "Jan 1, 2025 12:05:00 AM", "2025-01-01 00:05:00"), ("clf", "01/Feb/2025:10:00:00 -0130", "2025-02-01 11:30:00")])
def test_to_utc(kind, raw, want):
    assert G.to_utc(kind, raw, AT) == want


def test_messages_of_very_long_lines(spark):
    text = "2025-01-01 00:00:00 INFO a.b - " + "word " * 20_000 + "\n" + "x=1 " * 20_000 + 'level=warn msg="late"\nerror: short'
    df = spark.createDataFrame([(1, AT, text, "t", "c"), (1, AT, text, "t", "c")], SCHEMA).repartition(2)
    for most in (0, 1000):
        got = [(r.line_no, r.log_level, len(r.message), r.message[-5:]) for r in G.entries(df, max_rows=most, messages=True).orderBy("line_no").collect()]
        assert [g[:2] for g in got] == [(1, "INFO"), (2, "WARN"), (3, "ERROR")] and got[0][3] == " word" and got[1][2:] == (4, "late") and got[2][2:] == (5, "short")
