"""Log entries of mixed programs as fields, by iterative partitioning of their lines.

Lines become token sequences in which timestamps, levels, names, numbers and keys are masked. The distinct sequences are
partitioned in steps: by token count; by the token at the least variable position; by the tokens of the two positions between
which there is a bijection (or the one that fixes the other); and where marks or masks still vary inside a part, by these. Each
leaf's template keeps the tokens that are the same in all its members and leaves the others as variable slots. What the slots in
a template's header mean, timestamp, level or component, is decided once per template and holds for all its lines.

All steps are aggregations and joins of the distinct sequences; no part is ever gathered in one task.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessellar.common import BROADCAST_ROWS, cut, is_small, join_sized, stored

#: A task remembers so many runs to skip their copies; the rest is left to the windows.
_SEEN_RUNS = 200_000
_BATCH_LINES = 20_000
#: Between the tokens of a sequence; a token that follows white space starts with a blank.
SEP = "\x1f"

# Level names by meaning.
LEVELS = {
    "DEBUG": "trace debug dbg fine finer finest config verbose",
    "INFO": "info information informational note notice",
    "WARN": "warn warning",
    "ERROR": "err error severe",
    "FATAL": "fatal crit critical alert emerg emergency panic",
}
_LEVEL = {n: level for level, names in LEVELS.items() for n in names.split()}
_LETTER = {"D": "DEBUG", "I": "INFO", "W": "WARN", "E": "ERROR", "F": "FATAL"}
# Keys of structured entries by what they hold.
KEYS = {"time": "ts t time timestamp @timestamp datetime date", "level": "level lvl severity loglevel log_level sev", "comp": "component module logger source program comp", "msg": "msg message text"}
_KEY = {n: k for k, names in KEYS.items() for n in names.split()}
_MONTHS = {m: i + 1 for i, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split())}

_COLOUR = re.compile(r"\x1b(?:\[[0-9;]*[A-Za-z]?)?")
_MON = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_TOKEN = re.compile(
    rf"(?=[A-Z][a-z][a-z],? )(?:"
    rf"(?P<long>\b{_MON} \d\d?, \d{{4}},? \d\d?:\d\d:\d\d(?: [AP]M\b)?)"
    rf"|(?P<ctime>\b(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),? {_MON} [ \d]\d \d\d:\d\d:\d\d(?:\.\d+)? (?:[A-Z]{{3}} )?\d{{4}}\b)"
    rf"|(?P<sys>\b{_MON} [ \d]\d \d\d:\d\d:\d\d\b))"
    r"|(?P<letter>\A[DIWEF](?=\d{4} \d\d:\d\d:\d\d))"
    r"|(?P<word>@?[^\W\d][\w$]*(?:[.\-/'][\w$]+)*)"
    r"|(?=\d)(?:(?P<iso>(?<![\w.])\d{4}[-/]\d\d[-/]\d\d[T ]\d\d:\d\d:\d\d(?:[.,]\d+)?(?: ?(?:Z|UTC|GMT)\b| ?[+-]\d\d:?\d\d\b)?)"
    rf"|(?P<clf>\b\d\d/{_MON}/\d{{4}}:\d\d:\d\d:\d\d [+-]\d{{4}})"
    r"|(?P<mmdd>(?<=\A[DIWEF])\d{4} \d\d:\d\d:\d\d(?:\.\d+)?)"
    r"|(?P<clock>(?<![\w:.])\d\d:\d\d:\d\d(?:[.,]\d+)?(?![\w:]))"
    r"|(?P<epoch>(?<![\w.])1\d{9}(?:\.\d{1,9}|\d{3})?(?![\w.]))"
    r"|(?P<num>\d[\w.]*))"
    r"|(?P<mark>(?P<one>[^\w\s])(?P=one)*)"
)
_KEY_COLON = re.compile(r'"\s*:')
_THREAD_NAME = re.compile(r"main|[\w.\-]*[Tt]hread[\w.\-]*|[\w\-]*(?:exec|worker)-?\d+")
#: Masks whose values a line carries along.
VALUED = frozenset(["<time>", "<level>", "<name>"])
_TIME, _LVL, _NAME, _NUM, _THREAD = "<time>", "<level>", "<name>", "<num>", "<thread>"


def to_utc(kind: str, raw: str, started: datetime | None) -> str:
    """A timestamp cut to the second, in UTC; year or date that it lacks are those of ``started``; '' if it is no instant."""
    try:
        if kind == "epoch":
            seconds = int(raw[:10])
            return (datetime(1970, 1, 1) + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")
        digits = [int(x) for x in re.findall(r"\d+", raw)]
        if kind == "iso":
            t = datetime(*digits[:6])
            if m := re.search(r"([+-])(\d\d):?(\d\d)$", raw[19:]):
                off = timedelta(hours=int(m[2]), minutes=int(m[3]))
                t = t - off if m[1] == "+" else t + off
        elif kind == "long":
            h = digits[2]
            if raw[-2:] in ("AM", "PM"):
                h = h % 12 + 12 * (raw[-2:] == "PM")
            t = datetime(digits[1], _MONTHS[raw[:3]], digits[0], h, digits[3], digits[4])
        elif kind == "ctime":
            m = re.search(rf"({_MON}) +(\d+) (\d\d):(\d\d):(\d\d)", raw)
            t = datetime(int(raw[-4:]), _MONTHS[m[1]], *(int(m[k]) for k in range(2, 6)))
        elif kind == "clf":
            z = int(raw[-4:-2]) * 60 + int(raw[-2:])
            t = datetime(digits[1], _MONTHS[raw[3:6]], digits[0], *digits[2:5]) - timedelta(minutes=z if raw[-5] == "+" else -z)
        elif started is None:
            return ""
        elif kind == "sys":
            t = datetime(started.year, _MONTHS[raw[:3]], *digits[:4])
        elif kind == "mmdd":
            t = datetime(started.year, int(raw[:2]), int(raw[2:4]), *digits[1:4])
        else:
            t = datetime(started.year, started.month, started.day, *digits[:3])
        return t.strftime("%Y-%m-%d %H:%M:%S")
    except (ValueError, OverflowError):
        return ""


@lru_cache(maxsize=200_000)
def _word(w: str) -> tuple[str, str | None]:
    """Mask of a word and the value it carries."""
    low = w.lower()
    if low in _LEVEL and (w.islower() or w.isupper() or w.istitle()):
        return _LVL, _LEVEL[low]
    if any(c in "./_$" or c.isdigit() for c in w):
        return _NAME, w
    return w, None


def tokens(line: str, started: datetime | None) -> tuple[list[str], list[str], list[int]]:
    """Masked tokens of a line, the values of those in VALUED, and where each token ends."""
    out: list[str] = []
    values: list[str] = []
    ends: list[int] = []
    last, size = 0, len(line)
    for m in _TOKEN.finditer(line):
        kind, (at, end) = m.lastgroup, m.span()
        value = None
        if kind == "word":
            raw = m.group()
            mask, value = _word(raw)
            nxt = line[end] if end < size else ""
            if nxt == "=" or nxt == '"' and at and line[at - 1] == '"' and _KEY_COLON.match(line, end):
                if (known := _KEY.get(raw.lower())) and (nxt == '"' or not at or line[at - 1].isspace()):
                    mask, value = f"<key:{known}>", None
            elif at and value is None and line[at - 1] in '"/' and raw[0].isupper():
                mask, value = _NAME, raw
            if nxt == "]" and at and line[at - 1] == "[" and _THREAD_NAME.fullmatch(raw):
                mask, value = _THREAD, None
        elif kind == "mark":
            mask = m.group()
            if mask == "*":
                mask = "<*>"
        elif kind == "num":
            mask = _NUM
        elif kind == "letter":
            mask, value = _LVL, _LETTER[line[at]]
        else:
            mask, value = _TIME, to_utc(kind, m.group(), started)
        out.append(mask if at == last else " " + mask)
        last = end
        ends.append(end)
        if value is not None:
            values.append(value)
    return out, values, ends


def told(lines: list[str]) -> str | None:
    """The message value of a JSON entry, '' if it has none; null if the lines are no JSON object, as when they are cut off."""
    try:
        found = json.loads("\n".join(lines))
        return next((str(v) for k, v in found.items() if _KEY.get(k.lower()) == "msg"), "")
    except (ValueError, AttributeError):
        return None


def _packed(ends: list[int]) -> bytes:
    """Numbers of two bytes each, or of four if need be; the first byte says which."""
    wide = bool(ends) and ends[-1] > 0xFFFF
    return struct.pack(f">B{len(ends)}{'I' if wide else 'H'}", 4 if wide else 2, *ends)


def line_rows(text: str, started: datetime | None, texts: bool = False) -> Iterator[list]:
    """(line_no, upto, sequence, values) of each line that might begin an entry; ``upto`` is the last non-blank line before the next such line.

    ``texts`` adds where each token ends (packed), the line (a header's block of lines as one), the non-blank lines that follow it, and
    what a JSON entry has for message.

    A line that begins with white space, ``|`` or ``>`` never does. A line that is ``{`` alone takes the indented lines up to its
    ``}`` with it, as one header.
    """
    lines = [_COLOUR.sub("", x) if "\x1b" in x else x for x in text.split("\n")]
    lines = [x[:-1] if x.endswith("\r") else x for x in lines]
    i, n, held = 0, len(lines), None
    while i < n:
        x = lines[i]
        if not x.strip():
            i += 1
            continue
        if x[0].isspace() or x[0] in "|>":
            if held:
                held[1] = i + 1
                if texts:
                    held[6] = f"{held[6]}\n{x}" if held[6] else x
            i += 1
            continue
        if held:
            yield held
        j = i
        if x.rstrip() == "{":
            while j + 1 < n and lines[j + 1][:1].isspace() and lines[j + 1].strip():
                j += 1
            if j + 1 < n and lines[j + 1].rstrip() in ("}", "},"):
                j += 1
            x = " ".join(y.strip() for y in lines[i : j + 1])
        toks, values, ends = tokens(x, started)
        held = [i + 1, j + 1, SEP.join(toks), values]
        if texts:
            held += [_packed(ends), x, "", told(lines[i : j + 1]) if x[0] == "{" else None]
        i = j + 1
    if held:
        yield held


_LINES = {"run_id": pa.int64(), "version": pa.int64(), "line_no": pa.int32(), "upto": pa.int32(), "seq": pa.string(), "vals": pa.list_(pa.string())}
_TEXTS = {"ends": pa.binary(), "line": pa.string(), "more": pa.string(), "told": pa.string()}
_DDL = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.string()): "array<string>"}


def candidate_lines(runs: DataFrame, texts: bool = False) -> DataFrame:
    """Each run's lines that might begin an entry. ``runs`` has run_id, started_at and stderr, and is never shuffled here.

    ``version`` tells differing rows of a repeated run_id apart; ``texts`` adds what messages are made of, cut where the text lies.
    """
    one = runs.where("run_id IS NOT NULL AND stderr IS NOT NULL AND stderr <> ''").select("run_id", F.xxhash64("started_at", "stderr").alias("version"), "started_at", "stderr")
    columns = _LINES | (_TEXTS if texts else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()  # copies of a run within a task, however many, are read once
        for b in batches:
            rows = []
            for run_id, version, at, text in zip(*(b.column(c).to_pylist() for c in ("run_id", "version", "started_at", "stderr"))):
                if (run_id, version) in seen:
                    continue
                if len(seen) >= _SEEN_RUNS:
                    seen.clear()
                seen.add((run_id, version))
                if at is not None and at.tzinfo is not None:
                    at = at.astimezone(timezone.utc).replace(tzinfo=None)
                for r in line_rows(text, at, texts):
                    rows.append((run_id, version, *r))
                if len(rows) >= _BATCH_LINES:
                    yield _batch(rows, columns)
                    rows = []
            if rows:
                yield _batch(rows, columns)

    return one.mapInArrow(run, ", ".join(f"{n} {_DDL[t]}" for n, t in columns.items()))


def _batch(rows: list[tuple], columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), columns.values())], list(columns))


# ---- iterative partitioning of the distinct sequences


def _cardinalities(parts: DataFrame) -> DataFrame:
    """(part, pos, card): number of different tokens at each position of each part."""
    at = parts.select("part", F.posexplode(F.transform("toks", lambda t: F.xxhash64(t))).alias("pos", "tok")).distinct()
    return at.groupBy("part", "pos").agg(F.count(F.lit(1)).alias("card"))


def _split(parts: DataFrame, choice: DataFrame, key: Column) -> DataFrame:
    """Sub-parts by ``key``, where ``choice`` names a position for the part."""
    joined = join_sized(parts, choice, ["part"], "left", salt_by=["id"], keep=True)
    return joined.withColumn("part", F.xxhash64("part", F.coalesce(key, F.lit("")))).select("id", "id2", "toks", "part")


def split_by_least_variable(parts: DataFrame) -> DataFrame:
    """Parts split by the token at their position with the fewest different tokens, if more than one; the first of equals."""
    varying = _cardinalities(parts).where("card > 1")
    choice = varying.groupBy("part").agg(F.min(F.struct("card", "pos")).alias("c")).select("part", F.col("c.pos").alias("pos"))
    return _split(parts, choice, F.expr("toks[pos]"))


def split_by_bijection(parts: DataFrame) -> DataFrame:
    """Parts split by the relation between two positions with the commonest number of different tokens.

    Tokens in a bijection split by it; where one side fixes the other (1-M or M-1), the side that fixes is kept together; tokens
    in an M-M relation stay in one part.
    """
    varying = _cardinalities(parts).where("card > 1")
    sizes = varying.groupBy("part", "card").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("pos")).alias("ps"))
    choice = sizes.where("n > 1").groupBy("part").agg(F.max(F.struct("n", F.negate("card").alias("c"), "ps")).alias("x")).select("part", F.col("x.ps")[0].alias("p1"), F.col("x.ps")[1].alias("p2"))
    placed = join_sized(parts, choice, ["part"], "left", salt_by=["id"], keep=True).select("id", "id2", "toks", "part", F.expr("toks[p1]").alias("t1"), F.expr("toks[p2]").alias("t2"))
    pairs = placed.where("t1 IS NOT NULL").select("part", "t1", "t2").distinct()
    right = pairs.groupBy("part", "t1").agg(F.count(F.lit(1)).alias("d1"))
    left = pairs.groupBy("part", "t2").agg(F.count(F.lit(1)).alias("d2"))
    key = F.when(F.col("d2") == 1, F.concat(F.lit("1"), F.col("t1"))).when(F.col("d1") == 1, F.concat(F.lit("2"), F.col("t2")))
    pairs = pairs.join(right, ["part", "t1"]).join(left, ["part", "t2"]).select("part", "t1", "t2", key.alias("k"))
    joined = join_sized(placed, pairs, ["part", "t1", "t2"], "left", salt_by=["id"], keep=True)
    return joined.withColumn("part", F.xxhash64("part", F.coalesce("k", F.lit("")))).select("id", "id2", "toks", "part")


def split_by_marks(parts: DataFrame) -> DataFrame:
    """Parts split until marks and masks are the same at each position of a leaf; plain words may vary."""
    shape = F.concat_ws(SEP, F.transform("toks", lambda t: F.when(t.rlike(r"^ ?[^\W\d_]"), F.when(t.startswith(" "), " w").otherwise("w")).otherwise(t)))
    return parts.withColumn("part", F.xxhash64("part", shape))


def leaf_templates(parts: DataFrame) -> DataFrame:
    """(part, template): the common token of each position, ``*`` (after a blank, `` *``) where tokens vary.

    Tokens are compared by hash; the template is any member with its varying positions blotted out.
    """
    at = parts.select("part", F.posexplode(F.transform("toks", lambda t: F.xxhash64(t))).alias("pos", "tok"))
    varying = at.groupBy("part", "pos").agg(F.min("tok").alias("a"), F.max("tok").alias("b")).where("a <> b")
    varying = varying.groupBy("part").agg(F.collect_list("pos").alias("varying"))
    member = parts.groupBy("part").agg(F.any_value("toks").alias("toks"))
    slot = lambda t, i: F.when(F.array_contains("varying", i), F.when(t.startswith(" "), " *").otherwise("*")).otherwise(t)
    joined = member.join(varying, "part", "left")
    return joined.select("part", F.when(F.col("varying").isNull(), F.col("toks")).otherwise(F.transform("toks", slot)).alias("template"))


def sequence_ids(seq: Column) -> list[Column]:
    """128 bits that stand for a sequence."""
    return [F.xxhash64(seq).alias("id"), F.xxhash64(F.lit("second"), seq).alias("id2")]


def partition(sequences: DataFrame) -> DataFrame:
    """(id, id2, toks, part) of distinct ``sequences`` (column seq): the leaf of each, written to the shared folder between steps."""
    parts = sequences.select(*sequence_ids(F.col("seq")), F.split("seq", SEP).alias("toks")).withColumn("part", F.xxhash64(F.size("toks")))
    parts = stored(split_by_least_variable(stored(parts, "parts")), "parts")
    return stored(split_by_marks(split_by_bijection(parts)), "parts")


# ---- what the slots of a template mean


class _Header:
    """Reads the header of one template from the left."""

    def __init__(self, template: list[str]) -> None:
        self.spaced = [t.startswith(" ") and len(t) > 1 for t in template]
        self.t = [t[1:] if s else t for t, s in zip(template, self.spaced)]
        self.time = self.level = self.comp = None
        self.end, self.open = 0, False

    def at(self, i: int) -> str:
        return self.t[i] if 0 <= i < len(self.t) else ""

    def name(self, i: int) -> bool:
        """A word or name, or a slot for one."""
        x = self.at(i)
        return x in (_NAME, "*") or x[:1].isalpha()

    def read(self) -> bool:
        if self.at(0) == "{" or self.at(0).startswith("<key:") or (self.name(0) and self.at(1) == "=" and any(x.startswith("<key:") for x in self.t)):
            self._keyed()
        else:
            self._placed()
        return self.time is not None or self.level is not None

    def _keyed(self) -> None:
        """``key=value`` and JSON entries: the values of known keys at the entry's own level, whatever their order."""
        i, n, json_like = 0, len(self.t), self.t[0] == "{"
        while i < n:
            key = self.t[i]
            sep = i + 1
            if json_like and self.at(sep) == '"':
                sep += 1
            if not (key.startswith("<key:") or self.name(i)) or self.at(sep) not in ((":",) if json_like else ("=",)):
                i += 1
                continue
            v = sep + 1
            quoted = self.at(v) == '"'
            v += quoted
            mask = self.at(v)
            if key == "<key:time>" and mask == _TIME and self.time is None:
                self.time = v
            elif key == "<key:level>" and mask == _LVL and self.level is None:
                self.level = v
            elif key == "<key:comp>" and self.name(v) and self.comp is None:
                self.comp = v
            elif key == "<key:msg>" and not self.end:
                self.end = v
            i = v
            if quoted:
                while i < n and not (self.t[i] == '"' and self.at(i - 1) != "\\"):
                    i += 1
            i += 1
        self.end = self.end or n

    def _group(self, i: int, close: str) -> int:
        """Index after the bracket that closes the group at ``i``; ``i`` if it isn't closed."""
        j = i + 1
        while j < len(self.t) and self.t[j] != close:
            j += 1
        return j + 1 if j < len(self.t) else i

    def _placed(self) -> None:
        """Headers by place: decoration, timestamp, level, thread, component, in the orders that programs use."""
        i = 0
        while self.at(i) == "<*>" or self.at(i) not in ("", "*") and set(self.at(i)) <= set("*#=-"):
            i += 1
        start = i
        while i < len(self.t):
            x, after = self.at(i), self.at(i + 1)
            headed = self.time is not None or self.level is not None
            if x == _TIME and self.time is None and (i == start or headed or self.at(i - 1) in "[(<"):
                self.time = i
            elif x == _LVL and self.level is None and self._level_fits(i):
                self.level = i
            elif x == "[":
                j = self._group(i, "]")
                if j == i:
                    break
                if j != i + 3 and after == _TIME and self.time is None:
                    i += 1
                    continue
                if j == i + 3 and self.at(i + 1) in (_TIME, _LVL) and not (self.at(i + 1) == _TIME and self.time is not None):
                    if self.at(i + 1) == _TIME:
                        self.time = i + 1
                    elif self.level is None:
                        self.level = i + 1
                elif j == i + 3 and self.name(i + 1) and self.comp is None and (headed or self.at(j) == _LVL):
                    self.comp = i + 1
                elif not headed:
                    break
                i = j
                continue
            elif x == "<" and after == _LVL and self.at(i + 2) == ">" and self.time is not None:
                self.level = i + 1
                i += 3
                continue
            elif x == "(" and self.level == i - 1:
                j = self._group(i, ")")
                if j == i:
                    break
                i = j
                continue
            elif x == _THREAD and headed or x == _NUM and headed and self.comp is None and (self._letter() or after == "---"):
                pass
            elif x == "{" and headed and self.comp is None and self.name(i + 1) and (j := self._group(i, "}")) > i:  # {file:line}
                self.comp = i + 1
                i = j
                continue
            elif headed and x in ("|", ",", "-", "--", "---", ">", "]") and not (x[0] == "-" and not self.spaced[i]):
                if self.comp is not None and self.level is not None:
                    self.end = i + 1
                    return
            elif headed and x == ":" and (self.level == i - 1 or self.at(i - 1) in (")", "]")):
                if not (self.comp is None and self.name(i + 1) and not self._gap(i + 1) and self.at(i + 2) == ":"):
                    self.end = i + 1
                    return
            elif self.name(i) and self.comp is None and (j := self._component(i)):
                self.comp = i if j > 0 else i + 1
                i += abs(j)
                if self.level is None and self.at(i) == _LVL and self._level_fits(i):
                    continue
                if self.at(i - 1) in (":", "]") or self.level is not None:
                    if not (self.at(i) in ("-", "|") and self.level is None):
                        self.end = i
                        return
                continue
            else:
                break
            i += 1
        self.end = i

    def _gap(self, i: int) -> bool:
        return i < len(self.spaced) and self.spaced[i]

    def _letter(self) -> bool:
        """A level of one letter before the timestamp, without a blank between."""
        return self.level == 0 and self.time == 1 and not self.spaced[1]

    def _level_fits(self, i: int) -> bool:
        """A level counts after a timestamp or component, or where a mark or a bracket follows."""
        after = self.at(i + 1)
        if self.time is not None or self.comp is not None and self.comp < i:
            return True
        if i == 0 and after == _TIME:
            return True
        return after in (":", "|", "]", ">") or after in ("[", "(", "-") and self._gap(i + 1)

    def _component(self, i: int) -> int:
        """Number of tokens to go on if the token at ``i`` names the component, negative if the one after it does; else 0."""
        after, third = self.at(i + 1), self.at(i + 2)
        if self.time is None and self.level is None:
            return 2 if i == 0 and after == ":" and third == _LVL and self.at(i + 3) == ":" else 0
        if self._letter():  # file:line]
            return 4 if after == ":" and third == _NUM and self.at(i + 3) == "]" else 0
        if self.time is not None and self.level is None:
            if self.name(i + 1) and self._gap(i + 1) and (third == ":" or third == "[" and self.at(i + 4) == "]"):
                return -(3 if third == ":" else 6 if self.at(i + 5) == ":" else 5)  # machine program[process]:
            if self.name(i + 1) and i + 2 == len(self.t) and self.at(i) in (_NAME, "*"):
                self.open = True  # class and method, level and message on the next line
                return 2
            if i + 1 == len(self.t) and self.at(i) == _NAME:
                self.open = True
                return 1
            if after in ("-", "|") and third == _LVL:
                return 1
            return 0
        if after in ("|", ":") and (self.time is not None or not self._gap(i)):
            return 2
        if after == "-" and self._gap(i + 1):
            return 2
        return 1 if self.at(i) == _NAME and self.time is not None else 0


def slots(template: list[str]) -> tuple[int, int, int, int, bool, bool] | None:
    """(timestamp, level, component, first message token, goes on in the next line, level alone), positions from 0, -1 for none; None for no header."""
    if not template:
        return None
    h = _Header(template)
    if not h.read():
        return None
    pos = lambda p: -1 if p is None else p
    alone = h.time is None and h.comp is None and h.level == 0
    return pos(h.time), pos(h.level), pos(h.comp), h.end, h.open and h.level is None, alone


_SLOTS = T.StructType(
    [T.StructField("is_header", T.BooleanType()), *(T.StructField(n, T.IntegerType()) for n in ("time_at", "level_at", "comp_at", "comp_pos", "message_at")), *(T.StructField(n, T.BooleanType()) for n in ("opens", "level_alone"))]
)


@F.pandas_udf(_SLOTS)
def _slots_of(templates: pd.Series) -> pd.DataFrame:
    rows = []
    for t in templates:
        t = list(t)
        s = slots(t)
        if s is None:
            rows.append((False, -1, -1, -1, -1, -1, False, False))
            continue
        order = {}
        for k, x in enumerate(t):
            if x.lstrip(" ") in VALUED:
                order[k] = len(order)
        rows.append((True, order.get(s[0], -1), order.get(s[1], -1), order.get(s[2], -1), s[2], s[3], s[4], s[5]))
    return pd.DataFrame(rows, columns=["is_header", "time_at", "level_at", "comp_at", "comp_pos", "message_at", "opens", "level_alone"])


def template_fields(parts: DataFrame) -> DataFrame:
    """(part, template, slots): every leaf template with the meaning of its slots."""
    return leaf_templates(parts).select("part", "template", _slots_of("template").alias("s"))


# ---- entries


def entries(runs: DataFrame, max_rows: int = BROADCAST_ROWS, messages: bool = False) -> DataFrame:
    """(run_id, line_no, n_lines, log_ts, log_level, component): one row per log entry; ``messages`` adds message.

    Null or empty stderr gives nothing, a run without any header no entry; lines before the first entry belong to none. A repeated
    run counts once; rows of one run_id that differ in start or text are read each, and entries that they share come out once.
    Extra columns are never read. A message is what follows the header in the entry's first line (of a JSON entry its message
    value), and the entry's further lines that are not blank; colour codes and final carriage returns are off.
    """
    lines = stored(candidate_lines(runs, messages).select("*", *sequence_ids(F.col("seq"))), "lines")
    parts = partition(lines.select("seq").distinct())
    fields = join_sized(parts, template_fields(parts).drop("template"), ["part"], "inner", salt_by=["id"], max_rows=max_rows, keep=True)
    literal = F.when((F.col("s.comp_at") < 0) & (F.col("s.comp_pos") >= 0), F.ltrim(F.get("toks", F.col("s.comp_pos"))))
    meant = cut(fields.where("s.is_header").select("id", "id2", "s.time_at", "s.level_at", "s.comp_at", literal.alias("named"), "s.message_at", "s.opens", "s.level_alone"))
    value = lambda c: F.when(F.col(c) >= 0, F.get("vals", F.col(c)))
    named = [
        "run_id",
        "version",
        "line_no",
        "upto",
        F.col("message_at").isNotNull().alias("is_header"),
        value("time_at").alias("ts"),
        value("level_at").alias("level"),
        F.coalesce(value("comp_at"), "named").alias("comp"),
        F.coalesce("opens", F.lit(False)).alias("opens"),
        F.coalesce("level_alone", F.lit(False)).alias("level_alone"),
    ]
    texts = [_message().alias("message"), "line", "more"]
    key = ["run_id", "version", "line_no"]
    if messages and is_small(meant, max_rows):
        lit = lines.drop("seq").join(F.broadcast(meant), ["id", "id2"], "left").select(*named, *texts).repartition("run_id")
    elif messages:
        # texts don't go through the join by sequence: what it finds is sorted in before the lines, and handed to them there
        got = join_sized(lines.select(*key, "id", "id2"), meant, ["id", "id2"], "left", salt_by=["run_id", "line_no"], max_rows=max_rows)
        got = got.select(*key, F.lit(0).alias("__own"), F.struct(*(c for c in meant.columns if c not in ("id", "id2"))).alias("__found"))
        both = got.unionByName(lines.drop("seq", "id", "id2").withColumn("__own", F.lit(1)), allowMissingColumns=True).repartition("run_id")
        pairs = Window.partitionBy("run_id", "version").orderBy("line_no", "__own")
        both = both.withColumns({"__prev": F.lag("__own").over(pairs), "__got": F.lag("__found").over(pairs)}).where("__own = 1 AND __prev = 0")
        lit = both.select("*", "__got.*").select(*named, *texts)
    else:
        lit = join_sized(lines.select(*_LINES, "id", "id2").drop("seq"), meant, ["id", "id2"], "left", salt_by=["run_id", "line_no"], max_rows=max_rows).select(*named)
        lit = lit.repartition("run_id")  # the one shuffle of the fields: all windows and groups below are within a run
    w = Window.partitionBy("run_id", "version").orderBy("line_no")
    lit = lit.withColumn("__again", F.lag("line_no").over(w).eqNullSafe(F.col("line_no"))).where("NOT __again")
    lit = lit.withColumn("goes_on", F.lag("opens", 1, False).over(w) & F.col("level_alone") & (F.lag("upto").over(w) + 1 == F.col("line_no")))
    text = lambda c: F.coalesce(c, F.lit(""))
    alike = lines.groupBy("run_id").agg(F.min("version").alias("a"), F.max("version").alias("b")).where("a <> b").isEmpty()
    once = lambda found: found if alike else found.distinct()
    if messages:
        return once(_with_messages(lit, w))
    lit = lit.withColumn("next_level", F.when(F.lead("goes_on").over(w), F.lead("level").over(w)))
    # an entry ends where the line before the next one's first line ends, the last one of a run with the run
    lit = lit.withColumn("before", F.lag("upto").over(w)).withColumn("last", F.max("upto").over(Window.partitionBy("run_id", "version"))).where(F.col("is_header") & ~F.col("goes_on"))
    end = F.coalesce(F.lead("before").over(w), "last")
    return once(
        lit.select(
            "run_id",
            "line_no",
            (end - F.col("line_no") + 1).cast("int").alias("n_lines"),
            text(F.col("ts")).alias("log_ts"),
            text(F.coalesce("level", "next_level")).alias("log_level"),
            text(F.col("comp")).alias("component"),
        )
    )


def _message() -> Column:
    """What a header line says: of a JSON entry its message value, else what follows the header, without the quote that a quoted value ends with."""
    wide = F.expr("substring(ends, 1, 1) = X'04'")
    start = F.when(F.col("message_at") > 0, F.conv(F.hex(F.when(wide, F.expr("substring(ends, 4 * message_at - 2, 4)")).otherwise(F.expr("substring(ends, 2 * message_at, 2)"))), 16, 10).cast("int")).otherwise(0)
    rest = F.btrim(F.substring(F.col("line"), start + 1, F.length("line")), F.lit(" \t\r\f\x0b\xa0"))
    quoted = (start > 0) & (F.substring(F.col("line"), start, 1) == '"') & ~F.col("line").startswith('"')
    return F.coalesce("told", F.when(quoted, F.regexp_replace(rest, r'"\s*\}?$', "")).otherwise(rest))


def _with_messages(lit: DataFrame, w) -> DataFrame:
    """Entries of lines with their texts: an entry's lines are numbered alike and gathered, no more than one run has."""
    first = F.col("is_header") & ~F.col("goes_on")
    lit = lit.withColumn("__no", F.sum(first.cast("int")).over(w)).where("__no > 0")
    said = F.concat_ws("\n", *(F.when(c != "", c) for c in (F.when(first | F.col("goes_on"), F.col("message")).otherwise(F.col("line")), F.col("more"))))
    fields = F.when(first, F.struct("ts", "level", "comp"))
    one = lit.groupBy("run_id", "version", "__no").agg(
        F.min("line_no").alias("line_no"), F.max("upto").alias("upto"), F.max(fields).alias("f"), F.max(F.when(F.col("goes_on"), F.col("level"))).alias("next_level"),
        F.sort_array(F.collect_list(F.struct("line_no", said.alias("said")))).alias("said"),
    )
    text = lambda c: F.coalesce(c, F.lit(""))
    return one.select(
        "run_id",
        "line_no",
        (F.col("upto") - F.col("line_no") + 1).cast("int").alias("n_lines"),
        text(F.col("f.ts")).alias("log_ts"),
        text(F.coalesce("f.level", "next_level")).alias("log_level"),
        text(F.col("f.comp")).alias("component"),
        F.concat_ws("\n", F.filter("said.said", lambda x: x != "")).alias("message"),
    )
