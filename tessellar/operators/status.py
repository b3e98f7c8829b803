"""Tool runs: their status, exit codes, the wide view of all tools per file, and the roll-up over tools."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tool:
    """A tool's table name, its prefix in wide rows, and how its output shows an encrypted file (an SQL LIKE pattern, or a regex)."""

    table: str
    prefix: str
    like: str | None = None
    stream: str = "stderr"
    regex: str | None = None


# Tools, prefixes and signs of encryption.
TOOLS = (
    Tool("mutoolclean", "mc", "error: cannot authenticate password%"),
    Tool("mutooltext", "mt", "error: cannot authenticate password%"),
    Tool("pdfchecker", "pc", "error: cannot authenticate password%"),
    Tool("pdfcpu", "cpu", "pdfcpu: please provide the correct password%"),
    Tool("pdfid", "pid", stream="stdout", regex=r"/Encrypt [1-9]"),
    Tool("pdfimages", "pim", "Command Line Error: Incorrect password%"),
    Tool("pdfinfo", "pinfo", "Command Line Error: Incorrect password%"),
    Tool("pdfminerdump", "pmd", "%raise PDFPasswordIncorrect%"),
    Tool("pdfminertext", "pmt", "%raise PDFPasswordIncorrect%"),
    Tool("pdftoppm", "ppm", "Command Line Error: Incorrect password%"),
    Tool("pdftops", "ps", "Command Line Error: Incorrect password%"),
    Tool("pdftotext", "ptt", "Incorrect password%"),
    Tool("tika", "tk", "org.apache.tika.exception.EncryptedDocumentException%"),
    Tool("qpdf", "q"),
    Tool("clamav", "c"),
    Tool("caradoc", "cd"),
    Tool("pdfresurrect", "pr"),
    Tool("pdfbytes", "pb"),
    Tool("xpdffonts", "xpf"),
    Tool("pdffonts", "pf"),
    Tool("arlington", "a"),
    Tool("gstotext", "gs"),
    Tool("polyfile", "pol"),
)

# Pseudo exit codes of pipeline outcomes; anything else is 14.
PIPE_CODES = {
    "PARSE_SUCCESS": 0, "EMIT_SUCCESS": 0, "EMIT_SUCCESS_PARSE_EXCEPTION": 1, "PARSE_SUCCESS_WITH_EXCEPTION": 1, "PARSE_EXCEPTION_NO_EMIT": 1, "OOM": 2, "TIMEOUT": 3, "EMPTY_OUTPUT": 4,
    "EMIT_EXCEPTION": 5, "FETCH_EXCEPTION": 6, "NO_EMITTER_FOUND": 7, "NO_FETCHER_FOUND": 8, "UNSPECIFIED_CRASH": 9, "PARSE_EXCEPTION_EMIT": 10, "INTERRUPTED_EXCEPTION": 11,
    "CLIENT_UNAVAILABLE_WITHIN_MS": 12, "FETCHER_INITIALIZATION_EXCEPTION": 13,
}


def run_status(tool: Tool, path: Column, timeout: Column, exit_value: Column, stderr: Column, stdout: Column) -> Column:
    """encrypted, missing, timeout, crash, warn or success: the first that holds; 'missing' where the tool has no row for the file.

    A null exit value or stderr decides nothing, as in SQL. The second text tool's sign of encryption is looked for in its own
    stderr, not in its sibling's.
    """
    out = F.when(path.isNull(), "missing").when(timeout, "timeout").when(exit_value != 0, "crash").when(F.length(stderr) > 5, "warn").otherwise("success")
    text = stdout if tool.stream == "stdout" else stderr
    sign = text.rlike(tool.regex) if tool.regex else text.like(tool.like) if tool.like else None
    return out if sign is None else F.when(sign, "encrypted").otherwise(out)


def pipe_code(status: Column) -> Column:
    """Pseudo exit code of a pipeline outcome; every outcome has its own, none falls through to another."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for k, v in PIPE_CODES.items() for x in (k, v))), status), F.lit(14))


#: Statuses by the number that is folded; 'missing' has none.
STATUSES = ("timeout", "crash", "warn", "success", "encrypted")


def latest_runs(runs: DataFrame, tools: Sequence[Tool] = (), keep: Sequence[str] = ()) -> DataFrame:
    """(tool, path, status, keep...): of each tool and path the run that started last, then the one of the highest run_id.

    What decides a status is read off stderr and stdout where they lie: only whether they show an encrypted file or a warning, and a
    hash that breaks ties, is shuffled, and texts only if ``keep`` names them. Null paths are left out.
    """
    number = {s: k for k, s in enumerate(STATUSES)}
    code = F.when(F.col("timeout"), number["timeout"]).when(F.col("exit_value") != 0, number["crash"]).when(F.length("stderr") > 5, number["warn"]).otherwise(number["success"])
    for t in tools:
        sign = F.col(t.stream).rlike(t.regex) if t.regex else F.col(t.stream).like(t.like) if t.like else None
        if sign is not None:
            code = F.when((F.col("tool") == t.table) & sign, number["encrypted"]).otherwise(code)
    order = [F.col("started_at"), F.col("run_id"), F.xxhash64("exit_value", "timeout", "stderr", "stdout").alias("tie"), code.alias("status")]
    last = runs.where("path IS NOT NULL").groupBy("tool", "path").agg(F.max(F.struct(*order, *(F.col(c).alias(f"k_{c}") for c in keep))).alias("r"))
    return last.select("tool", "path", "r.status", *(F.col(f"r.k_{c}").alias(c) for c in keep))


def named_status(code: Column) -> Column:
    """A status by its number, 'missing' for null."""
    return F.coalesce(F.get(F.array(*(F.lit(s) for s in STATUSES)), code), F.lit("missing"))


def wide(anchor: DataFrame, runs: DataFrame, tools: Sequence[Tool], keep: Sequence[str] = ("exit_value", "timeout", "stderr")) -> DataFrame:
    """Every file of ``anchor`` (column path) with each tool's columns and status, as ``<prefix>_<column>`` and ``<prefix>_status``.

    Instead of one left join per tool, the long table is folded into one row per path by conditional aggregation and joined once.
    ``other_tools`` names, in order, those that ran on the file and aren't in ``tools``, '' for none.
    """
    one = latest_runs(runs, tools, keep)
    of = lambda t, c: F.max(F.when(F.col("tool") == t.table, F.col(c)))
    other = F.collect_set(F.when(~F.col("tool").isin(*(t.table for t in tools)), F.col("tool")))
    folded = one.groupBy("path").agg(*(of(t, c).alias(f"{t.prefix}_{c}") for t in tools for c in (*keep, "status")), F.concat_ws(" ", F.array_sort(other)).alias("other_tools"))
    joined = anchor.join(folded, "path", "left")
    status = [named_status(F.col(f"{t.prefix}_status")).alias(f"{t.prefix}_status") for t in tools]
    return joined.select(*anchor.columns, *(f"{t.prefix}_{c}" for t in tools for c in keep), *status, F.coalesce("other_tools", F.lit("")).alias("other_tools"))


_STATUS = re.compile(r"^([a-zA-Z]+)_status$")


def roll_up(rows: DataFrame) -> DataFrame:
    """``rows`` with tools_status_timeout, tools_status_fail, tools_status_warn and tools_status, from all columns ``<tool>_status``.

    Names are sorted and joined by blanks; a failed tool crashed or timed out; a null status reads ``<tool>_null``.
    """
    tools = {c: m.group(1) for c in rows.columns if (m := _STATUS.match(c))}

    def named(*status: str) -> Column:
        return F.concat_ws(" ", F.array_sort(F.array_compact(F.array(*(F.when(F.col(c).isin(*status), t) for c, t in tools.items())))))

    overall = F.concat_ws(" ", F.array_sort(F.array(*(F.concat(F.lit(f"{t}_"), F.coalesce(F.col(c), F.lit("null"))) for c, t in tools.items()))))
    return rows.withColumns({"tools_status_timeout": named("timeout"), "tools_status_fail": named("crash", "timeout"), "tools_status_warn": named("warn"), "tools_status": overall})


def rename(rows: DataFrame, names: Mapping[str, str], rest: bool = True) -> DataFrame:
    """Columns by new names; ``rest`` keeps the others."""
    return rows.select(*(F.col(f"`{c}`").alias(names.get(c, c)) for c in rows.columns if rest or c in names))


def fill_absent(rows: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Column -> source column that fills it where it is null or absent; blank and 'NaN' never fill."""
    new = {}
    for to, src in values.items():
        v = F.when((F.trim(F.col(src).cast("string")) != "") & (F.col(src).cast("string") != "NaN"), F.col(src))
        new[to] = F.coalesce(F.col(to), v) if to in rows.columns else v
    return rows.withColumns(new)
