"""External programs over files: a command per file with a time limit and bounded output, in parallel over partitions."""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import io
import os
import random
import shlex
import signal
import subprocess
import tempfile
import threading
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.files import put

TIMED_OUT, INTERRUPTED = -1, -1000
RUN_SCHEMA = "tool string, path string, exit_value int, timeout boolean, process_time_ms bigint, stdout string, stdout_length bigint, stdout_truncated boolean, stderr string, stderr_length bigint, stderr_truncated boolean"
_COLUMNS = [x.split()[0] for x in RUN_SCHEMA.split(", ")]
#: Seconds for which a stream may stay open after its program has ended.
GRACE = 5


@dataclass(frozen=True)
class Command:
    """A tool: its table, its argument template ({input}, {output}, {page}), the kind of its result, its limits, and whether its result is what it prints."""

    table: str
    template: str
    result: str = "row"  # row, or the suffix of a file that it writes
    stdout_most: int = 20_000
    stderr_most: int = 20_000
    seconds: float = 60
    prints: bool = False

    def arguments(self, source: str, target: str, page: int = 1) -> list[str]:
        return [x.format(input=source, output=target, page=page) for x in shlex.split(self.template)]


# The analysers, their commands in essence, and their limits.
COMMANDS = (
    Command("arlington", "TestGrammar --brief --tsvdir /tsv --pdf {input} --out {output}", "txt", seconds=600),
    Command("caradoc", "caradoc stats --strict {input}"),
    Command("clamav", "clamdscan --no-summary {input}", stdout_most=100),
    Command("gstotext", "gs -sDEVICE=txtwrite -o {output} {input}", "txt"),
    Command("mutoolclean", "mutool clean -s {input} {output}", stdout_most=100),
    Command("mutooltext", "mutool convert -F text -o {output} {input}", "txt", 100, seconds=120),
    Command("pdfchecker", "pdfchecker --profile everything.json --input {input} --output {output}", "json"),
    Command("pdfcpu", "pdfcpu validate -mode relaxed {input}", stdout_most=10_000, stderr_most=10_000),
    Command("pdffonts", "pdffonts {input}"),
    Command("xpdffonts", "pdffonts {input}"),
    Command("pdfid", "pdfid.py {input}", stdout_most=100_000),
    Command("pdfimages", "pdfimages -list {input}"),
    Command("pdfinfo", "pdfinfo {input}"),
    Command("pdfminerdump", "dumppdf.py -a -o {output} {input}", "xml", 100),
    Command("pdfminertext", "pdf2txt.py -o {output} {input}", "txt", 100),
    Command("pdfresurrect", "pdfresurrect -q {input}"),
    Command("pdftoppm", "pdftoppm -png {input} {output}"),
    Command("pdftops", "pdftops {input} {output}"),
    Command("pdftotext", "pdftotext {input} {output}", "txt"),
    Command("polyfile", "polyfile {input}", "json", 10, 1_000, 120, True),
    Command("polyfile_polyglot", "polyfile -I {input}", stdout_most=10_000, seconds=300),
    Command("qpdf", "qpdf --json {input}", "json", 1, 10_000, 30, True),
    Command("tika", "java -jar tika-app.jar --jsonRecursive {input}", "json", 10_000, 10_000, 120, True),
    Command("pypdf2", "PyPDF2Cli.py {input}", "json", 10_000, 10_000, 120, True),
    Command("icc", "exiftool -icc_profile -b {input}", "icc", 100, prints=True),
    Command("page_splitter_count", "qpdf --show-npages {input}", seconds=30),
    Command("page_splitter", "qpdf {input} --pages . {page} -- {output}", "pdf", seconds=30),
)


def command(name: str) -> Command:
    return next(c for c in COMMANDS if c.table == name)


class _Eater(threading.Thread):
    """Reads a stream to its end in pieces, however long its lines are; keeps at most so many characters, counts all but line ends."""

    def __init__(self, stream, most: int) -> None:
        super().__init__(daemon=True)
        self.stream, self.most, self.kept, self.size, self.length = stream, most, [], 0, 0
        self.start()

    def run(self) -> None:
        plain = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder("utf-8")("replace"), translate=True)
        while True:
            raw = os.read(self.stream.fileno(), 1 << 16)
            text = plain.decode(raw, final=not raw)
            if self.size < self.most:
                self.kept.append(text[: self.most - self.size])
            self.size += len(text)
            self.length += len(text) - text.count("\n")
            if not raw:
                return

    def text(self) -> tuple[str, int, bool]:
        """Kept text, full length without line ends, and whether anything was cut: by the limit, or since the stream didn't end."""
        return "".join(self.kept), self.length, self.size > self.most or self.is_alive()


def run_one(arguments: Sequence[str], seconds: float, stdout_most: int, stderr_most: int, to: str | None = None) -> tuple:
    """(exit_value, timeout, ms, stdout, length, truncated, stderr, length, truncated); exit -1 after the time limit, -1000 if it can't start.

    A program that runs too long is ended with all that it has started. ``to``: a file that takes the standard output instead.
    """
    began = time.monotonic()
    ms = lambda: int((time.monotonic() - began) * 1000)
    sink = open(to, "wb") if to else subprocess.PIPE
    try:
        p = subprocess.Popen(arguments, stdin=subprocess.DEVNULL, stdout=sink, stderr=subprocess.PIPE, start_new_session=True)
    except OSError as e:
        return INTERRUPTED, False, ms(), "", 0, False, str(e)[:stderr_most], len(str(e)), len(str(e)) > stderr_most
    finally:
        if to:
            sink.close()
    out, err = None if to else _Eater(p.stdout, stdout_most), _Eater(p.stderr, stderr_most)
    try:
        code, late = p.wait(seconds), False
    except subprocess.TimeoutExpired:
        try:
            os.killpg(p.pid, signal.SIGKILL)
        except ProcessLookupError:
            pass
        p.wait()
        code, late = TIMED_OUT, True
    for e in (out, err):
        if e:
            e.join(GRACE)
    return code, late, ms(), *(out.text() if out else ("", 0, False)), *err.text()


class _Place:
    """Names of one program's input and output, gone with it."""

    def __init__(self, folder: str) -> None:
        self.source, self.target = os.path.join(folder, "in"), os.path.join(folder, "out")

    def run(self, c: Command, content: bytes | None, page: int = 1) -> tuple[tuple, bytes | None]:
        """Result of the run and what it wrote, null for nothing."""
        with open(self.source, "wb") as f:
            f.write(b"" if content is None else bytes(content))
        got = run_one(c.arguments(self.source, self.target, page), c.seconds, c.stdout_most, c.stderr_most, self.target if c.prints else None)
        made = None
        if os.path.exists(self.target):
            with open(self.target, "rb") as f:
                made = f.read()
            os.remove(self.target)
        return got, made


def run_command(files: DataFrame, command: Command, outputs: str | None = None) -> DataFrame:
    """A row of results per file (columns path, content). Each file is written to a temporary name for the time of its run only.

    ``outputs``: a shared folder for what the command writes to {output} or prints as its result, as ``<tool>/<path>.<suffix>``; a
    repeated task replaces its files whole. Null contents count as empty files.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as tmp:
            place = _Place(tmp)
            for b in batches:
                rows = []
                for path, content in zip(b["path"], b["content"]):
                    got, made = place.run(command, content)
                    rows.append((command.table, path, *got))
                    if made is not None and outputs:
                        put(f"{outputs}/{command.table}/{path}.{command.result}", made)
                yield pd.DataFrame(rows, columns=_COLUMNS)

    return files.select("path", "content").mapInPandas(run, RUN_SCHEMA)


def extract(files: DataFrame, command: Command) -> DataFrame:
    """(path, exit_value, timeout, digest, packed): what a command takes out of each file, its SHA-256, and itself gzipped and in base64; null for nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as tmp:
            place = _Place(tmp)
            for b in batches:
                rows = []
                for path, content in zip(b["path"], b["content"]):
                    got, made = place.run(command, content)
                    rows.append((path, got[0], got[1], hashlib.sha256(made).hexdigest() if made else None, base64.b64encode(gzip.compress(made, mtime=0)).decode() if made else None))
                yield pd.DataFrame(rows, columns=["path", "exit_value", "timeout", "digest", "packed"])

    return files.select("path", "content").mapInPandas(run, "path string, exit_value int, timeout boolean, digest string, packed string")


def split_pages(files: DataFrame, outputs: str, count: Command, split: Command, pick: int | None = None) -> DataFrame:
    """(path, n_pages, page, exit_value, timeout): each page of each file as a file ``<tool>/<path>-<page>.<suffix>``, pages counted from 1.

    ``pick``: one page of each file instead, at random but the same for the same seed and path. A file whose pages can't be counted
    gives one row without page.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as tmp:
            place = _Place(tmp)
            for b in batches:
                rows = []
                for path, content in zip(b["path"], b["content"]):
                    got, _ = place.run(count, content)
                    n = int(got[3]) if got[3].strip().isdigit() else 0
                    if not n:
                        rows.append((path, None, None, got[0], got[1]))
                    pages = range(1, n + 1) if pick is None or not n else [random.Random(f"{pick}:{path}").randint(1, n)]
                    for page in pages:
                        got, made = place.run(split, content, page)
                        rows.append((path, n, page, got[0], got[1]))
                        if made is not None:
                            put(f"{outputs}/{split.table}/{path}-{page}.{split.result}", made)
                out = pd.DataFrame(rows, columns=["path", "n_pages", "page", "exit_value", "timeout"])
                yield out.astype({"n_pages": "Int32", "page": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, n_pages int, page int, exit_value int, timeout boolean")


def mutate(content: bytes, rng: random.Random) -> bytes:
    """A content with some bytes changed, a span doubled, left out or cut off."""
    b = bytearray(content)
    for _ in range(rng.randint(1, 4)):
        if not b:
            return bytes(rng.randbytes(8))
        i = rng.randrange(len(b))
        j = min(len(b), i + rng.randint(1, 64))
        kind = rng.randrange(4)
        if kind == 0:
            b[i] ^= 1 << rng.randrange(8)
        elif kind == 1:
            b[i:i] = b[i:j]
        elif kind == 2:
            del b[i:j]
        else:
            del b[i:]
    return bytes(b)


def fuzz(files: DataFrame, command: Command, rounds: int, seed: int = 0) -> DataFrame:
    """(tool, exit_value, timeout, trace, n, path, round): failures of mutated files, in buckets by exit value and digest of what they said, with a first example.

    The mutation depends on seed, path and round alone, so that mutate() makes an example's file again.
    """
    rounds_of = files.select("path", "content", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as tmp:
            place = _Place(tmp)
            for b in batches:
                rows = []
                for path, content, k in zip(b["path"], b["content"], b["round"]):
                    got, _ = place.run(command, mutate(b"" if content is None else bytes(content), random.Random(f"{seed}:{path}:{k}")))
                    if got[0] != 0:
                        rows.append((command.table, got[0], got[1], hashlib.sha256(got[6].encode()).hexdigest(), path, k))
                yield pd.DataFrame(rows, columns=["tool", "exit_value", "timeout", "trace", "path", "round"])

    failed = rounds_of.mapInPandas(run, "tool string, exit_value int, timeout boolean, trace string, path string, round int")
    return failed.groupBy("tool", "exit_value", "timeout", "trace").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("path", "round")).alias("e")).select("tool", "exit_value", "timeout", "trace", "n", "e.path", "e.round")


def not_yet_run(files: DataFrame, runs: DataFrame, tool: str) -> DataFrame:
    """Files without a row of the tool: what an incremental run has to do."""
    done = runs.where(runs["tool"] == tool).select("path").distinct()
    return files.join(done, "path", "left_anti")
