"""Clients of parsing services: outcomes, retries, and comparison of repeated answers. The transport is a parameter."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame

# Outcomes of one request by HTTP status.
BY_STATUS = {200: "RESPONSE_SUCCESS", 422: "RESPONSE_SUCCESS", 415: "RESPONSE_UNPROCESSABLE_EXCEPTION", 400: "RESPONSE_BAD_REQUEST", 503: "RESPONSE_SERVER_UNAVAILABLE"}
FINAL = frozenset(["RESPONSE_SUCCESS", "RESPONSE_PARSE_EXCEPTION"])
TRIES, RETRY_SECONDS, NO_SERVER_SECONDS = 3, 30, 1

#: A transport sends bytes for a name and gives (status, decoded answer); it raises OSError without a server, ValueError for a bad answer.
Transport = Callable[[str, bytes], tuple[int, object]]


def once(send: Transport, name: str, content: bytes) -> tuple[str, object]:
    """(outcome, answer) of one request."""
    try:
        status, answer = send(name, content)
    except OSError:
        return "NO_RESPONSE_IO_EXCEPTION", None
    except ValueError:
        return "RESPONSE_BAD_ENTITY", None
    outcome = BY_STATUS.get(status, "RESPONSE_NON_200_STATUS")
    return outcome, answer if outcome == "RESPONSE_SUCCESS" else None


def request(send: Transport, name: str, content: bytes, tries: int = TRIES, most_seconds: float = RETRY_SECONDS, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> tuple[str, object, int]:
    """(outcome, answer, requests sent). Tried again up to ``tries`` times and ``most_seconds``; a missing server costs time but no try."""
    began, used, sent = clock(), 0, 0
    while True:
        outcome, answer = once(send, name, content)
        sent += 1
        if outcome == "NO_RESPONSE_IO_EXCEPTION":
            sleep(NO_SERVER_SECONDS)
        else:
            used += 1
        if outcome in FINAL or used >= tries or clock() - began >= most_seconds:
            return outcome, answer, sent


def parse_remote(files: DataFrame, send: Transport, to_text: Callable[[object], str]) -> DataFrame:
    """(path, outcome, requests, answer) for files (path, content). Leave out those done before with an anti join."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                outcome, answer, sent = request(send, path, b"" if content is None else bytes(content))
                rows.append((path, outcome, sent, to_text(answer) if answer is not None else None))
            yield pd.DataFrame(rows, columns=["path", "outcome", "requests", "answer"])

    return files.select("path", "content").mapInPandas(run, "path string, outcome string, requests int, answer string")


def same_answer(expected: Sequence[Mapping[str, Sequence[str]]], got: Sequence[Mapping[str, Sequence[str]]], ignore: Sequence[str] = ()) -> str | None:
    """Null if two answers agree but for keys in ``ignore``, else where they first differ."""
    if len(expected) != len(got):
        return f"parts: {len(expected)} and {len(got)}"
    for k, (a, b) in enumerate(zip(expected, got)):
        for name in sorted((set(a) | set(b)) - set(ignore)):
            if list(a.get(name, ())) != list(b.get(name, ())):
                return f"part {k}: {name}"
    return None


def put_json(address: str, seconds: float = 120, headers: Mapping[str, str] | None = None, opener: Callable | None = None) -> Transport:
    """A transport that PUTs bytes to a service and reads JSON; the name goes along as a file name."""

    def send(name: str, content: bytes) -> tuple[int, object]:
        heads = {"Accept": "application/json", "Content-Disposition": f"attachment; filename*=UTF-8''{urllib.parse.quote(name)}", **(headers or {})}
        request = urllib.request.Request(address, data=content, headers=heads, method="PUT")
        try:
            with (opener or urllib.request.urlopen)(request, timeout=seconds) as r:
                return r.status, json.loads(r.read())
        except urllib.error.HTTPError as e:
            return e.code, None

    return send


def load_test(files: DataFrame, send: Transport, repeats: int, ignore: Sequence[str] = (), threads: int = 50) -> DataFrame:
    """(path, repeats, differing, first_difference): each file asked for again and again, ``threads`` requests of a task at once, every answer compared with the first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max(1, threads)) as pool:
            for b in batches:
                rows = []
                for path, content in zip(b["path"], b["content"]):
                    asked = [pool.submit(request, send, path, b"" if content is None else bytes(content)) for _ in range(repeats)]
                    answers = [a.result()[1] for a in asked]
                    found = [d for a in answers[1:] if (d := same_answer(answers[0] or [], a or [], ignore))]
                    rows.append((path, repeats, len(found), found[0] if found else None))
                yield pd.DataFrame(rows, columns=["path", "repeats", "differing", "first_difference"])

    return files.select("path", "content").mapInPandas(run, "path string, repeats int, differing int, first_difference string")
