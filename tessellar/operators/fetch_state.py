"""Outcomes of fetching files: pure decisions over recorded facts, and a per-host runner that needs a fetcher to be given."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fetch states in order of their ids.
FETCH_STATES = (
    "BAD_URL", "FETCHED_IO_EXCEPTION", "FETCHED_NOT_200", "FETCHED_IO_EXCEPTION_READING_ENTITY", "FETCHED_IO_EXCEPTION_DIGESTING", "ALREADY_IN_REPOSITORY", "FETCHED_EXCEPTION_EMITTING", "ADDED_TO_REPOSITORY",
    "ADDED_TO_REPOSITORY_DIFF_DIGEST", "EMPTY_PAYLOAD", "TRUNCATED", "REFETCHED_SUCCESS", "REFETCHED_BAD_STATUS", "REFETCHED_CONNECTION_SHUTDOWN", "REFETCH_UNHAPPY_HOST", "REFETCHED_TIMEOUT",
    "REFETCHED_IO_EXCEPTION", "REFETCHED_NOT_200", "REFETCHED_IO_EXCEPTION_READING_ENTITY", "REFETCHED_IO_EXCEPTION_FILE_LENGTH", "REFETCHED_IO_EXCEPTION_DIGESTING", "REFETCHED_EXCEPTION_EMITTING", "REFETCHED_TRUNCATED",
)
#: A host is given up after more than so many failures.
MOST_FAILURES = 10
#: Seconds between two requests to one host.
PAUSE = (0.1, 2.1)


def state_table(spark: SparkSession) -> DataFrame:
    """(id, status): the table of states, from scratch."""
    return spark.createDataFrame(list(enumerate(FETCH_STATES)), "id int, status string")


def state_id(name: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for i, s in enumerate(FETCH_STATES) for x in (s, i))), name)


def first_fetch(truncated: Column, length: Column, same_digest: Column, emit_error: Column) -> Column:
    """State of a first fetch: TRUNCATED if the index says so, EMPTY_PAYLOAD, an error of storing it, else added, with or without the index's digest.

    No payload at all (null length) has no state. An unknown digest counts as a different one.
    """
    kept = F.when(F.coalesce(same_digest, F.lit(False)), "ADDED_TO_REPOSITORY").otherwise("ADDED_TO_REPOSITORY_DIFF_DIGEST")
    return F.when(F.trim(truncated) != "", "TRUNCATED").when(length == 0, "EMPTY_PAYLOAD").when(emit_error, "FETCHED_EXCEPTION_EMITTING").when(length.isNotNull(), kept)


#: Kinds of failure that a fetcher reports, and the states that they lead to.
BY_ERROR = {
    "timeout": "REFETCHED_TIMEOUT", "io": "REFETCHED_IO_EXCEPTION", "read": "REFETCHED_IO_EXCEPTION_READING_ENTITY", "length": "REFETCHED_IO_EXCEPTION_FILE_LENGTH",
    "digest": "REFETCHED_IO_EXCEPTION_DIGESTING", "closed": "REFETCHED_CONNECTION_SHUTDOWN", "emit": "REFETCHED_EXCEPTION_EMITTING",
}


def refetch(error: Column, http_status: Column, length: Column, expected: Column, emit_error: Column) -> Column:
    """State of a fetch from the live web. ``error``: a key of BY_ERROR, or null."""
    out = F.when(http_status.isNull(), "REFETCHED_BAD_STATUS").when(http_status != 200, "REFETCHED_NOT_200").when(expected.isNotNull() & (expected >= 0) & (length < expected), "REFETCHED_TRUNCATED").when(emit_error, "REFETCHED_EXCEPTION_EMITTING").otherwise("REFETCHED_SUCCESS")
    for e, state in BY_ERROR.items():
        out = F.when(error == e, state).otherwise(out)
    return out


@dataclass(frozen=True)
class Fetched:
    """What a fetcher reports of one URL: a kind of failure or the answer's status, bytes received, and bytes announced (-1 or null: unknown)."""

    error: str | None = None
    http_status: int | None = None
    length: int | None = None
    expected: int | None = None


def refetch_hosts(targets: DataFrame, fetch: Callable[[str], Fetched], most_failures: int = MOST_FAILURES, pause: tuple[float, float] = PAUSE, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(host, id, status, http_status) of targets (host, id, url): the requests of a host follow one another in one task, in order of id.

    Between two requests to a host the task waits at random within ``pause`` seconds. After more than ``most_failures`` failures the
    rest of a host is REFETCH_UNHAPPY_HOST without a request. Rows stream through the task, so that a host of any size needs no more
    memory than a batch. A fetcher that raises counts as 'io', and as 'timeout' for TimeoutError.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, failures, asked, first = None, 0, False, True
        for b in batches:
            rows = []
            for r in b.itertuples():
                if first or r.host != host:
                    host, failures, asked, first = r.host, 0, False, False
                if failures > most_failures:
                    rows.append((r.host, r.id, None, None, None, None, True))
                    continue
                if asked and pause[1] > 0:
                    sleep(random.uniform(*pause))
                asked = True
                try:
                    got = fetch(r.url)
                except TimeoutError:
                    got = Fetched("timeout")
                except OSError:
                    got = Fetched("io")
                failures += got.error is not None or got.http_status != 200
                rows.append((r.host, r.id, got.error, got.http_status, got.length, got.expected, False))
            out = pd.DataFrame(rows, columns=["host", "id", "error", "http_status", "length", "expected", "unhappy"])
            yield out.astype({"http_status": "Int32", "length": "Int64", "expected": "Int64"})

    laid = targets.select("host", "id", "url").repartition("host").sortWithinPartitions("host", "id")
    got = laid.mapInPandas(run, "host string, id bigint, error string, http_status int, length bigint, expected bigint, unhappy boolean")
    state = F.when(F.col("unhappy"), "REFETCH_UNHAPPY_HOST").otherwise(refetch(F.col("error"), F.col("http_status"), F.col("length"), F.col("expected"), F.lit(False)))
    return got.select("host", "id", state.alias("status"), "http_status")
