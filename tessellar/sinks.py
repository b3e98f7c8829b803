"""Sinks: upserted tables, CSV and JSON results, feature exports, blobs by digest, lists and counts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.files import delete, exists, put
from tessellar.functions.digests import fan_out
from tessellar.operators.relational import by_count, upsert

FEATURE_CELL = 10_000


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is at ``path``; where a driver died between the moves of swap_in(), the new or else the old one is put there now."""
    if not _there(spark, path):
        if _there(spark, f"{path}.new/_SUCCESS"):
            swap_in(spark, f"{path}.new", path)
        elif _there(spark, f"{path}.old"):
            _move(spark, f"{path}.old", path)
    return _there(spark, path)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _there(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _move(spark: SparkSession, a: str, b: str) -> None:
    (fs, p), (_, q) = _fs(spark, a), _fs(spark, b)
    try:
        moved = fs.rename(p, q)
    except Py4JJavaError as e:
        raise OSError(str(e.java_exception)) from e
    if not moved:
        raise OSError(f"{a} can't be moved to {b}")


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put a table that was written beside ``path`` in its place; the old one is moved aside first and comes back if that fails."""
    fs, old = _fs(spark, f"{path}.old")
    if _there(spark, path):
        fs.delete(old, True)
        _move(spark, path, f"{path}.old")
    try:
        _move(spark, new, path)
    except Exception:
        if fs.exists(old):
            _move(spark, f"{path}.old", path)
        raise
    fs.delete(old, True)


def upsert_table(changes: DataFrame, path: str, key: Sequence[str], latest: Sequence[Column], delta: bool = True) -> None:
    """Write one row per key, the latest; ``delta`` keeps what is stored and merges, else the table is made anew. Written beside, then swapped in."""
    spark = changes.sparkSession
    old = spark.read.parquet(path) if delta and table_exists(spark, path) else None
    upsert(old, changes, key, latest).write.mode("overwrite").parquet(f"{path}.new")
    swap_in(spark, f"{path}.new", path)


#: Fields go to CSV as they are, blanks around them, too.
_CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
RESULT_COLUMNS = ("path", "exit_value", "timeout", "process_time_ms", "stdout", "stdout_length", "stdout_truncated", "stderr", "stderr_length", "stderr_truncated")


def write_results_csv(runs: DataFrame, path: str) -> None:
    """Tool results as CSV, ten columns and a header."""
    runs.select(*RESULT_COLUMNS).write.mode("overwrite").options(**_CSV).csv(path)


def write_results_json(runs: DataFrame, path: str) -> None:
    """Tool results as JSON lines."""
    runs.write.mode("overwrite").json(path)


def write_results_parquet(runs: DataFrame, path: str) -> None:
    runs.write.mode("overwrite").parquet(path)


#: Writers by the end of their target's name; more may be registered.
WRITERS: dict[str, Callable[[DataFrame, str], None]] = {".csv": write_results_csv, ".json": write_results_json, ".parquet": write_results_parquet}


def write_by_name(runs: DataFrame, target: str, jdbc_options: Mapping[str, str] | None = None) -> None:
    """Write to a target by its name: a JDBC address, or a path that ends in a registered suffix."""
    if target.startswith("jdbc:"):
        opts = dict(jdbc_options or {})
        runs.write.format("jdbc").options(url=target, **opts).mode("append").save()
        return
    for suffix, write in WRITERS.items():
        if target.endswith(suffix):
            return write(runs, target)
    raise ValueError(f"no writer for {target}")


def upsert_jdbc(changes: DataFrame, url: str, table: str, key: Sequence[str], latest: Sequence[Column], driver: str, types: str | None = None, tries: int = 10, wait: float = 30, sleep: Callable[[float], None] = time.sleep) -> None:
    """Merge rows into a database table by ``key``, the latest row of each; the table is made if it is missing.

    Executors write the changes to a table beside it, in batches and over as many connections as there are partitions. One
    statement then merges them in one transaction, tried again up to ``tries`` times with a new connection; a merge that is
    repeated, or comes after a lost answer, changes nothing more. Names are quoted, so they are case sensitive. ``types`` says
    what the columns are in the database (``path VARCHAR(512)``), as for keys that its default type can't compare.
    """
    spark = changes.sparkSession
    beside, options = f"{table}_NEW", {"url": url, "driver": driver, "batchsize": "1000", **({"createTableColumnTypes": types} if types else {})}
    upsert(None, changes, key, latest).write.format("jdbc").options(dbtable=f'"{beside}"', **options).mode("overwrite").save()
    columns = changes.columns
    quoted = lambda c: f'"{c}"'
    rest = [c for c in columns if c not in key]
    merge = (
        f"MERGE INTO {quoted(table)} o USING {quoted(beside)} n ON {' AND '.join(f'o.{quoted(c)} = n.{quoted(c)}' for c in key)} "
        + (f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{quoted(c)} = n.{quoted(c)}' for c in rest)} " if rest else "")
        + f"WHEN NOT MATCHED THEN INSERT ({', '.join(map(quoted, columns))}) VALUES ({', '.join(f'n.{quoted(c)}' for c in columns)})"
    )
    changes.limit(0).write.format("jdbc").options(dbtable=f'"{table}"', **options).mode("append").save()
    for k in range(tries):
        try:
            spark._jvm.java.lang.Class.forName(driver, True, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
            connection = spark._jvm.java.sql.DriverManager.getConnection(url)
            try:
                connection.setAutoCommit(False)
                for sql in (merge, f"DROP TABLE {quoted(beside)}"):
                    statement = connection.createStatement()
                    statement.executeUpdate(sql)
                    statement.close()
                connection.commit()
                return
            except Exception:
                connection.rollback()
                raise
            finally:
                connection.close()
        except Py4JJavaError:
            if k + 1 == tries:
                raise
            sleep(wait)


def send_bulk(rows: DataFrame, send: Callable[[list[dict]], None], most: int = 100, seconds: float = 10, tries: int = 3, wait: float = 30, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(n, tries) of each bulk of rows handed to ``send``: a flush at ``most`` rows, ``seconds`` after the last one, and at the end of a task.

    A bulk that fails is sent again; after ``tries`` the task fails, so that nothing is lost, and Spark repeats it. Give rows a key
    by which the receiver replaces them. The rows are sent when the result is read.
    """
    columns = rows.columns

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        def flush(bulk: list[dict]) -> int:
            for k in range(tries):
                try:
                    send(bulk)
                    return k + 1
                except OSError:
                    if k + 1 == tries:
                        raise
                    sleep(wait)
            raise AssertionError

        bulk: list[dict] = []
        last, done = time.monotonic(), []
        for b in batches:
            for values in zip(*(b[c] for c in columns)):
                bulk.append(dict(zip(columns, values)))
                if len(bulk) >= most or time.monotonic() - last >= seconds:
                    done.append((len(bulk), flush(bulk)))
                    bulk, last = [], time.monotonic()
            if done:
                yield pd.DataFrame(done, columns=["n", "tries"])
                done = []
        if bulk:
            yield pd.DataFrame([(len(bulk), flush(bulk))], columns=["n", "tries"])

    return rows.mapInPandas(run, "n int, tries int")


def joined_list(c: Column, sort: bool = True) -> Column:
    """A list as one cell, by blanks."""
    return F.concat_ws(" ", F.array_sort(c) if sort else c)


def export_cells(features: DataFrame, columns: Sequence[str], most: int | None = FEATURE_CELL, sort: bool = True) -> DataFrame:
    """Features as text cells: lists joined (sorted or as they are), each cut to ``most`` characters, null as ''."""
    out = []
    for c in columns:
        v = joined_list(F.col(c), sort) if features.schema[c].dataType.typeName() == "array" else F.col(c).cast("string")
        v = F.coalesce(v, F.lit(""))
        out.append((F.substring(v, 1, most) if most else v).alias(c))
    return features.select(*out)


def write_features(features: DataFrame, path: str, batch_rows: int = 100_000) -> None:
    """Feature documents as parquet; a task that is repeated replaces its own file, so nothing is lost or sent twice."""
    features.write.mode("overwrite").option("maxRecordsPerFile", batch_rows).parquet(path)


def write_query_csv(spark: SparkSession, query: str, path: str, null: str = "") -> None:
    """Any SQL to CSV; the header is the column names and nothing else. Null is written as ``null``."""
    spark.sql(query).write.mode("overwrite").options(**_CSV).csv(path, nullValue=null)


def write_blobs(files: DataFrame, root: str, flat: bool = False, replace: bool = False) -> DataFrame:
    """(digest, target, outcome): contents under a shared ``root`` by SHA-256, once each; outcome written or present.

    Copies are reduced to one row by an aggregation on the digest, and each file is moved into place whole.
    """
    keyed = files.select(F.sha2("content", 256).alias("digest"), "content").where("content IS NOT NULL")
    once = keyed.groupBy("digest").agg(F.any_value("content").alias("content"))
    named = once.withColumn("target", F.col("digest") if flat else fan_out(F.col("digest")))

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for b in batches:
            rows = []
            for digest, target, content in zip(b["digest"], b["target"], b["content"]):
                if exists(f"{root}/{target}") and not replace:
                    rows.append((digest, target, "present"))
                    continue
                put(f"{root}/{target}", bytes(content))
                rows.append((digest, target, "written"))
            yield pd.DataFrame(rows, columns=["digest", "target", "outcome"])

    return named.select("digest", "target", "content").mapInPandas(run, "digest string, target string, outcome string")


def delete_extras(paths: DataFrame, root: str, sure: bool = False) -> DataFrame:
    """(path, outcome) of files that a comparison found to be extra: 'would delete', or with ``sure`` 'deleted' or 'absent'.

    Nothing is deleted unless ``sure`` is given, and then when the result is read. Null paths are left out.
    """

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for b in batches:
            yield pd.DataFrame([(p, "would delete" if not sure else "deleted" if delete(f"{root}/{p}") else "absent") for p in b["path"]], columns=["path", "outcome"])

    return paths.select("path").where("path IS NOT NULL").distinct().mapInPandas(run, "path string, outcome string")


def write_url_list(records: DataFrame, path: str, url: str = "url") -> None:
    """URLs of truncated records, one per line, line ends as blanks."""
    records.select(F.regexp_replace(url, r"[\r\n]", " ").alias("value")).where("value IS NOT NULL").write.mode("overwrite").text(path)


def write_counts(counts: DataFrame, path: str, key: str = "key", n: str = "n") -> None:
    """``key<tab>count``, largest first."""
    by_count(counts.select(key, n), n, key).write.mode("overwrite").csv(path, sep="\t")


def append_status(reports: DataFrame, path: str, batch: str) -> None:
    """Status reports, appended by batch: one that comes again replaces what it had written, so that nothing is there twice."""
    reports.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def mapped(metadata: DataFrame, column: str, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Metadata (a map of lists) as typed columns: key -> (column, type), the first value of each, null where it doesn't cast."""
    first = lambda k: F.get(F.try_element_at(F.col(column), F.lit(k)), F.lit(0))
    return metadata.select(*(c for c in metadata.columns if c != column), *(first(k).try_cast(kind).alias(name) for k, (name, kind) in mapping.items()))


def write_mismatches(files: DataFrame, path: str) -> None:
    """``name<tab>digest`` of files whose name isn't their digest."""
    from tessellar.functions.digests import misnamed

    files.where(misnamed(F.col("path"), F.col("content"))).select("path", F.sha2("content", 256).alias("digest")).write.mode("overwrite").csv(path, sep="\t")


def reload_states(spark: SparkSession, path: str) -> None:
    """The table of fetch states, dropped and written again."""
    from tessellar.operators.fetch_state import state_table

    state_table(spark).coalesce(1).write.mode("overwrite").parquet(path)
