"""Shared plumbing: sessions, tables, lineage cuts, and joins that check a side's size before broadcasting it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A join side is broadcast only after a count shows at most this many rows and this many bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Beyond, a key with more than 1 / PARTS of the larger side's rows is split into parts of at most that size.
PARTS = 2000


def session(app: str = "tessellar", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the library is tuned for; on a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``). Only a local session that has none gets a temporary one, as in tests."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "") or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessellar-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a table that only this application reads; all of them go when it ends."""
    home = f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{home}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder and forget the lineage; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table below the shared folder and read again: a cut whose columns can be pruned and filtered at the scan."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an element in a list of numbers.
_WIDTHS = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4, "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def _bytes_of(c: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if (width := _WIDTHS.get(kind.elementType.typeName())) is not None:
            return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * width + 24
        return F.coalesce(F.aggregate(F.transform(c, lambda x: _bytes_of(x, kind.elementType).cast("bigint")), F.lit(16).cast("bigint"), lambda a, b: a + b), F.lit(16).cast("bigint"))
    if isinstance(kind, T.MapType):
        return _bytes_of(F.map_keys(c), T.ArrayType(kind.keyType)) + _bytes_of(F.map_values(c), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        out = F.lit(8)
        for f in kind.fields:
            out = out + _bytes_of(c.getField(f.name), f.dataType)
        return out
    return F.lit(8)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a count of rows and bytes finds ``df`` within the bounds of a broadcast; at most ``max_rows + 1`` rows are looked at."""
    size = F.lit(8)
    for f in df.schema.fields:
        size = size + _bytes_of(F.col(f"`{f.name}`"), f.dataType)
    got = df.select(size.cast("bigint").alias("__n")).limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("__n"), F.lit(0)).alias("bytes")).first()
    return got["rows"] <= max_rows and got["bytes"] <= max_bytes


def join_sized(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_by: Sequence[str | Column] = (),
    max_rows: int = BROADCAST_ROWS,
    parts: int = PARTS,
    keep: bool = False,
) -> DataFrame:
    """Equi-join of a possibly skewed ``big`` with ``small``.

    ``small`` is measured, rows and bytes. Within the bounds it is broadcast, so that hot keys of ``big`` never meet in one task.
    Beyond, both sides shuffle: the keys with more than 1 / ``parts`` of the rows of ``big``, of which there are fewer than
    ``parts``, are found by a count (the driver gets at most ``parts`` of them) and split by ``salt_by`` into pieces of about that size; only their rows of ``small`` are
    copied, once for each piece. Null keys never match, as in SQL. ``how``: inner, left, left_semi or left_anti. ``keep`` writes
    a ``small`` that is dear to compute to the shared folder first, so that measuring and joining it compute it once; a dear
    ``big`` should be written by the caller, as its keys are counted.
    """
    on = list(on)
    small = stored(small, "side") if keep else small
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    keys = big.select(*on).where(" AND ".join(f"`{c}` IS NOT NULL" for c in on))
    seen = Observation()
    commonest = keys.observe(seen, F.count(F.lit(1)).alias("n")).groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n")).limit(parts).collect()
    rows = seen.get["n"] if commonest else 0
    hot = [(*(r[c] for c in on), -(-r["__n"] * parts // rows)) for r in commonest if r["__n"] * parts > rows]
    if not hot:
        return big.join(small, on, how)
    hot = big.sparkSession.createDataFrame(hot, T.StructType([*(T.StructField(c, big.schema[c].dataType) for c in on), T.StructField("__parts", T.IntegerType())]))
    piece = F.coalesce(F.pmod(F.xxhash64(*(salt_by or big.columns)), F.col("__parts")), F.lit(0)).cast("int")
    placed = big.join(F.broadcast(hot), on, "left").withColumn("__piece", piece).drop("__parts")
    copies = small.join(F.broadcast(hot), on, "left").withColumn("__piece", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return placed.join(copies, [*on, "__piece"], how).drop("__piece")
